"""Registered queries (``catalog``) and their independent checks (``oracle``)."""

# Fixed detection clock of the registered queries, so their results are
# reproducible (rules default to processing time otherwise).
CLOCK = "2024-02-01 00:00:00"
