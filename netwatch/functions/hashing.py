"""Pseudonymisation of addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonymise(c: Column | str, salt: str | None = None, width: int = 16) -> Column:
    """First ``width`` hex digits of SHA-256 of the UTF-8 text.

    Unsalted, this is the record format on the wire. The IPv4 space is small
    enough to enumerate, so an unsalted digest can be reversed by brute force;
    pass a secret ``salt`` where the digest must not be linkable back.
    """
    s = F.col(c) if isinstance(c, str) else c
    if salt:
        s = F.concat(F.lit(salt), s)
    return F.substring(F.sha2(s, 256), 1, width)
