"""String measures used to flag suspicious names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shannon_entropy(c: Column | str, digits: int = 3) -> Column:
    """Shannon entropy of a string in bits per character, rounded.

    H = -sum(p * log2(p)) over the distinct characters, p being a
    character's share of the string; computed as
    log2(n) - sum(k * log2(k)) / n from the per-character counts k, and
    rounded half-even. Characters are code points. NULL and the empty
    string give 0.0.

    Built from higher-order functions: no Python runs per row. The count of a
    character is the length lost when it is removed, so the cost is
    O(length x distinct characters) per row, small for host names.
    """
    s = _as_col(c)
    n = F.length(s)
    distinct_chars = F.array_distinct(F.split(s, ""))
    counts = F.transform(distinct_chars, lambda ch: n - F.length(F.replace(s, ch, F.lit(""))))
    weighted = F.aggregate(counts, F.lit(0.0).cast("double"), lambda acc, k: acc + k * F.log2(k))
    # The guard comes first: under ANSI mode a division by a zero length raises.
    # Half-even rounding, as the reference's rounding of the binary value
    # does on exact ties (4.8125 -> 4.812); Spark's round would give 4.813.
    return (F.when(s.isNull() | (n == 0), F.lit(0.0))
            .otherwise(F.bround(F.log2(n) - weighted / n, digits)))


def name_length(c: Column | str) -> Column:
    """Length in characters (code points), NULL for NULL."""
    return F.length(_as_col(c)).cast("int")
