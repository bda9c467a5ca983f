"""IPv4 prefixes and AS paths as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from netwatch.functions.time import _as_col

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PREFIX = rf"^{_OCTET}(?:\.{_OCTET}){{3}}/(?:3[0-2]|[12]?[0-9])$"


def prefix_parts(prefix: Column | str) -> Column:
    """struct(address long, bits int) of an IPv4 prefix in dotted notation;
    NULL for anything else (IPv6, no length, octets beyond 255)."""
    prefix = _as_col(prefix)
    parts = F.split(prefix, "[./]")
    octets = [F.get(parts, F.lit(i)).try_cast("long") for i in range(4)]
    address = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    return F.when(prefix.rlike(IPV4_PREFIX), F.struct(
        address.alias("address"), F.get(parts, F.lit(4)).try_cast("int").alias("bits")))


def prefix_block(address: Column | str, bits: Column | str) -> Column:
    """Number of the block of 2^(32 - bits) addresses that holds ``address``."""
    return F.call_function("shiftright", _as_col(address), (F.lit(32) - _as_col(bits)).cast("int"))


def unexpected_path_as(as_path: Column | str, expected: Sequence[int], typed: bool = False) -> Column:
    """The AS numbers of a path that are not expected, each once, in path
    order. The path is a JSON list (as decoded by default) or, ``typed``, an
    array. Empty for an empty path, NULL for a NULL or malformed one; NULL
    elements are ignored."""
    path = _as_col(as_path)
    if not typed:
        path = F.from_json(path, "array<int>")
    return F.array_except(F.array_compact(path), F.array(*[F.lit(a) for a in expected]).cast("array<int>"))
