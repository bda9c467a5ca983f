"""Near duplicates by SimHash and a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ
in at most d bits differ in at most d bytes, so they share at least 8 - d
positional bytes: that is the guaranteed minimum of matches. An index keyed
by single bytes would put a 256th of all fingerprints into each list. The
lists here are keyed by the bytes at *sets* of positions, chosen so that any
8 - d shared positions contain one of the sets: for d = 3 the 14 quadruples
of the Steiner system S(3, 4, 8), 32 bits of key. Fingerprints that meet in
a list have their shared positional bytes tallied, pairs below the minimum
are dropped, the rest are verified on the bits.

Only distinct fingerprints are indexed: copies are folded onto one
representative before. A list longer than ``BLOCK`` is dealt out as pairs of
blocks, so every task compares at most 2 * BLOCK fingerprints, as arrays,
and returns a spanning forest of the links it finds, not the pairs. No list
is capped: all block pairs of a list are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch, materialise, slices, small, table
from .components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
BLOCK = 512
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text. A-Z are lower-cased; a shingle is
    ``shingle_words`` words joined by one space, repeats count; a shorter
    text is one shingle; no word gives 0. A bit is set when it is set in
    more than half of the shingles' XXH64 (seed 42)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate([[0], ends])[:n].tolist()
    stops = (ends[min(shingle_words, len(words)) - 1:] - 1).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, n, CHUNK):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) of every row."""
    kind = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = [fingerprint(t, shingle_words) for t in as_bytes(rows.column(1))]
            yield batch(kind, rows.column(0), np.array(found, np.uint64).view(np.int64))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fp long"))


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 8 - ``max_bits`` positions
    contain at least one of them.

    For 3 bits: the vectors of the extended Hamming code with four ones
    (a Steiner system: each 5 positions contain exactly one). Otherwise all
    sets of the guaranteed size.
    """
    size = 8 - max_bits
    if not 1 <= size <= 8:
        raise ValueError("max_bits must lie between 0 and 7")
    if max_bits == 3:
        # Position i is the point i of a three-bit space: four points are a
        # block when they are the whole of a plane, that is xor to zero.
        return [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    return list(combinations(range(8), size))


def forest(pairs: np.ndarray, n: int) -> list[int]:
    """Indices of the rows of ``pairs`` that join two trees so far."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, (x, y) in enumerate(pairs.tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            kept.append(i)
    return kept


def close_pairs(values: np.ndarray, max_bits: int) -> np.ndarray:
    """Index pairs (i < j) of fingerprints within ``max_bits``: tally equal
    bytes, keep those with the guaranteed minimum, verify on the bits."""
    found = []
    octets = values.view(np.uint8).reshape(-1, 8)
    for i in range(len(values) - 1):
        shared = (octets[i + 1:] == octets[i]).sum(axis=1)
        j = np.flatnonzero(shared >= 8 - max_bits) + i + 1
        j = j[np.bitwise_count(values[j] ^ values[i]) <= max_bits]
        found.append(np.column_stack([np.full(len(j), i), j]))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """a, b: links between the ``node`` ids of fingerprints within
    ``max_bits`` of each other, enough of them to connect what is connected.
    ``distinct``: node, fp, one row per fingerprint."""
    sets = position_sets(max_bits)

    def masked(positions: tuple[int, ...]):
        mask = sum(0xFF << (8 * p) for p in positions)
        return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))

    posting = distinct.select("node", "fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("s"), masked(p).alias("key")) for i, p in enumerate(sets)])).alias("k")
    ).select("k.s", "k.key", "node", "fp")
    lists = posting.groupBy("s", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = posting.join(lists, ["s", "key"])
    # Each fingerprint of a list goes to every pair of blocks with its own.
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks.cast("long")).cast("int")
    dealt = (met.select("s", "key", "node", "fp", own.alias("own"),
                        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
             .select("s", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     "node", "fp"))
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, values = None, [], []

        def linked() -> Iterator[tuple[int, int]]:
            if len(values) > 1:
                pairs = close_pairs(np.array(values, np.int64).view(np.uint64), max_bits)
                for i in forest(pairs, len(values)):
                    yield nodes[pairs[i][0]], nodes[pairs[i][1]]

        for rows in batches:
            out = []
            columns = [c.to_pylist() for c in rows.columns]
            for *key, node, value in zip(*columns):
                if key != keys:
                    out += linked()
                    keys, nodes, values = key, [], []
                nodes.append(node)
                values.append(value)
            yield batch(kind, [x for x, _ in out], [y for _, y in out])
        out = list(linked())
        yield batch(kind, [x for x, _ in out], [y for _, y in out])

    order = ["s", "key", "lo", "hi"]
    return (dealt.repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Fingerprints within ``max_bits`` bits are linked, also those of texts
    without words (0). ``component_id`` is the smallest ``doc_id``
    reachable. Null text counts as empty. Rows repeated under one ``doc_id``
    are all returned; rows with different texts under one id link it to both
    fingerprints. A row with a null ``doc_id`` takes part through its text
    (its component is the smallest id there, null if there is none). Extra
    columns are ignored; an empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, shingle_words), "simhash")
    return _with_components(rows, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _with_components(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (doc_id, fp and more) with ``component_id``."""
    # The nodes are the fingerprints themselves, so that one whose rows have
    # no id links its neighbours all the same. A document id under several
    # fingerprints ties them to the smallest of them.
    known = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    several = (rows.filter("doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("x <> y").select("doc_id", "x"))
    again = rows.select("doc_id", "fp").join(several, "doc_id").select(F.col("fp").alias("a"), F.col("x").alias("b"))
    found = components(links(known.select(F.col("fp").alias("node"), "fp"), max_bits).unionByName(again),
                       "simhash_edges")
    owner = materialise(known.join(found, F.col("fp") == F.col("node"), "left")
                        .select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash_owner")
    # Written, so that the join may split the rows of a very large component.
    least = materialise(owner.groupBy("component").agg(F.min("least").alias("component_id")), "simhash_least")
    return rows.join(owner.join(least, "component").select("fp", "component_id"), "fp", "left")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay: of each component the one with the smallest
    ``doc_id``. Rows repeated under that id are one document: one row stays,
    the one whose text hashes lowest. Rows with a null ``doc_id`` cannot be
    told apart from others and stay. All columns come back unchanged.

    Ids with one row, usually all, take part in one semi-join, shuffled at
    every size: the ids that stay grow with the corpus. Only rows of
    repeated ids are grouped, as partial minima first.
    """
    found = near_duplicates(docs, shingle_words, max_bits).filter("doc_id = component_id")
    stay = materialise(found.groupBy(F.col("doc_id").alias("__stay")).agg(F.count("*").alias("__n")), "simhash_stay")
    own = docs["doc_id"].cast("long")
    once = docs.join(stay.filter("__n = 1").hint("merge"), own == F.col("__stay"), "left_semi")
    again = docs.join(small(stay.filter("__n > 1")), own == F.col("__stay"), "left_semi")
    again = (again.groupBy(own.alias("__stay"))
             .agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("__row")).select("__row.*"))
    return once.unionByName(docs.filter(docs["doc_id"].isNull())).unionByName(again)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
