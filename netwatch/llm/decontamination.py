"""Benchmark passages in documents: SimHash of item-sized windows.

Texts are lower-cased runs of letters, digits and underscores; shingles are
five words. Every run of as many words as an item has is a window of the
document (a document shorter than the item is one window). Its 64-bit
SimHash is looked up in a multi-index over the fingerprints of the items of
that size: eight byte blocks, each expanded to the values within
``RADIUS // 8`` bits. Two fingerprints within ``RADIUS`` bits agree that
well in at least one block, so the lookup misses none. Candidates are
verified by the exact weighted Jaccard similarity of their shingles, where a
shingle weighs as often as it occurs.

Windows that share no shingle with any item have similarity 0; they are
passed over without a fingerprint. Nothing is shuffled: the benchmark is
dealt into blocks of about ``ITEMS`` items, each block is broadcast and all
documents are scanned against it.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, process_cache, rolling_hash, slices, table, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
ITEMS = 20_000
_WORD = re.compile(r"\w+")
_FILTER_BITS = 22


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the shingles of a text, in order."""
    words = [w.encode() for w in _WORD.findall((text or "").lower())]
    return rolling_hash(word_hashes(words), size)


def simhash(hashes: np.ndarray) -> int:
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def weighted_jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values())


class ItemIndex:
    """Fingerprints of one block of items, by their number of shingles."""

    def __init__(self, items: list[tuple[int, str]], radius: int):
        self.radius = radius
        own = [(i, shingles(t)) for i, t in items]
        own = [(i, h) for i, h in own if len(h)]
        self.ids = [i for i, _ in own]
        self.bags = [Counter(h.tolist()) for _, h in own]
        self.prints = np.array([simhash(h) for _, h in own], np.uint64)
        by_size, sizes = defaultdict(list), defaultdict(set)
        for k, (_, h) in enumerate(own):
            by_size[len(h)].append(k)
            for s in set(h.tolist()):
                sizes[s].add(len(h))
        self.known = np.array(sorted(sizes), np.uint64)
        self.sizes = [sorted(sizes[s]) for s in self.known.tolist()]
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(self.known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= radius // 8
        # For each size: its items, and per block and byte value which of
        # them have a byte within reach there.
        self.blocks = {}
        for size, ks in by_size.items():
            octets = self.prints[ks].view(np.uint8).reshape(-1, 8)
            self.blocks[size] = (np.array(ks), [near[:, octets[:, b]] for b in range(8)])

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of shingles that some item has, and which those are."""
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return at, at
        which = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        same = self.known[which] == hashes[at]
        return at[same], which[same]

    def matches(self, text: str | None, similarity: float) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, number of words) of the best window
        for every item with one that is similar enough; ties go to the
        first window."""
        hashes = shingles(text)
        at, which = self.hits(hashes)
        if not len(at):
            return []
        starts = defaultdict(set)
        for q, s in zip(at.tolist(), which.tolist()):
            for size in self.sizes[s]:
                # A document with fewer shingles than the item is one window.
                last = max(0, len(hashes) - size)
                starts[size].update(range(min(last, max(0, q - size + 1)), min(last, q) + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for size, found in starts.items():
            ordered = np.array(sorted(found))
            for part in np.split(ordered, np.flatnonzero(np.diff(ordered) > size) + 1):
                self._scan(hashes, part, size, similarity, best)
        return [(self.ids[k], s, w, n) for k, (s, w, n) in sorted(best.items())]

    def _scan(self, hashes: np.ndarray, starts: np.ndarray, size: int, similarity: float, best: dict) -> None:
        low, wide = int(starts[0]), min(size, len(hashes))
        region = hashes[low:int(starts[-1]) + wide]
        bits = np.unpackbits(region.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
        ones = sums[starts - low + wide] - sums[starts - low]
        prints = np.packbits(2 * ones > wide, axis=1, bitorder="little")
        items, blocks = self.blocks[size]
        candidate = reduce(np.logical_or, (blocks[b][prints[:, b]] for b in range(8)))
        row, col = np.nonzero(candidate)
        apart = np.bitwise_count(prints.view(np.uint64).ravel()[row] ^ self.prints[items[col]])
        close = apart <= self.radius
        for r, c in zip(row[close].tolist(), col[close].tolist()):
            k, start = int(items[c]), int(starts[r])
            score = weighted_jaccard(Counter(hashes[start:start + wide].tolist()), self.bags[k])
            if score >= similarity and (k not in best or (-score, start) < (-best[k][0], best[k][1])):
                best[k] = (score, start, wide + SHINGLE_WORDS - 1)


def item_blocks(items: DataFrame, size: int = ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks that fit into memory everywhere: distinct
    (item_id, text), about ``size`` each, dealt by a hash."""
    clean = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    clean = clean.filter("text IS NOT NULL").distinct()
    blocks = -(-clean.count() // size)
    for b in range(blocks):
        own = clean.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield sorted(((r.item_id, r.text) for r in own.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                 block: int = ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: for every document
    row and item the most similar window, when it reaches ``similarity``.

    Null and empty texts match nothing; so do items of fewer than five
    words. Repeated document rows are reported each; repeated item rows
    once. Items with one text under several ids are reported under each.
    Extra columns are ignored.
    """
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    kind = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                      ("start_word", pa.int64()), ("n_words", pa.int64())])
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [spark.createDataFrame([], schema)]
    for own in item_blocks(items, block):
        sent = spark.sparkContext.broadcast(own)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = process_cache("items", name, lambda: ItemIndex(sent.value, radius))
            for part in slices(batches):
                out = [(doc, *m) for doc, text in zip(*(c.to_pylist() for c in part.columns))
                       for m in index.matches(text, similarity)]
                if out:
                    yield batch(kind, *map(list, zip(*out)))

        found.append(rows.mapInArrow(scan, schema))
    return reduce(DataFrame.unionAll, found)


def decontaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                   block: int = ITEMS) -> DataFrame:
    """The documents without any similar window, with all their columns."""
    for own in item_blocks(items, block):
        clean = _clean(docs.sparkSession.sparkContext.broadcast(own), similarity, radius)
        docs = docs.filter(clean.asNondeterministic()(F.col("text").cast("string")))
    return docs


def _clean(sent: Broadcast, similarity: float, radius: int):
    """Whether a text has no window similar to one of the items sent."""
    name = uuid.uuid4().hex

    @F.arrow_udf("boolean")
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = process_cache("items", name, lambda: ItemIndex(sent.value, radius))
        for texts in parts:
            yield pa.array([not index.matches(t, similarity) for t in texts.to_pylist()], pa.bool_())

    return clean


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
