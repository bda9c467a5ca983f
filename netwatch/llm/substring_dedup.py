"""Removal of passages that repeat across documents, by super-k-mers.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash
among its runs of ``RUN`` words; consecutive windows that take the same run
form a super-k-mer, so equal windows of different documents always meet under
equal minimisers.

1. One pass over the texts lists super-k-mers as small records: minimiser,
   128-bit digest of the words, document, place. Records whose minimiser
   occurs in one document only are dropped after a grouped min and max.
2. Equal super-k-mers (same digest) are folded: the smallest document owns
   the string, every other occurrence is removed whole. This is one
   pre-aggregated group-by, so copies never meet in one task.
3. Minimisers that still have several different strings form buckets. Each
   string travels once, from its owner, as one packed string of words to its
   bucket, where its windows are sorted and equal ones compared exactly.
   A bucket of more than ``BUCKET`` strings is not gathered: its windows
   are compared as 128-bit digests by a grouped minimum instead.
4. The word spans to remove meet their text again by ``doc_id``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch, materialise, rolling_hash, slices, table, word_hashes

WINDOW = 50
RUN = 8
BUCKET = 1000
# A place packs a 24-bit tag of the text, the first word and the number of
# windows into one long.
_START = 1 << 8
_TAG = 1 << 40


def super_kmers(hashes: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of every super-k-mer;
    at most 255 windows each."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    runs = rolling_hash(hashes, run)
    span = window - run + 1
    at = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(axis=1) + np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return runs[at[starts]], starts, np.diff(np.append(starts, n))


def _words(text: bytes) -> tuple[list[bytes], bytes, np.ndarray]:
    """Words, the words joined by one space, and where each begins in that
    (one more at the end, past a last space)."""
    words = text.split()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return words, b" ".join(words), np.concatenate([[0], ends])


def _tag(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFF


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def records(docs: DataFrame, window: int, run: int) -> DataFrame:
    """minimiser, d1, d2 (digest), doc_id, place of every super-k-mer."""
    kind = pa.schema([(c, pa.int64()) for c in ("minimiser", "d1", "d2", "doc_id", "place")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            keys, digests, ids, places = [], [], [], []
            for doc, text in zip(rows.column(0).to_pylist(), as_bytes(rows.column(1))):
                if doc is None or not text:
                    continue
                words, joined, begin = _words(text)
                if len(words) < window:
                    continue
                key, start, count = super_kmers(word_hashes(words), window, run)
                first, last = begin[start], begin[start + count + window - 1] - 1
                found = [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(first.tolist(), last.tolist())]
                once = {d: i for i, d in zip(range(len(found) - 1, -1, -1), reversed(found))}
                if len(once) < len(found):  # a string repeated in its document is listed once
                    stay = np.sort(np.fromiter(once.values(), np.int64, len(once)))
                    found, key, start, count = [found[i] for i in stay], key[stay], start[stay], count[stay]
                digests += found
                keys.append(key)
                ids.append(np.full(len(key), doc, np.int64))
                places.append(_tag(text) * _TAG + start * _START + count)
            if keys:
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield batch(kind, np.concatenate(keys).view(np.int64), np.ascontiguousarray(halves[:, 0]),
                                   np.ascontiguousarray(halves[:, 1]), np.concatenate(ids), np.concatenate(places))

    return _keyed(docs).mapInArrow(scan, ", ".join(f"{c} long" for c in kind.names))


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id and the words of its text, compressed for the shuffle."""
    kind = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for rows in slices(batches):
            yield batch(kind, rows.column(0), [
                None if t is None else press.compress(t) for t in as_bytes(rows.column(1))])

    return _keyed(docs).mapInArrow(pack, "doc_id long, packed binary")


def _bucket_strings(packed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The owners' strings. ``wanted``: doc_id, items array<struct<minimiser,
    place, large>>. Cold rows hold a packed string; rows of large buckets
    hold the digest of one window each (d1, d2) and no string."""
    kind = pa.schema([("minimiser", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                      ("doc_id", pa.int64()), ("place", pa.int64()), ("words", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for rows in slices(batches):
            out = []
            for doc, blob, items in zip(*(c.to_pylist() for c in rows.columns)):
                text = press.decompress(blob)
                tag, (_, joined, begin) = _tag(text), _words(text)
                for item in items:
                    place = item["place"]
                    if place // _TAG != tag:
                        continue
                    start, count = place % _TAG // _START, place % _START
                    if not item["large"]:
                        out.append((item["minimiser"], None, None, doc, place,
                                    joined[begin[start]:begin[start + count + window - 1] - 1]))
                        continue
                    for w in range(start, start + count):
                        digest = xxhash.xxh3_128_digest(joined[begin[w]:begin[w + window] - 1])
                        out.append((None, int.from_bytes(digest[:8], "little", signed=True),
                                    int.from_bytes(digest[8:], "little", signed=True),
                                    doc, tag * _TAG + w * _START + 1, None))
                if len(out) > 20_000:
                    yield batch(kind, *map(list, zip(*out)))
                    out = []
            if out:
                yield batch(kind, *map(list, zip(*out)))

    return packed.join(wanted, "doc_id").mapInArrow(
        cut, "minimiser long, d1 long, d2 long, doc_id long, place long, words binary")


def _compare_bucket(strings: list[tuple[int, int, bytes]], window: int) -> Iterator[tuple[int, int]]:
    """doc_id and place of every run of windows that a smaller document has,
    for the strings (doc_id, place, words) of one bucket."""
    windows = []
    for i, (_, _, joined) in enumerate(strings):
        words, _, begin = _words(joined)
        begin = begin.tolist()
        windows += [(joined[begin[w]:begin[w + window] - 1], strings[i][0], i, w)
                    for w in range(len(words) - window + 1)]
    windows.sort()
    least, owner, hit = None, None, [[] for _ in strings]
    for text, doc, i, w in windows:
        if text != least:
            least, owner = text, doc
        elif doc > owner:
            hit[i].append(w)
    for (doc, place, _), found in zip(strings, hit):
        found.sort()
        base, at = place - place % _START, 0
        while at < len(found):
            stop = at + 1
            while stop < len(found) and found[stop] == found[stop - 1] + 1:
                stop += 1
            yield doc, base + found[at] * _START + stop - at
            at = stop


def _sorted_buckets(strings: DataFrame, window: int) -> DataFrame:
    """Compare the packed strings bucket by bucket; a task streams its
    buckets, one in memory at a time."""
    kind = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bucket = None, []
        for rows in batches:
            out = []
            for key, doc, place, words in zip(*(c.to_pylist() for c in rows.columns)):
                if key != current:
                    out += _compare_bucket(bucket, window)
                    current, bucket = key, []
                bucket.append((doc, place, words))
            yield batch(kind, [d for d, _ in out], [p for _, p in out])
        out = list(_compare_bucket(bucket, window))
        yield batch(kind, [d for d, _ in out], [p for _, p in out])

    return (strings.repartition("minimiser").sortWithinPartitions("minimiser")
            .mapInArrow(run, "doc_id long, place long"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN, bucket: int = BUCKET,
                   packed: DataFrame | None = None) -> DataFrame:
    """doc_id, places: the windows of each document whose words also start
    in a document with a smaller id (documents without any are left out)."""
    packed = packed_texts(docs) if packed is None else packed
    all_records = materialise(records(docs, window, run), "skm")
    shared = materialise(
        all_records.groupBy("minimiser").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
        .filter("x < y").select("minimiser"), "skm_shared")
    met = materialise(all_records.join(shared, "minimiser", "left_semi"), "skm_met")

    string = ["minimiser", "d1", "d2"]
    owned = materialise(met.groupBy(*string).agg(
        F.min("doc_id").alias("owner"), F.min_by("place", "doc_id").alias("own_place"),
        F.max("doc_id").alias("last"), F.count("*").alias("n")), "skm_owned")
    # Other occurrences: of larger documents, or in another row of the owner.
    others = materialise(
        met.join(owned.filter("n > 1").select(*string, "owner", "own_place"), string)
        .filter("doc_id > owner OR place <> own_place")
        .select("minimiser", "doc_id", "place", (F.col("doc_id") > F.col("owner")).alias("gone")), "skm_others")
    whole = others.filter("gone").select("doc_id", "place")

    buckets = materialise(
        owned.groupBy("minimiser").agg(
            F.count("*").alias("strings"), F.min("owner").alias("x"), F.max("owner").alias("y"))
        .filter("strings > 1 AND x < y").select("minimiser", (F.col("strings") > bucket).alias("large")), "skm_buckets")
    travel = (owned.select("minimiser", F.col("owner").alias("doc_id"), F.col("own_place").alias("place"))
              .unionByName(others.filter("NOT gone").select("minimiser", "doc_id", "place")))
    wanted = (travel.join(buckets, "minimiser").groupBy("doc_id")
              .agg(F.collect_list(F.struct("minimiser", "place", "large")).alias("items")))
    strings = materialise(_bucket_strings(packed, wanted, window), "skm_strings")
    compared = _sorted_buckets(strings.filter("words IS NOT NULL").select("minimiser", "doc_id", "place", "words"), window)

    single = strings.filter("words IS NULL").select("d1", "d2", "doc_id", "place")
    first = materialise(
        single.groupBy("d1", "d2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .filter("owner < last").drop("last"), "skm_first")
    large = single.join(first, ["d1", "d2"]).filter("doc_id > owner").select("doc_id", "place")

    return (whole.unionByName(compared).unionByName(large)
            .groupBy("doc_id").agg(F.collect_list("place").alias("places")))


def _covered(words: list[bytes], places: list[int], tag: int, window: int) -> np.ndarray:
    """Which words lie under a listed window, or under one with the same
    words elsewhere in the text."""
    listed = np.zeros(len(words) - window + 2, np.int64)
    for place in places:
        if place // _TAG == tag:
            start = place % _TAG // _START
            listed[start] += 1
            listed[start + place % _START] -= 1
    rolling = rolling_hash(word_hashes(words), window)
    hit = np.isin(rolling, rolling[np.cumsum(listed[:-1]) > 0])
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(hit)] += hit
    edge[window:] -= hit
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, bucket: int = BUCKET,
                   texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space; null
    unless ``texts``) and kept_sha256 of every row.

    A word goes when a window covering it also starts in a document with a
    smaller ``doc_id``; windows are judged on the input. Words are split at
    ASCII white space and unchanged otherwise; null and empty texts have
    none and nothing is removed. Texts shorter than a window lose nothing.
    Rows with a null ``doc_id`` neither lose words nor make others lose any.
    Rows repeated under one id are all returned and do not act on each
    other. Extra columns are ignored.
    """
    if not 0 < run <= window or window > 200:
        raise ValueError("need 0 < run <= window <= 200")
    packed = packed_texts(docs)
    spans = repeated_spans(docs, window, run, bucket, packed)
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("kept", pa.binary()), ("kept_sha256", pa.string())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for rows in slices(batches):
            out, size = [], 0
            for doc, blob, places in zip(*(c.to_pylist() for c in rows.columns)):
                text = b"" if blob is None else press.decompress(blob)
                words = kept = text.split()
                tag = _tag(text)
                if places and any(p // _TAG == tag for p in places):
                    gone = _covered(words, places, tag, window).tolist()
                    kept = [w for w, g in zip(words, gone) if not g]
                joined = b" ".join(kept)
                out.append((doc, len(words), len(words) - len(kept), joined if texts else None,
                            hashlib.sha256(joined).hexdigest()))
                size += len(joined)
                if size > 16 << 20:
                    yield batch(kind, *map(list, zip(*out)))
                    out, size = [], 0
            if out:
                yield batch(kind, *map(list, zip(*out)))

    return (packed.join(spans, "doc_id", "left")
            .mapInArrow(clean, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")
            .withColumn("kept", F.col("kept").cast("string")))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("kept")
