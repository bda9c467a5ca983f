"""Token ids as ORC files.

Rows are dealt out by ranges of ``doc_id`` and sorted, each task encodes its
range and writes one ORC file, so file order and row order are ascending
``doc_id``. Ids are an integer list column, which ORC stores run-length
encoded in stripes; row indexes and a Bloom filter on ``doc_id`` let a
reader skip stripes and row groups, and Spark reads stripes in parallel.

A row also has ``part`` (its range) and ``local_start`` (ids before it in
that range). A document's global start is then its range's base plus
``local_start``; bases come from one sum per range, so no task sees more
than its own range and a list with one row per range.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netwatch.session import fresh_dir

from .common import batch, process_cache, slices, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MEMO_ENTRIES = 1_000_000
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}
STORED = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"

# A space starts a new piece unless it stands inside a longer run of white
# space; only such runs make cutting before every space unsafe.
_INSIDE_RUN = re.compile(r"\s (?:\s|\Z)")
_AFTER_WORD = re.compile(r"(?<=\S)(?= )")


# Byte-level alphabet: printable Latin-1 stands for itself, the other bytes
# for the code points from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}

# Fixed: the byte-level pre-tokenizer's pattern. Letters and white space of
# code points below U+0250 do not depend on a Unicode version; chunks beyond
# go to the library's own splitter.
_PIECE = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


# The same pattern for texts of Latin-1 characters only, its classes written
# out: a set of fixed ranges is matched several times faster.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_LATIN_PIECE = re.compile(
    f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class ChunkEncoder(dict):
    """Encodes texts with the ``tokenizers`` library, once per distinct
    chunk: chunk -> ids as little-endian 32-bit integers.

    The byte-level tokenizer cuts a text into pieces before merging. Texts
    of Latin-1 characters are cut into just these, so that a word is merged
    once whatever mark follows it. In other texts a
    space after a non-space (or before one) always begins a piece. Encoding
    the chunks between such places one by one gives the ids of the whole
    text. Texts where a cut could fall inside a run of white space are cut
    only after words; texts holding an added token go to the library whole.
    So do all texts when the file's own steps before merging are not plain
    byte-level ones: ``chunked`` is False.
    """

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.model = self.tokenizer.model
        self.word = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.chunked = self._plain()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _plain(self) -> bool:
        """Whether the file has no normalizer and cuts at byte-level pieces only."""
        # The one step's state: the file as a whole is large to parse again.
        step = self.tokenizer.pre_tokenizer
        cut = {} if step is None else json.loads(step.__getstate__())
        return (self.tokenizer.normalizer is None and cut.get("type") == "ByteLevel"
                and cut.get("add_prefix_space") is False and cut.get("use_regex", True) is True)

    def _chunks(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            return _LATIN_PIECE.findall(text)
        if "\0" in text or _INSIDE_RUN.search(text):
            return _AFTER_WORD.split(text)
        return text.replace(" ", "\0 ").split("\0")

    def __missing__(self, chunk: str) -> bytes:
        plain = chunk.isascii() or max(chunk) < "\u0250"
        if plain and chunk.removeprefix(" ").isalpha():
            ids = self._merge(chunk)  # letters are one piece
        elif plain:
            pieces = _PIECE.findall(chunk)
            if len(pieces) == 1:
                ids = self._merge(chunk)
            else:
                ids = b"".join([self[p] if len(p) < 24 else self._merge(p) for p in pieces])
        else:
            ids = self._library(chunk)
        if len(chunk) < 64:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[chunk] = ids
        return ids

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _merge(self, piece: str) -> bytes:
        """Ids of one piece; a space is U+0120 in the byte-level alphabet."""
        if piece.isascii() and piece[1:].isalpha():
            piece = piece.replace(" ", "\u0120")
        else:
            piece = piece.encode().decode("latin-1").translate(_ALPHABET)
        return b"".join([self.word[t.id] for t in self.model.tokenize(piece)])

    def __call__(self, text: str) -> bytes:
        if not self.chunked or any(t in text for t in self.added):
            return self._library(text)
        return b"".join(map(self.__getitem__, self._chunks(text)))


def tokenizer_file(name: str) -> str:
    """A path is used as it is; a bare name is looked up among the public
    tokenizer files, on the machine that runs the task."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per document in ascending ``doc_id``, ready to be written.

    Null text counts as empty and still gets the end id. Rows that share a
    ``doc_id`` are all kept, ordered by a hash of their text; a null
    ``doc_id`` sorts first. Extra columns are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_cache("encoder", tokenizer, lambda: ChunkEncoder(tokenizer))
        part, before = TaskContext.get().partitionId(), 0
        kind = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()),
                          ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])
        for rows in slices(batches):
            ids = [encoder(t or "") + end for t in rows.column(1).to_pylist()]
            sizes = np.fromiter((len(x) >> 2 for x in ids), np.int64, len(ids))
            ends = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(ids), "<i4")
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield batch(
                kind, rows.column(0), np.full(len(ids), part, np.int32), before + ends - sizes,
                sizes.astype(np.int32), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            before += int(ends[-1]) if len(ends) else 0

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    return ordered.mapInArrow(encode, STORED)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    encode_documents(docs, tokenizer, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; filters on ``doc_id`` reach stripe statistics, row
    indexes and Bloom filters."""
    return spark.read.schema(STORED).orc(path)


def token_index(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()),
                          ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for rows in slices(batches):
            lists = rows.column(3)
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(flat[e - n:e].tobytes()) for e, n in zip(ends, sizes)]
            yield batch(kind, *(rows.column(i) for i in range(3)), sizes, crc)

    rows = stored.select("doc_id", "part", "local_start", "ids").mapInArrow(
        digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    # One row per range: as many as the files, whatever the documents.
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_index(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the files below the shared folder, read them back, index them."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "llm", "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return token_index(read_tokens(spark, path))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_index(table(spark, sf_dir, "documents"))
