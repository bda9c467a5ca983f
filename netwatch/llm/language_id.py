"""Language of a text by compression.

For each language a zstandard dictionary of raw content is cut from a
bounded sample of labelled documents: at most ``SAMPLE_DOCS`` documents and
``DICTIONARY_BYTES`` bytes each, the only part of the corpus the model is
fitted on. A text is reduced to its lower-cased words of letters and
compressed once per language, in pieces of ``PIECE_BYTES``, so that a long
text is judged by the dictionaries and not by its own history. The smallest
total wins. A narrow margin between the two smallest totals is a rejection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch, slices, table

SAMPLE_DOCS = 96
DICTIONARY_BYTES = 100 * 1024
SAMPLE_CHARS = (200, 8000)
PIECE_BYTES = 2048
LEVEL = 9
# Relative difference of the two smallest totals below which a text is not
# accepted as the best language.
MIN_MARGIN = 0.02
# Bits of difference that count as one unit in the score.
BITS_PER_UNIT = 16.0
UNKNOWN = "und"
# Letters with their combining marks; numerals such as a half or a Roman
# eight are no letters.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MIN_CONTENT = 8       # bytes: zstandard takes no smaller dictionary


def held_out(folds: int, out: int) -> Column:
    """Whether crc32 of ``doc_id`` as text leaves the remainder ``out``."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % folds == out, F.lit(False))


def letters(text: str | None) -> bytes:
    return " ".join(_LETTERS.findall((text or "").lower())).encode()


def dictionaries(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """language -> raw content, the languages with most labelled documents
    first. A language whose documents hold fewer than ``MIN_CONTENT`` bytes of
    letters has no dictionary and is not learned. The content is from the ``sample_docs`` labelled documents
    of each language that a hash of the id puts first; documents within
    ``SAMPLE_CHARS`` characters come before others."""
    outside = (~F.length("text").between(*SAMPLE_CHARS)).cast("int")
    first = Window.partitionBy("lang").orderBy(outside, F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "text")
    chosen = (labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
              .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_docs)
              .select("lang", "n", F.substring("text", 1, size).alias("text")))
    content: dict[str, list[bytes]] = {}
    for row in chosen.orderBy("lang", "n").collect():
        content.setdefault(row.lang, []).append(letters(row.text))
    sizes = labelled.filter("lang IS NOT NULL").groupBy("lang").count().collect()
    out = {}
    for lang in [r.lang for r in sorted(sizes, key=lambda r: (-r["count"], r.lang)) if r.lang in content]:
        texts = content[lang]
        # A share for each document, so that a few long ones do not fill it.
        share = max(256, size // len(texts))
        joined = b" ".join([t[:share] for t in texts if t])[:size]
        if len(joined) >= MIN_CONTENT:
            out[lang] = joined
    return out


class Classifier:
    def __init__(self, contents: Mapping[str, bytes], level: int = LEVEL):
        self.languages = list(contents)
        self.coders = []
        for lang in self.languages:
            known = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(
                level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        """Compressed bytes of a text for each language."""
        pieces, at = [], 0
        while at < len(text):
            end = at + PIECE_BYTES
            if end < len(text):
                end = text.rfind(b" ", at, end) + 1 or end
                end = end if end > at else at + PIECE_BYTES
            pieces.append(text[at:end])
            at = end
        return [sum(len(c.compress(p)) for p in pieces) for c in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (0 to 1), relative margin. Equal sizes: the
        language that comes first in the contents."""
        clean = letters(text)
        if not clean or not self.languages:
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(clean)
        best = sizes.index(min(sizes))
        units = [(sizes[best] - s) * 8 / BITS_PER_UNIT for s in sizes]
        score = 1.0 / sum(math.exp(max(-700.0, u)) for u in units)
        rest = [s for i, s in enumerate(sizes) if i != best]
        margin = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
        return self.languages[best], score, margin


def predict(docs: DataFrame, contents: Mapping[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, margin, accepted of every row.

    ``lang_pred`` is the best language; texts that are null or have no
    letter (and all texts, when no language was learned) are ``und`` with
    score 0. ``accepted`` is false for those and for margins below
    ``min_margin``: a caller that must not guess treats them as unknown.
    Repeated rows are judged each; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dict(contents))
    kind = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                      ("margin", pa.float64()), ("accepted", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(sent.value)
        for rows in slices(batches):
            found = [classify(t) for t in rows.column(1).to_pylist()]
            lang, score, margin = (list(x) for x in zip(*found)) if found else ([], [], [])
            yield batch(kind, rows.column(0), lang, score, margin,
                        [x != UNKNOWN and m >= min_margin for x, m in zip(lang, margin)])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, margin double, accepted boolean"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    contents = dictionaries(docs.filter(~held_out(4, 2)))
    return predict(docs, contents).select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "margin", "accepted")
