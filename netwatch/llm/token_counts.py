"""Token counts of a unigram vocabulary, without building the tokens.

A text is cut at Unicode white space; each word gets the word mark in front
and is cut before every further mark, as a metaspace pre-tokenizer does. An
Aho-Corasick automaton over the vocabulary yields every piece that ends at a
position, and dynamic programming over positions carries the best score and
the piece count of the best segmentation.

Tie rule of the tokenizer: a later candidate replaces an earlier one only
with a strictly higher score, and candidates come in order of their start.
At one end the automaton yields the longest piece, that is the smallest
start, first, so the same strict comparison applies. A character that no
one-character piece covers is an unknown with a score 10 below the lowest
piece; runs of unknowns fuse into one token, or, when the vocabulary has all
byte pieces, count one token per byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, process_cache, slices, table
from .token_output import tokenizer_file

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_ENTRIES = 500_000
# The Unicode White_Space property, fixed by the standard.
_WORD = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_MARKED = re.compile(f"{MARK}[^{MARK}]*")


class PieceCounter(dict):
    """word -> number of tokens; computed on first use, forgotten when the
    memo is full."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]], unknown: str = "<unk>"):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        pieces = {p for p, _ in vocabulary}
        self.by_bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        marked = word if word.startswith(MARK) else MARK + word
        n = sum(self.viterbi(part) for part in _MARKED.findall(marked))
        if len(word) < 64:
            self[word] = n
        return n

    def viterbi(self, text: str) -> int:
        """Tokens of the best segmentation of ``text``."""
        score, count, unknown = [0.0], [0], [False]
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        found = next(matches, None)
        for end in range(len(text)):
            best, pieces, fused, single = None, 0, False, False
            while found is not None and found[0] == end:
                size, value = found[1]
                start = end + 1 - size
                if best is None or score[start] + value > best:
                    best, pieces, fused = score[start] + value, count[start] + 1, False
                single = single or size == 1
                found = next(matches, None)
            if not single and (best is None or score[end] + self.unknown > best):
                best, fused = score[end] + self.unknown, True
                pieces = count[end] + (len(text[end].encode()) if self.by_bytes else not unknown[end])
            score.append(best)
            count.append(pieces)
            unknown.append(fused)
        return int(count[-1])


def load_vocabulary(name: str = VOCABULARY) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without its control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not model.is_control(i)]


def token_counts(docs: DataFrame, vocabulary: str | Sequence[tuple[str, float]] = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens (long) of every whole text; null and empty texts
    have 0. One row per input row, repeated rows included; extra columns are
    ignored. ``vocabulary``: a sentencepiece file, or (piece, score) pairs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        if isinstance(vocabulary, str):
            counter = process_cache("pieces", vocabulary, lambda: PieceCounter(load_vocabulary(vocabulary)))
        else:
            counter = PieceCounter(vocabulary)
        for rows in slices(batches):
            yield batch(kind, rows.column(0), [
                sum(map(counter.__getitem__, _WORD.findall(t))) if t else 0 for t in rows.column(1).to_pylist()])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(count, "doc_id long, n_tokens long"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
