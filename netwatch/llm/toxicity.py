"""Toxicity by class-conditional Kneser-Ney models of character sequences.

Two models, toxic and ordinary, give the probability of each character of a
word after the ``ORDER - 1`` before it (word marks included). Both discount
their own counts and back off to what they share: an interpolated
Kneser-Ney model of the counts of both classes, whose lower orders count
distinct left neighbours. ``PRIOR`` pseudo-counts of the shared model keep
rare expressions from deciding for either class.

Counts come from all labelled training texts, as grouped sums, and every
sequence enters the model however rare it is. The model is a pair of Spark
tables, of sequences and of contexts, and grows with the corpus. The distinct
words of the corpus are scored by joining their sequences to these tables,
the documents by joining their words to the scored words. The most frequent
sequences and words (at most ``HELD``) are sent to the workers, so that only
the rarer ones travel; this does not change a score.

A text's features are the difference of the two log-likelihoods per
character, the parts of it that come from words that either model clearly
prefers (``CLEAR``), and the length. Both sides count: which class has
expressions of its own depends on the labels. Labelled texts that the counts
have not seen turn the features into a probability (logistic, at most
``SAMPLE`` rows).
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch, materialise, process_cache, slices, table
from .language_id import held_out
from .logistic import Logistic
from .substring_dedup import packed_texts

ORDER = 6
DISCOUNT = 0.75
PRIOR = 30.0
SAMPLE = 20_000
CLEAR = (2.0, 3.0)
HELD = 300_000
_FLUSH = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_OPEN, _CLOSE = "\x02", "\x03"


def sequences(word: str, order: int = ORDER) -> list[str]:
    """For each character of the word and its end: it and the up to
    ``order`` - 1 characters before it."""
    marked = _OPEN + word + _CLOSE
    return [marked[max(0, i - order + 1):i + 1] for i in range(1, len(marked))]


def count_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """word, toxic, ordinary, n: how often each word occurs in the labelled
    texts of either class and in all texts. ``labels``: doc_id, label, one
    row per id."""
    kind = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        words: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())

        def flush() -> pa.RecordBatch:
            every = list(words[0].keys() | words[1].keys() | words[2].keys())
            toxic, ordinary = [words[1][w] for w in every], [words[0][w] for w in every]
            out = batch(kind, every, toxic, ordinary, [words[2][w] + t + o for w, t, o in zip(every, toxic, ordinary)])
            for own in words:
                own.clear()
            return out

        for rows in slices(batches):
            for blob, label in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                if blob is not None:
                    words[2 if label is None else label].update(_WORD.findall(press.decompress(blob).decode().lower()))
            if sum(map(len, words)) >= _FLUSH:
                yield flush()
        yield flush()

    # A shuffled join at every size: labels grow with the corpus.
    return (packed_texts(docs).join(labels.hint("merge"), "doc_id", "left").select("packed", F.col("label").cast("int").alias("label"))
            .mapInArrow(run, "word string, toxic long, ordinary long, n long")
            .groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "n"))))


def _sequences_of(words: DataFrame, order: int) -> DataFrame:
    """gram, toxic, ordinary: the sums over the words that have a sequence."""
    kind = pa.schema([("gram", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            every = list(grams[0].keys() | grams[1].keys())
            out = batch(kind, every, [grams[1][g] for g in every], [grams[0][g] for g in every])
            for own in grams:
                own.clear()
            return out

        for rows in slices(batches):
            for word, *counts in zip(*(c.to_pylist() for c in rows.columns)):
                for own, n in zip(grams, counts):
                    if n:
                        for gram in sequences(word, order):
                            own[gram] += n
            if sum(map(len, grams)) >= _FLUSH:
                yield flush()
        yield flush()

    return (words.filter("toxic + ordinary > 0").select("word", "ordinary", "toxic")
            .mapInArrow(run, "gram string, toxic long, ordinary long")
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def count_sequences(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, toxic, ordinary: how often each sequence occurs in the labelled
    texts of either class. ``labels``: doc_id, label, one row per id."""
    return _sequences_of(count_words(docs, labels), order)


_CONTEXT = "substring(gram, 1, length(gram) - 1)"


class Model:
    """Log-likelihood differences: ``ratios`` (gram, value, n) of sequences,
    ``left`` (context, value) of contexts for sequences that are not there."""

    def __init__(self, ratios: DataFrame, left: DataFrame):
        self.ratios, self.left = ratios, left

    @property
    def grams(self) -> dict[str, float]:
        """All sequences on the driver: for small models."""
        return {r.gram: r.value for r in self.ratios.collect()}


def _over(column: str, pieces: DataFrame, **sums) -> DataFrame:
    """Sums over the sequences that share a context: at most as many as
    there are characters."""
    same = Window.partitionBy("context")
    return pieces.withColumn("context", F.expr(_CONTEXT.replace("gram", column))).withColumns(
        {name: total.over(same) for name, total in sums.items()})


def _backoff(counts: DataFrame, order: int) -> DataFrame:
    """rest, shared: the probability of each shorter sequence in the shared
    model. Each sequence counts once for what follows its first character,
    whatever its frequency. One join per length: a sequence of one length
    has at most as many longer ones as there are characters."""
    pieces = counts.select(F.explode(F.expr(
        "transform(sequence(1, length(gram) - 1), i -> substring(gram, i))")).alias("piece")).distinct()
    lower = pieces.groupBy(F.expr("substring(piece, 2)").alias("gram")).agg(F.count("*").alias("n"))
    lower = materialise(_over("gram", lower, total=F.sum("n"), kinds=F.count("*"))
                        .select("gram", "n", "total", "kinds"), "toxic_lower")
    levels = []
    for size in range(1, order):
        own = lower.filter(F.length("gram") == size)
        own = (own.withColumn("shared", F.lit(1 / 256)) if size == 1 else
               own.join(levels[-1], F.expr("substring(gram, 2)") == F.col("rest")))
        levels.append(materialise(own.select(F.col("gram").alias("rest"), (
            (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("shared"))
            / F.col("total")).alias("shared")), "toxic_shared"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def build(counts: DataFrame, order: int = ORDER) -> Model:
    """The model of sequence counts, with all of them."""
    counts = materialise(counts, "toxic_counts")
    known = _over("gram", counts, all_toxic=F.sum("toxic"), all_ordinary=F.sum("ordinary"), kinds=F.count("*"),
                  toxic_kinds=F.count_if(F.col("toxic") > 0), ordinary_kinds=F.count_if(F.col("ordinary") > 0))
    pooled = ((F.greatest(F.col("toxic") + F.col("ordinary") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("shared"))
              / (F.col("all_toxic") + F.col("all_ordinary")))

    def unseen(label: str):
        return DISCOUNT * F.col(f"{label}_kinds") + PRIOR

    def probability(label: str):
        return ((F.greatest(F.col(label) - DISCOUNT, F.lit(0.0)) + unseen(label) * F.col("pooled"))
                / (F.col(f"all_{label}") + PRIOR))

    def difference(of):
        return F.log(of("toxic")) - F.log(of("ordinary"))

    ratios = (known.withColumn("rest", F.expr("substring(gram, 2)")).join(_backoff(counts, order), "rest")
              .withColumn("pooled", pooled)
              .select("gram", difference(probability).alias("value"), (F.col("toxic") + F.col("ordinary")).alias("n")))
    left = counts.groupBy(F.expr(_CONTEXT).alias("context")).agg(
        F.sum("toxic").alias("all_toxic"), F.count_if(F.col("toxic") > 0).alias("toxic_kinds"),
        F.sum("ordinary").alias("all_ordinary"), F.count_if(F.col("ordinary") > 0).alias("ordinary_kinds"))
    left = left.select("context", difference(lambda label: unseen(label) / (F.col(f"all_{label}") + PRIOR)).alias("value"))
    return Model(materialise(ratios, "toxic_ratios"), materialise(left, "toxic_left"))


def _held(rows: DataFrame, column: str, limit: int) -> dict[str, float]:
    """The values of the at most ``limit`` most frequent rows (all of a
    power of two of ``n`` or none)."""
    power = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    least, total = None, 0
    for r in sorted(rows.groupBy(power.alias("power")).count().collect(), key=lambda r: -r.power):
        total += r["count"]
        if total > limit:
            break
        least = r.power
    if least is None:
        return {}
    found = rows.filter(power >= least).select(column, "value").toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def _send(spark: SparkSession, values: dict[str, float]) -> tuple:
    sent = spark.sparkContext.broadcast(values)
    return sent, uuid.uuid4().hex


def word_values(words: DataFrame, model: Model, held: int, order: int = ORDER) -> DataFrame:
    """word, n, value: the log-likelihood difference of every word."""
    sent, name = _send(words.sparkSession, _held(model.ratios, "gram", held))
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("part", pa.float64()), ("rest", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = process_cache("toxicity_grams", name, lambda: sent.value)
        for rows in slices(batches):
            parts, rests = [], []
            for word in rows.column(0).to_pylist():
                total, rest = 0.0, []
                for gram in sequences(word, order):
                    value = known.get(gram)
                    if value is None:
                        rest.append(gram)
                    else:
                        total += value
                parts.append(total)
                rests.append(rest)
            yield batch(kind, rows.column(0), rows.column(1), parts, rests)

    own = materialise(words.select("word", "n").mapInArrow(run, "word string, n long, part double, rest array<string>")
                      .withColumn("row", F.monotonically_increasing_id()), "toxic_word_parts")
    open_ = own.select("row", F.explode("rest").alias("gram"))
    # Values of distinct sequences first: many words share the context of one.
    values = (open_.select("gram").distinct().join(model.ratios.select("gram", "value"), "gram", "left")
              .withColumn("context", F.expr(_CONTEXT))
              .join(model.left.withColumnRenamed("value", "instead"), "context", "left")
              .select("gram", F.coalesce("value", "instead", F.lit(0.0)).alias("value")))
    more = open_.join(values.hint("merge"), "gram").groupBy("row").agg(F.sum("value").alias("more"))
    return materialise(own.join(more, "row", "left").select(
        "word", "n", (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("value")), "toxic_words_scored")


def features(docs: DataFrame, values: DataFrame, held: int) -> DataFrame:
    """doc_id and features x of every row."""
    sent, name = _send(docs.sparkSession, _held(values, "word", held))
    sums = ["total", *(f"clear{i}" for i in range(len(CLEAR))), *(f"against{i}" for i in range(len(CLEAR)))]
    kind = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), *((c, pa.float64()) for c in sums),
                      ("rest", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = process_cache("toxicity_words", name, lambda: sent.value)
        for rows in slices(batches):
            sizes, found, rests = [], [], []
            for text in rows.column(1).to_pylist():
                words = _WORD.findall((text or "").lower())
                of = [known.get(w) for w in words]
                rests.append([w for w, v in zip(words, of) if v is None])
                there = np.array([v for v in of if v is not None], np.float64)
                sizes.append(max(20, sum(map(len, words)) + len(words)))
                found.append([there.sum(), *(there[there > c].sum() for c in CLEAR),
                              *(-there[there < -c].sum() for c in CLEAR)])
            found = np.array(found, np.float64).reshape(-1, len(sums))
            yield batch(kind, rows.column(0), sizes, *(np.ascontiguousarray(c) for c in found.T), rests)

    own = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "doc_id long, size long, " + ", ".join(f"{c} double" for c in sums) + ", rest array<string>")
        .withColumn("row", F.monotonically_increasing_id()), "toxic_text_parts")
    more = (own.select("row", F.explode("rest").alias("word")).join(values.select("word", "value").hint("merge"), "word")
            .groupBy("row").agg(F.sum("value").alias("more_total"), *(
                F.sum(F.when(sign * F.col("value") > c, sign * F.col("value"))).alias(f"more_{side}{i}")
                for side, sign in (("clear", 1), ("against", -1)) for i, c in enumerate(CLEAR))))

    def per_size(c: str):
        return (F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0))) / F.col("size")

    return materialise(own.drop("rest").join(more, "row", "left").select("doc_id", F.array(
        per_size("total"), *(F.log(1e-3 + per_size(c)) for c in sums[1:]), F.log("size")).alias("x")), "toxic_features")


def _judge(rows: DataFrame, curve: Logistic) -> DataFrame:
    kind = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield batch(kind, part.column(0), curve.probability(np.array(part.column(1).to_pylist(), float)))

    return rows.mapInArrow(run, "doc_id long, score double")


def calibration(known: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label of the ids that the counts leave out: of each label the
    same share, those with the lowest hash, a quarter of the ids or ``sample``
    when that is less. A label with one id only stays with the counts."""
    kinds = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    share = min(0.25, sample / max(1, sum(kinds.values())))
    order = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 53)).alias("order")
    found = []
    for label, n in kinds.items():
        take = math.ceil(n * share) if n > 1 else 0
        # Some more than are taken, not all ids, come to the driver.
        below = min(1.0, (take + 8 * math.sqrt(take) + 40) / n)
        drawn = known.filter(F.col("label") == label).select(order, "doc_id").filter(F.col("order") <= int(below * (1 << 53)))
        found += [(r.doc_id, label) for r in sorted(drawn.collect())[:take]]
    return known.sparkSession.createDataFrame(found, "doc_id long, label int")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held: int = HELD) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= 0.5) of every row.

    ``labels``: doc_id, label. A calibration sample is kept from the counts
    for the final fit, all other labelled texts are counted; see
    ``calibration``. Labels other than 0 and 1 and null ids are
    ignored; an id labelled twice counts as 1 if one label says so. Null
    and empty texts have no evidence and get what that is worth. Without
    labels of both kinds the score is a constant. Repeated rows are scored
    each; extra columns are ignored.
    """
    known = materialise(
        labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "label")
        .groupBy("doc_id").agg(F.max("label").alias("label")), "toxic_labels")
    apart = F.broadcast(calibration(known, sample))
    words = materialise(count_words(docs, known.join(apart, "doc_id", "left_anti")), "toxic_words")
    rows = features(docs, word_values(words, build(_sequences_of(words, ORDER)), held), held)
    found = rows.join(apart, "doc_id").select("x", "label").collect()
    curve = Logistic(np.array([r.x for r in found], float).reshape(-1, 2 + 2 * len(CLEAR)), np.array([r.label for r in found]))

    return _judge(rows, curve).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).filter(~held_out(5, 0))
    found = score(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")
