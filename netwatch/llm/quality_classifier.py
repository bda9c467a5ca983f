"""Quality of documents from their text and their site.

A logistic model over text statistics, fitted on a bounded sample of
labelled rows (``SAMPLE`` rows at most), gives each document its evidence.
Sites refine it by empirical Bayes: expected good documents are summed per
host and per path, the spread between hosts (and between the paths of a
host) tells how much a site's own share counts, and sparse sites shrink
towards their host, hosts towards the whole. Both levels are grouped sums
over all documents, pre-aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch, materialise, slices, table
from .language_id import held_out
from .logistic import Logistic
from .quality_rules import text_counts

SAMPLE = 20_000
FEATURES = 8
# Strength of a prior, in documents: limits for what the spread suggests.
STRENGTH = (2.0, 10_000.0)


def features(text: bytes | None) -> list[float]:
    """Text statistics, with repeated lines and the length."""
    counts, vector = text_counts(text)
    return [*vector, counts[3] / (counts[3] + 5.0), min(1.0, counts[0] / 50.0)]


def described(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path, x (features) of every row."""
    kind = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                      ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            yield batch(kind, *(rows.column(i) for i in range(3)), [features(t) for t in as_bytes(rows.column(3))])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"),
                       path.cast("string").alias("path"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, host string, path string, x array<double>")


def fit(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Logistic:
    """``labels``: doc_id, label (0 or 1). The rows whose id hashes lowest
    are the sample."""
    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    drawn = rows.join(known, "doc_id").select("doc_id", "x", "label").orderBy(F.xxhash64("doc_id"), "x").limit(sample)
    found = drawn.collect()
    return Logistic(np.array([r.x for r in found], float).reshape(-1, FEATURES), np.array([r.label for r in found]))


def _strength(groups: DataFrame, mean: Column, share: Column, n: Column) -> float:
    """Prior strength by the method of moments: how far shares of groups lie
    from their means beyond what their sizes explain."""
    spread = mean * (1 - mean)
    row = groups.filter(n > 1).agg(
        F.sum(n * (share - mean) ** 2 - spread).alias("excess"),
        F.sum((n - 1) * spread).alias("room")).first()
    if not row.room or row.room <= 0:
        return STRENGTH[1]
    within = max(row.excess / row.room, 1e-9)  # share of the variance that lies between groups
    return float(min(max(1 / within - 1, STRENGTH[0]), STRENGTH[1]))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, score, predicted, kept
    of every row.

    ``evidence`` is the text model's probability of a good document;
    ``path_posterior`` is the share of good documents on the path, without
    the row itself, shrunk towards its host's and the overall share;
    ``score`` combines both (the evidence's logit, moved by the path's
    distance from the overall share). Null hosts and paths are sites like
    any other; null and empty texts have no words and are judged by that.
    Labels other than 0 and 1 are ignored, an id labelled twice counts as 1
    if one label says so; without labels of both kinds the evidence is a
    constant. Repeated rows count each. Extra columns are ignored.
    """
    rows = materialise(described(docs, host, path), "quality_features")
    model = fit(rows, labels, sample)
    kind = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("logit", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = part.column(3).flatten().to_numpy(zero_copy_only=False)
            yield batch(kind, *(part.column(i) for i in range(3)), model.logit(x))

    judged = materialise(rows.mapInArrow(judge, "doc_id long, host string, path string, logit double")
                         .withColumn("p", 1 / (1 + F.exp(-F.col("logit")))), "quality_evidence")
    paths = materialise(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "quality_paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    overall = min(max((total[1] or 0.0) / total[0], 1e-6), 1 - 1e-6) if total[0] else 0.5
    k_host = _strength(hosts, F.lit(overall), F.col("host_good") / F.col("host_n"), F.col("host_n"))
    hosts = hosts.withColumn("host_posterior", (F.col("host_good") + k_host * overall) / (F.col("host_n") + k_host))
    sites = paths.join(hosts.withColumnRenamed("host", "__host"), F.col("host").eqNullSafe(F.col("__host"))).drop("__host")
    k_path = _strength(sites, F.col("host_posterior"), F.col("good") / F.col("n"), F.col("n"))
    sites = materialise(sites.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "n", "good",
                                     "host_posterior"), "quality_sites")
    same = judged["host"].eqNullSafe(sites["__host"]) & judged["path"].eqNullSafe(sites["__path"])
    own = (F.col("good") - F.col("p") + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    own = F.least(F.greatest(own, F.lit(1e-6)), F.lit(1 - 1e-6))
    moved = F.col("logit") + F.ln(F.col("path_posterior") / (1 - F.col("path_posterior"))) - float(np.log(overall / (1 - overall)))
    return (judged.join(sites, same).withColumn("path_posterior", own)
            .withColumn("score", 1 / (1 + F.exp(-moved)))
            .select("doc_id", F.col("p").alias("evidence"), "host_posterior", "path_posterior", "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: the source stands for the host, source and
    language for the path. Labels of one id in five are held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(~held_out(5, 0))
    found = classify(table(spark, sf_dir, "documents"), labels, F.col("source"),
                     F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))))
    return found.withColumn("held_out", held_out(5, 0))
