"""Quality rules with robust multivariate outliers.

Every text becomes a vector of transformed statistics. Per language and
source, a minimum-covariance-determinant estimate gives the centre and
spread of the bulk of the documents; a document whose Mahalanobis distance
is far beyond what that bulk allows is rejected. Fixed base rules come
first, and documents that fail them take no part in the estimates.

The estimate starts from three places (medians with quartile ranges, the
shortest half of each coordinate, medians with the smallest spreads) and takes
concentration steps from each: distances under the current estimate, the
quantile below which a share ``COVERAGE`` of a site's documents lie, then mean
and covariance of those. The smallest determinant wins. Half of the documents
is the share that withstands most junk: a core of more must contain some of it
once a site has more junk than the rest. Each step is a grouped quantile
sketch and grouped sums over all documents, so a site with a third of all rows
is pre-aggregated like any other. A site takes steps until its own
determinant stands still, whatever the others do.

Every site has its own estimate, however small. It is shrunk towards that of
its language, which is shrunk towards that of all documents: n documents
weigh n / (n + ``PRIOR``), and the covariance is that of the mixture, so a
site whose centre is elsewhere gets a wider spread while it is small.

Most coordinates are roots of counts over a size. A root of a count has a
variance of about a quarter whatever its mean, so size alone gives the
resolution of a coordinate. The mean resolution of a site is added to its
covariance (clean text often has no symbol at all); deviations of a text
that is shorter than usual are measured in its own, coarser resolution.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch, materialise, rolling_hash, slices, small, table, word_hashes

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
COVERAGE = 0.5
# A bound on the steps of a site; they settle in about five.
STEPS = 20
# Documents that a language's estimate counts for in that of a site.
PRIOR = 50
# A document is rejected beyond this upper tail of the distance of a normal
# vector; the statistics have longer tails, so the level is far out.
TAIL = 1e-6
DIMENSIONS = 6
# Resolution of each coordinate: this much over a size, words (with 10 added)
# or characters (with 40). A window that is found twice marks eight words.
_RESOLUTION = (("per_char", 1), ("per_word", 1), ("per_word", REPEAT_WINDOW), ("per_word", 1),
               ("per_char", 1), ("per_char", 1))

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_MARKS = b"!?;:.,\"'()[]{}=+-_/\\@~^`"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_X = [f"x{i}" for i in range(DIMENSIONS)]


def text_counts(text: bytes | None) -> tuple[list[int], list[float]]:
    """The counts of the base rules, and the statistic vector: roots of the
    shares of symbols, doubled words, words in repeated windows, capitals
    and marks, and the log of the mean word length."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    chars = len(text.translate(None, _SPACE + _CONTINUATION))
    symbols = size - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    hashes = word_hashes(words)
    doubled = int((hashes[1:] == hashes[:-1]).sum())
    repeated = 0
    if n > REPEAT_WINDOW:
        rolling = rolling_hash(hashes, REPEAT_WINDOW)
        _, which, times = np.unique(rolling, return_inverse=True, return_counts=True)
        if len(times) < len(rolling):
            twice = times[which] > 1
            edge = np.zeros(n + 1, np.int64)
            edge[:len(twice)] += twice
            edge[REPEAT_WINDOW:] -= twice
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    upper = size - len(text.translate(None, _UPPER))
    lower = size - len(text.translate(None, _LOWER))
    marks = size - len(text.translate(None, _MARKS))
    # Short texts give noisy shares: each share is taken over a few more
    # characters or words than there are.
    vector = [
        math.sqrt(symbols / (chars + 40)),
        math.sqrt(doubled / (n + 10)),
        math.sqrt(repeated / (n + 10)),
        math.log((chars + 50.0) / (n + 10)),
        math.sqrt(upper / (upper + lower + 40)),
        math.sqrt(marks / (chars + 40)),
    ]
    return [n, chars, symbols, len(lines) - len(set(lines)), repeated], vector


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, counts, base_failed and the vector x0.. of every row."""
    kind = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
                     + [(c, pa.int64()) for c in _COUNTS] + [(c, pa.float64()) for c in _X])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = [text_counts(t) for t in as_bytes(rows.column(3))]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(_COUNTS))
            vectors = np.array([v for _, v in found], np.float64).reshape(-1, DIMENSIONS)
            yield batch(kind, *(rows.column(i) for i in range(3)),
                        *(np.ascontiguousarray(c) for c in counts.T), *(np.ascontiguousarray(v) for v in vectors.T))

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(
        F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    schema = ("doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", "
              + ", ".join(f"{c} double" for c in _X))
    return _sized(chosen.mapInArrow(run, schema))


def _sized(rows: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and the variances that the text's size alone gives."""
    return (rows.withColumn("base_failed", _base_failed())
            .withColumn("per_word", 0.25 / (F.col("n_words") + 10))
            .withColumn("per_char", 0.25 / (F.col("word_chars") + 40)))


def _base_failed():
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _upper_tail(x: float, dof: int) -> float:
    """P(chi-square with an even number of degrees of freedom > x)."""
    term, total = 1.0, 1.0
    for k in range(1, dof // 2):
        term *= x / 2 / k
        total += term
    return math.exp(-x / 2) * total


def _quantile(tail: float, dof: int) -> float:
    low, high = 0.0, 10_000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _upper_tail(mid, dof) > tail else (low, mid)
    return high


def _distance(deviation=lambda j: F.col(f"x{j}") - F.col(f"c{j}")):
    """Squared Mahalanobis distance from centre c0.. with whitener w00.. ."""
    total = F.lit(0.0)
    for i in range(DIMENSIONS):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + F.col(f"w{i}{j}") * deviation(j)
        total = total + row * row
    return total


def _own(j: int):
    """Deviation of a coordinate, scaled down as far as the text's own
    resolution is coarser than its site's."""
    size, times = _RESOLUTION[j]
    coarser = F.greatest(F.lit(0.0), times * (F.col(size) - F.col(f"site_{size}")))
    return (F.col(f"x{j}") - F.col(f"c{j}")) / F.sqrt(1 + coarser / F.col(f"v{j}{j}"))


_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
_SIZES = ["per_word", "per_char"]
# Of a site and start: documents, mean resolutions, centre, covariance,
# inverse Cholesky factor.
_ESTIMATE = (["docs"] + [f"site_{c}" for c in _SIZES] + [f"c{i}" for i in range(DIMENSIONS)]
             + [f"v{i}{j}" for i, j in _PAIRS] + [f"w{i}{j}" for i, j in _PAIRS])
_STEP = ["logdet", "moved", *_ESTIMATE]


def _matrix(entries: list[float]) -> np.ndarray:
    out = np.zeros((DIMENSIONS, DIMENSIONS))
    for (i, j), value in zip(_PAIRS, entries):
        out[i, j] = out[j, i] = value
    return out


def _entries(matrix: np.ndarray) -> list[float]:
    return [float(matrix[i, j]) for i, j in _PAIRS]


def _inverse_factor(covariance: np.ndarray) -> np.ndarray:
    return np.linalg.inv(np.linalg.cholesky(covariance))


def _whiten(sums: DataFrame, scale: float) -> DataFrame:
    """Per site and start: (documents of the core, last determinant, what
    stays, old centre, sums of deviations and their products) -> the estimate
    of the core, and how far the determinant moved."""
    names = ["site", "start", *_STEP]
    schema = "site string, start int, " + ", ".join(f"{c} double" for c in _STEP)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(c, pa.string() if c == "site" else pa.int32() if c == "start" else pa.float64()) for c in names])
        for rows in batches:
            out = []
            for site, start, n, last, docs, per_word, per_char, *rest in zip(*(c.to_pylist() for c in rows.columns)):
                sizes = {"per_word": per_word, "per_char": per_char}
                old = np.array(rest[:DIMENSIONS])
                mean = np.array(rest[DIMENSIONS:2 * DIMENSIONS]) / n
                cov = _matrix(rest[2 * DIMENSIONS:]) / n - np.outer(mean, mean)
                cov = cov * scale + np.diag([times * sizes[size] for size, times in _RESOLUTION])
                logdet = np.linalg.slogdet(cov)[1]
                out.append((site, start, logdet, abs(logdet - last), docs, per_word, per_char, *(old + mean),
                            *_entries(cov), *_entries(_inverse_factor(cov))))
            if out:
                yield batch(kind, *map(list, zip(*out)))

    return sums.mapInArrow(solve, schema)


def _shrunk(levels: DataFrame, prior: float) -> DataFrame:
    """lang, source, e0, e1, e2 (estimates of the site, its language, all
    documents; the first two may be null) -> lang, source, estimate."""
    kind = pa.schema([("lang", pa.string()), ("source", pa.string())] + [(c, pa.float64()) for c in _ESTIMATE])
    centre, spread = 3, 3 + DIMENSIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for lang, source, *nested in zip(*(c.to_pylist() for c in rows.columns)):
                docs = None
                for e in reversed(nested):
                    if e is None:
                        continue
                    e = [e[c] for c in _ESTIMATE]
                    mean = np.array(e[:spread])
                    cov = _matrix(e[spread:spread + len(_PAIRS)])
                    if docs is None:
                        docs, total, parent = e[0], mean, cov
                        continue
                    share = e[0] / (e[0] + prior)
                    apart = mean[centre:] - total[centre:]
                    parent = share * cov + (1 - share) * parent + share * (1 - share) * np.outer(apart, apart)
                    docs, total = e[0], share * mean + (1 - share) * total
                if docs is not None:
                    out.append((lang, source, docs, *total[1:], *_entries(parent), *_entries(_inverse_factor(parent))))
            if out:
                yield batch(kind, *map(list, zip(*out)))

    return levels.mapInArrow(run, "lang string, source string, " + ", ".join(f"{c} double" for c in _ESTIMATE))


def _starts(levels: DataFrame) -> DataFrame:
    """Three centres with independent spreads, from the quantiles of a site."""
    marks = levels.groupBy("site").agg(*(
        F.percentile_approx(f"x{i}", [k / 20 for k in range(21)]).alias(f"q{i}") for i in range(DIMENSIONS)),
        F.count("*").cast("double").alias("docs"), *(F.avg(c).alias(f"site_{c}") for c in _SIZES))
    marks = materialise(marks, "mcd_marks")

    def medians(i: int):
        return F.col(f"q{i}")[10], (F.col(f"q{i}")[15] - F.col(f"q{i}")[5]) / 1.349

    def shortest(i: int):
        q = F.col(f"q{i}")
        half = F.array_min(F.array(*(F.struct((q[k + 10] - q[k]).alias("length"), q[k].alias("low")) for k in range(11))))
        return half["low"] + half["length"] / 2, half["length"] / 1.349

    def nearest(i: int):
        return F.col(f"q{i}")[10], F.lit(0.0)

    out = None
    for start, of in enumerate((medians, shortest, nearest)):
        centres, spreads = zip(*(of(i) for i in range(DIMENSIONS)))
        variances = [s * s + times * F.col(f"site_{size}") for s, (size, times) in zip(spreads, _RESOLUTION)]
        one = marks.select(
            "site", F.lit(start).alias("start"), *(F.lit(float("inf")).alias(c) for c in ("logdet", "moved")),
            "docs", *(f"site_{c}" for c in _SIZES), *(c.alias(f"c{i}") for i, c in enumerate(centres)),
            *((variances[i] if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i, j in _PAIRS),
            *((1 / F.sqrt(variances[i]) if i == j else F.lit(0.0)).alias(f"w{i}{j}") for i, j in _PAIRS))
        out = one if out is None else out.unionByName(one)
    return out


def estimates(stats: DataFrame, prior: float = PRIOR, coverage: float = COVERAGE, steps: int = STEPS) -> DataFrame:
    """lang, source and their estimate, shrunk towards their language's and
    that towards the one of all documents. Languages and sources none of
    whose documents passed the base rules take their parent's."""
    good = stats.filter(~F.col("base_failed")).select("lang", "source", *_SIZES, *_X)
    sites = [F.to_json(F.array("lang", "source")), F.to_json(F.array("lang")), F.lit("[]")]
    levels = materialise(good.select(F.explode(F.array(*sites)).alias("site"), *_SIZES, *_X), "mcd_levels")

    # Covariance of the central share of a normal, scaled to the whole.
    inner = _quantile(1 - coverage, DIMENSIONS)
    scale = coverage / (1 - _upper_tail(inner, DIMENSIONS + 2))
    moving, settled = materialise(_starts(levels), "mcd"), []
    fixed = ["logdet", "docs", *(f"site_{c}" for c in _SIZES), *(f"c{i}" for i in range(DIMENSIONS))]
    for _ in range(steps):
        measured = levels.join(small(moving), "site").withColumn("d2", _distance())
        edge = materialise(measured.groupBy("site", "start").agg(F.percentile_approx("d2", coverage).alias("edge")), "mcd_edge")
        centred = measured.join(small(edge), ["site", "start"]).filter("d2 <= edge").select(
            "site", "start", *fixed, *((F.col(f"x{i}") - F.col(f"c{i}")).alias(f"y{i}") for i in range(DIMENSIONS)))
        sums = centred.groupBy("site", "start").agg(
            F.count("*").alias("n"), *(F.first(c).alias(c) for c in fixed),
            *(F.sum(f"y{i}").alias(f"s{i}") for i in range(DIMENSIONS)),
            *(F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"p{i}{j}") for i, j in _PAIRS))
        step = materialise(_whiten(sums, scale), "mcd")
        settled.append(step.filter("moved < 1e-3"))
        moving = step.filter("moved >= 1e-3")
        if moving.isEmpty():
            break
    for one in settled:
        moving = moving.unionByName(one)
    best = moving.groupBy("site").agg(F.min(F.struct("logdet", "start", *_ESTIMATE)).alias("e"))
    best = materialise(best.select("site", F.struct(*(F.col(f"e.{c}").alias(c) for c in _ESTIMATE)).alias("e")), "mcd")
    named = stats.select("lang", "source").distinct().select(
        "lang", "source", *(s.alias(f"site{i}") for i, s in enumerate(sites)))
    for i in range(3):
        named = named.join(best.select(F.col("site").alias(f"site{i}"), F.col("e").alias(f"e{i}")), f"site{i}", "left")
    return _shrunk(named.select("lang", "source", "e0", "e1", "e2"), prior)


def _verdict(rows: DataFrame, estimate: DataFrame, tail: float) -> DataFrame:
    """Adds ``distance`` and ``kept``; rows of a language and source without any estimate
    (no document passed the base rules) are judged by the base rules alone."""
    e = estimate.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *_ESTIMATE)
    same = rows["lang"].eqNullSafe(e["__lang"]) & rows["source"].eqNullSafe(e["__source"])
    far = F.coalesce(F.col("distance") > _quantile(tail, DIMENSIONS), F.lit(False))
    return (rows.join(e, same, "left").withColumn("distance", _distance(_own))
            .withColumn("kept", ~F.col("base_failed") & ~far))


def quality_rules(docs: DataFrame, prior: float = PRIOR, coverage: float = COVERAGE,
                  tail: float = TAIL) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance (squared Mahalanobis) of every row.

    Null and empty texts have no words and fail the base rules. Null
    languages and sources are sites like any other. Repeated rows count each
    time; ties at the quantile all count. Extra columns are ignored; an
    empty table gives an empty result.
    """
    stats = materialise(statistics(docs), "quality_stats")
    judged = _verdict(stats, small(materialise(estimates(stats, prior, coverage), "mcd_sites")), tail)
    return judged.select("doc_id", *_COUNTS, "base_failed", "kept", "distance")


def accepted(docs: DataFrame, prior: float = PRIOR, coverage: float = COVERAGE, tail: float = TAIL) -> DataFrame:
    """The documents that pass, with all their columns. The statistics are
    computed once for the estimates and again next to the text, which is
    cheaper than moving every text to its statistics."""
    estimate = small(materialise(estimates(materialise(statistics(docs), "quality_stats"), prior, coverage), "mcd_sites"))

    @F.arrow_udf("struct<n_words: long, word_chars: long, n_repeat_words: long, x: array<double>>")
    def vector(text: pa.Array) -> pa.Array:
        found = [text_counts(t) for t in as_bytes(text)]
        kind = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_repeat_words", pa.int64()),
                          ("x", pa.list_(pa.float64()))])
        return pa.array([(c[0], c[1], c[4], v) for c, v in found], kind)

    own = docs.select(F.struct("*").alias("__doc"), vector.asNondeterministic()(
        F.col("text").cast("string")).alias("__q"))
    rows = own.select("__doc", F.col("__doc.lang").cast("string").alias("lang"),
                      F.col("__doc.source").cast("string").alias("source"),
                      "__q.n_words", "__q.word_chars", "__q.n_repeat_words", *(F.col("__q.x")[i].alias(f"x{i}") for i in range(DIMENSIONS)))
    judged = _verdict(_sized(rows), estimate, tail)
    return judged.filter("kept").select("__doc.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
