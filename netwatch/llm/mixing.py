"""Mixing sources to target weights, by budgets down a tree.

The tree is domain, language, source. Token supply is summed up the tree; a
node can absorb ``MAX_EPOCHS`` times its supply. The budget goes down: a
node's share is divided among its children by weight, and what a child
cannot absorb goes to its siblings, in proportion to their weights. Because
a child's limit is what its whole subtree can absorb, a shortage inside a
subtree is made up there first and reaches the node's own siblings only when
the subtree as a whole is short.

With the children of a node ordered by limit / weight, those that fill up
are a prefix: child i fills up when (budget - limits before i) is at least
its ratio times the weights from i on. The level of the others is the
largest such quotient among them. That is two running sums per node.

A leaf's target is whole epochs plus a rest. The rest is the longest prefix,
by tokens, of the documents in the order of a seeded hash of epoch and id.
The order is cut in 4096 buckets: sums per bucket show in which one the
prefix ends, only that one is ordered row by row, and the last hash in it
becomes the leaf's cutoff. Choosing documents is then a comparison per row,
however large a leaf is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialise, small, table

SEED = 20_240_601
MAX_EPOCHS = 4
BUDGET_SHARE = 1.0
# Target weights of the production run. Levels without weights are mixed in
# proportion to their supply.
LANGUAGE_WEIGHTS = {"en": 0.50, "de": 0.18, "fr": 0.18, "es": 0.14}
OTHER_WEIGHT = 0.05
DOMAINS = 4
# The registered query's targets, on every level and within two epochs. Some
# domains, languages and sources cannot absorb their share of it, so their
# shortage goes to siblings, and that of a whole domain to the other domains.
TARGETS = {
    "domain": {"domain0": 0.20, "domain1": 0.10, "domain2": 0.10, "domain3": 0.60},
    "lang": {"en": 0.40, "de": 0.18, "fr": 0.17, "es": 0.25},
    "source": {"src0": 1.0, "src1": 1.0, "src2": 1.0, "src3": 1.0},
}
TARGET_EPOCHS = 2
_PATH = ["domain", "lang", "source"]


def source_domain() -> Column:
    """Domain of a document: its source number modulo ``DOMAINS``, "other"
    for sources without a number."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint)")
    return F.coalesce(F.concat(F.lit("domain"), (number % DOMAINS).cast("string")), F.lit("other"))


def _order_key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _weight(level: str, weights: Mapping[str, Mapping[str, float]], other: float) -> Column:
    given = weights.get(level)
    if not given:
        return F.col("supply").cast("double")
    pairs = [x for name, w in given.items() for x in (F.lit(name), F.lit(float(w)))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(level)), F.lit(float(other)))


def _pour(nodes: DataFrame, parent: list[str], level: str, max_epochs: float) -> DataFrame:
    """nodes(parent..., level, supply, weight, budget of the parent) with the
    budget of each node in place of the parent's."""
    limit = F.col("supply") * F.lit(float(max_epochs))
    order = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(F.col("limit") / F.col("weight"), F.col(level))
    everyone = Window.partitionBy(*(parent or [F.lit(0)]))
    return (nodes.withColumn("limit", limit)
            .withColumn("before", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("quotient", (F.col("budget") - F.col("before")) / F.col("left"))
            .withColumn("full", F.col("quotient") * F.col("weight") >= F.col("limit"))
            .withColumn("water", F.max(F.when(~F.col("full"), F.col("quotient"))).over(everyone))
            .withColumn("budget", F.when(F.col("full"), F.col("limit")).otherwise(F.col("water") * F.col("weight")))
            .select(*parent, level, "supply", "budget"))


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, float]],
                 other_weight: float = OTHER_WEIGHT, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """domain, lang, source, supply, budget (tokens, double) of every leaf.
    ``leaves``: domain, lang, source, supply > 0. ``budget``: the whole
    budget as an expression over ``supply`` of the root."""
    root = leaves.agg(F.sum("supply").alias("supply")).select(budget.cast("double").alias("budget"))
    current = None
    for depth, level in enumerate(_PATH):
        parent = _PATH[:depth]
        nodes = leaves.groupBy(*parent, level).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(level, weights, other_weight)).filter("weight > 0")
        if current is None:
            nodes = nodes.join(F.broadcast(root))  # one row
        else:
            above = current.select(*(F.col(c).alias(f"__{c}") for c in parent), "budget")
            same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in parent]
            nodes = nodes.join(above, same).drop(*(f"__{c}" for c in parent))
        current = _pour(nodes, parent, level, max_epochs)
    return current


def plan(sized: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, float]], other_weight: float,
         max_epochs: float, seed: int) -> DataFrame:
    """Per leaf: whole epochs, and the cutoff of the order key in the epoch
    after them (null: no document of that epoch). ``sized``: doc_id, domain,
    lang, source, n_tokens > 0."""
    leaves = sized.groupBy(*_PATH).agg(F.sum("n_tokens").alias("supply"))
    targets = leaf_budgets(leaves, budget, weights, other_weight, max_epochs)
    # A budget is a real number; rounding keeps a full leaf whole.
    tokens = F.floor(F.round("budget", 3)).cast("long")
    targets = materialise(targets.select(
        *_PATH, F.expr("CAST(floor(round(budget, 3)) AS BIGINT) div supply").cast("int").alias("epochs"),
        (tokens % F.col("supply")).alias("rest")), "mix_targets")
    keyed = _with_leaf(sized, small(targets)).select(
        *_PATH, "n_tokens", "rest", _order_key(seed, F.col("epochs")).alias("key")).filter("rest > 0")
    sums = keyed.groupBy(*_PATH, "rest", F.substring("key", 1, 3).alias("bucket")).agg(F.sum("n_tokens").alias("n"))
    order = Window.partitionBy(*_PATH).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (sums.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
            .filter("before <= rest AND rest < before + n").select(*_PATH, "bucket", "before"))
    # Rows of one id share a key and are taken together or not at all.
    last = _with_leaf(keyed.withColumn("bucket", F.substring("key", 1, 3)), ends, ["bucket"])
    last = last.groupBy(*_PATH, "rest", "before", "bucket", "key").agg(F.sum("n_tokens").alias("n"))
    order = Window.partitionBy(*_PATH).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    taken = last.withColumn("upto", F.col("before") + F.sum("n").over(order)).filter("upto <= rest")
    # Without any key of its own bucket the prefix ends with the bucket before.
    cutoffs = ends.select(*_PATH, F.col("bucket").alias("end")).alias("e")
    cutoffs = _with_leaf(cutoffs, taken.groupBy(*_PATH).agg(F.max("key").alias("key")), how="left").select(
        *_PATH, F.coalesce("key", "end").alias("cutoff"))
    return small(materialise(_with_leaf(targets, cutoffs, how="left").select(*_PATH, "epochs", "cutoff"), "mix_plan"))


def _with_leaf(rows: DataFrame, leaves: DataFrame, also: list[str] = [], how: str = "inner") -> DataFrame:  # noqa: B006
    """``rows`` joined with per-leaf columns; null names equal null."""
    keys = [*_PATH, *also]
    named = leaves.select(*(F.col(c).alias(f"__{c}") for c in keys), *(c for c in leaves.columns if c not in keys))
    return rows.join(named, [rows[c].eqNullSafe(named[f"__{c}"]) for c in keys], how).drop(*(f"__{c}" for c in keys))


def _copies(seed: int) -> Column:
    chosen = F.coalesce(_order_key(seed, F.col("epochs")) <= F.col("cutoff"), F.lit(False))
    return F.col("epochs") + chosen.cast("int")


def _sized(docs: DataFrame, domain: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("n_tokens"),
    ).filter("n_tokens > 0")


def mix(docs: DataFrame, budget_share: float = BUDGET_SHARE, weights: Mapping[str, Mapping[str, float]] | None = None,
        other_weight: float = OTHER_WEIGHT, max_epochs: float = MAX_EPOCHS, seed: int = SEED,
        domain: Column | None = None) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch: one row per selected
    copy of a document row.

    The budget is ``budget_share`` of all tokens (words). ``weights`` maps a
    level ("domain", "lang", "source") to the weights of its nodes; nodes it
    does not name get ``other_weight``, levels it does not name are mixed by
    supply, a weight of 0 leaves a node out. Null languages and sources are
    nodes of their own. Documents without tokens are never selected. Rows
    that share a ``doc_id`` and leaf are selected together. Extra columns
    are ignored; an empty table gives an empty result.
    """
    sized = materialise(_sized(docs, source_domain() if domain is None else domain), "mix_sized")
    chosen = plan(sized, F.col("supply") * F.lit(float(budget_share)),
                  {"lang": LANGUAGE_WEIGHTS} if weights is None else weights, other_weight, max_epochs, seed)
    rows = _with_leaf(sized, chosen).withColumn("copies", _copies(seed)).filter("copies > 0")
    return rows.select("doc_id", *_PATH, "n_tokens",
                       F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))


def mixed_documents(docs: DataFrame, budget_share: float = BUDGET_SHARE,
                    weights: Mapping[str, Mapping[str, float]] | None = None, other_weight: float = OTHER_WEIGHT,
                    max_epochs: float = MAX_EPOCHS, seed: int = SEED, domain: Column | None = None) -> DataFrame:
    """The selected documents with all their columns, once per copy."""
    domain = source_domain() if domain is None else domain
    sized = materialise(_sized(docs, domain), "mix_sized")
    chosen = plan(sized, F.col("supply") * F.lit(float(budget_share)),
                  {"lang": LANGUAGE_WEIGHTS} if weights is None else weights, other_weight, max_epochs, seed)
    own = docs.select(F.struct("*").alias("__doc"), F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"),
                      F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    has_words = F.col("__doc.text").cast("string").rlike(WORD_PATTERN)
    rows = _with_leaf(own.filter(has_words), chosen).withColumn("copies", _copies(seed)).filter("copies > 0")
    return rows.select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__doc.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=TARGETS, max_epochs=TARGET_EPOCHS)
