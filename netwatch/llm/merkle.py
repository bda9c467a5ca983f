"""Merkle manifest of a document table, climbed by a recursive query.

Every row is a leaf, every run of ``ARITY`` digests has its digest one level
up, first within a source, then over the sources. Each inner node is stored
as a row that names its parent and its place below it, with the digests of
its run. A recursive query then starts at every leaf, with the digest of its
tampered row where there is one, and ascends from parent to parent: each
step puts the digest at its place into the run, folds the run, and appends
the run and the place, which together name the siblings, to the leaf's path.

Siblings are appended by reference and spelled out afterwards, once per run
of leaves instead of once per leaf: everything above a run is the same for
all of its leaves, and carrying it as text through every step would move
several kilobytes per document and level.

Places come from one range sort: a row's number is its place in its task's
sorted part plus the rows of the parts before, so no source has to fit into
a task.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small, table

ARITY = 16
HEX = 64            # characters of a digest
LEVELS = 64         # node ids leave six bits for the level
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 5


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row: each field is '-' if null, else its UTF-8 byte
    count, ':' and its value."""
    parts = []
    for name in FIELDS:
        text = values[name].cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, tampered (the digest of the tampered row, null
    for rows that are left alone)."""
    own = {name: F.col(name) for name in FIELDS}
    changed = own | {"text": F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)}
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        leaf_digest(own).alias("leaf"), F.when(hit, leaf_digest(changed)).alias("tampered"))


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df`` with ``place``: the row's number from 0 in the given order.

    One range exchange; the driver gets one count per task of it. Rows that
    are equal in all of ``order`` are numbered in any, but fixed, order.
    """
    spark = df.sparkSession
    written = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    before, offsets = 0, []
    for row in written.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((row["part"], before))
        before += row["count"]
    starts = spark.createDataFrame(offsets, "__part long, __before long")
    return (written.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn("place", F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1))
            .drop("__at", "__part", "__before"))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: place, doc_id, leaf, tampered, sid, up, pos.
    ``nodes``: id, up (null at the root), pos, run (the digests below).
    ``subroots``: sid, source, subroot. ``root``: a digest, None if there is
    no row. A source's number ``sid`` is its place among the sources."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _place_above(level: int) -> tuple[Column, Column]:
    """Id of the parent of a source's node at ``level`` and the place below
    it. A node's id is the place of its first leaf and its level; above the
    sources ids are negative: number and level there."""
    width = ARITY ** (level + 1)
    inside = (F.col("start") + F.floor(F.col("idx") / F.lit(ARITY)).cast("long") * width) * LEVELS + (level + 1)
    over = F.when(F.col("sources") > 1, -(F.floor(F.col("sid") / F.lit(ARITY)).cast("long") * LEVELS + 1))
    return (F.when(F.col("height") > level, inside).otherwise(over).alias("up"),
            F.pmod(F.when(F.col("height") > level, F.col("idx")).otherwise(F.col("sid")), F.lit(ARITY))
            .cast("int").alias("pos"))


def _runs(level: DataFrame, *keys: str) -> DataFrame:
    """Runs of up to ``ARITY`` consecutive digests as text, in order."""
    ordered = F.sort_array(F.collect_list(F.struct("idx", "digest")))
    return (level.groupBy(*keys, F.floor(F.col("idx") / F.lit(ARITY)).cast("long").alias("above"))
            .agg(F.array_join(F.transform(ordered, lambda x: x["digest"]), "").alias("run"))
            .withColumnRenamed("above", "idx").withColumn("digest", F.sha2("run", 256)))


def build(docs: DataFrame) -> Manifest:
    """Leaves, inner nodes, subroots and root of a document table.

    Rows are ordered by ``doc_id`` within a source, a null id first, rows of
    one id by their digests; a null source is a source of its own, the
    first. Needs the columns of ``documents``; others are ignored.
    """
    placed = numbered(materialise(leaves(docs), "merkle_leaf"), "merkle_sorted", "source", "doc_id", "leaf")
    by_source = placed.groupBy("source").agg(F.min("place").alias("start"), F.count("*").alias("n"))
    by_source = by_source.withColumn("height", F.size(F.filter(
        F.array(*[F.lit(ARITY ** h) for h in range(15)]), lambda width: F.col("n") > width)))
    sources = numbered(by_source, "merkle_sources", "start").withColumnRenamed("place", "sid")
    count, tallest = sources.agg(F.count("*"), F.max("height")).first()
    sources = sources.withColumn("sources", F.lit(count))
    of = small(sources.withColumnRenamed("source", "__source"))
    level = (placed.join(of, F.col("source").eqNullSafe(F.col("__source")))
             .withColumn("idx", F.col("place") - F.col("start")).withColumnRenamed("leaf", "digest")
             .select("place", "doc_id", "digest", "tampered", "sid", "start", "height", "sources", "idx",
                     *_place_above(0)))
    level = base = materialise(level, "merkle_base")
    keys = ["sid", "start", "height", "sources"]
    done, nodes = [base.filter("height = 0").select("sid", "digest")], []
    for h in range(1, (tallest or 0) + 1):
        level = _runs(level.filter(F.col("height") >= h), *keys)
        level = materialise(level.withColumn(
            "id", (F.col("start") + F.col("idx") * ARITY ** h) * LEVELS + h)
            .select("id", *_place_above(h), "run", "digest", "idx", *keys), "merkle_level")
        nodes.append(level.select("id", "up", "pos", "run"))
        done.append(level.filter(F.col("height") == h).select("sid", "digest"))
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    subroots = materialise(subroots.join(small(sources.select("sid", "source")), "sid")
                           .select("sid", "source", F.col("digest").alias("subroot")), "merkle_subroots")
    top = subroots.select(F.col("sid").alias("idx"), F.col("subroot").alias("digest"))
    here, rest = 0, count
    while rest > 1:
        here, rest = here + 1, -(-rest // ARITY)
        above = F.floor(F.col("idx") / F.lit(ARITY)).cast("long")
        top = materialise(_runs(top).select(
            (-(F.col("idx") * LEVELS + here)).alias("id"),
            (-(above * LEVELS + here + 1) if rest > 1 else F.lit(None).cast("long")).alias("up"),
            F.pmod(F.col("idx"), F.lit(ARITY)).cast("int").alias("pos"), "run", "digest", "idx"), "merkle_top")
        nodes.append(top.select("id", "up", "pos", "run"))
    last = top.select("digest").first() if count else None
    inner = docs.sparkSession.createDataFrame([], "id long, up long, pos int, run string")
    for more in nodes:
        inner = inner.unionByName(more)
    return Manifest(base.withColumnRenamed("digest", "leaf").select(
        "place", "doc_id", "leaf", "tampered", "sid", "up", "pos"),
        inner, subroots, last["digest"] if last else None)


CLIMB = f"""
WITH RECURSIVE climb(place, up, pos, folded, path) AS (
  SELECT place, up, pos, coalesce(tampered, leaf), CAST(array() AS array<bigint>) FROM {{leaves}}
  UNION ALL
  SELECT c.place, n.up, n.pos,
    sha2(concat(substr(n.run, 1, {HEX} * c.pos), c.folded, substr(n.run, {HEX} * (c.pos + 1) + 1)), 256),
    array_append(c.path, n.id * {ARITY} + c.pos)
  FROM climb c JOIN {{nodes}} n ON c.up = n.id
)
SELECT place, folded, path FROM climb WHERE up IS NULL
"""


def climb(manifest: Manifest) -> DataFrame:
    """place, folded (the root as recomputed from the leaf), path (per level
    the run and the place in it, as id * ARITY + place) of every leaf.

    The session's limit on rows of a recursive query is lifted for this
    one: it returns one row per leaf and level, whatever the table's size.
    """
    spark = manifest.nodes.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return materialise(spark.sql(CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "merkle_climb")
    finally:
        spark.conf.set(limit, before)


def _siblings(run: Column, pos: Column) -> Column:
    """The run without the digest at ``pos``."""
    return F.concat(F.substr(run, F.lit(1), pos * HEX), F.substr(run, (pos + 1) * HEX + 1))


def _step(entry: Column) -> tuple[Column, Column]:
    return F.shiftright(entry, 4), F.pmod(entry, F.lit(ARITY)).cast("int")


def proofs(manifest: Manifest, climbed: DataFrame) -> DataFrame:
    """place, proof: the siblings along each leaf's path as text, level by
    level. What lies above a run of leaves is spelled out once per run."""
    first_run, first_pos = _step(F.get("path", F.lit(0)))
    # One leaf speaks for its run: the first, or of sources with one row each any.
    steps = (climbed.filter((F.size("path") > 1) & ((first_pos == 0) | (first_run < 0)))
             .groupBy(first_run.alias("first")).agg(F.min("path").alias("path"))
             .select("first", F.posexplode(F.slice("path", 2, LEVELS)).alias("level", "entry")))
    run, pos = _step(F.col("entry"))
    tails = (steps.withColumns({"id": run, "own": pos})
             .join(manifest.nodes.select("id", "run"), "id")
             .groupBy("first").agg(F.sort_array(F.collect_list(
                 F.struct("level", _siblings(F.col("run"), F.col("own")).alias("text")))).alias("steps"))
             .select("first", F.array_join(F.transform("steps", lambda x: x["text"]), "").alias("tail")))
    runs = materialise(manifest.nodes.select(F.col("id").alias("first"), "run").join(tails, "first", "left"),
                       "merkle_runs")
    return (climbed.select("place", "folded", first_run.alias("first"), first_pos.alias("own"))
            .join(runs, "first", "left")
            .select("place", "folded", F.concat(
                F.coalesce(_siblings(F.col("run"), F.col("own")), F.lit("")),
                F.coalesce("tail", F.lit(""))).alias("proof")))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of
    every row.

    Null fields have digests of their own, so a null text differs from an
    empty one. A row with a null ``doc_id`` is a leaf, the first of its
    source, and is never tampered. Rows repeated under one id are leaves of
    their own, in the order of their digests. The proof of a table's only
    row is empty. Long texts are digested whole. Extra columns are ignored;
    an empty table gives an empty result.
    """
    tree = build(docs)
    # Digested before the join: the proof's text does not travel.
    proof = proofs(tree, climb(tree)).select("place", "folded", F.sha2("proof", 256).alias("proof_sha256"))
    subroots = small(tree.subroots.select("sid", "subroot"))
    return (tree.leaves.join(proof, "place").join(subroots, "sid").select(
        "doc_id", "leaf", "subroot", F.lit(tree.root).cast("string").alias("root"),
        "proof_sha256", F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(tree.root).cast("string")).alias("verified")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
