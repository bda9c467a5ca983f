import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from netwatch.llm import mixing as mx


def fill(budget, children):
    """Water-filling by rounds: (weight, limit) -> shares."""
    share = [0.0] * len(children)
    open_ = {i for i, (w, _) in enumerate(children) if w > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if share[i] + left * children[i][0] / total >= children[i][1]]
        if not full:
            for i in open_:
                share[i] += left * children[i][0] / total
            break
        for i in full:
            left -= children[i][1] - share[i]
            share[i] = children[i][1]
            open_.discard(i)
    return share


def test_budgets_match_rounds(spark):
    rng = random.Random(1)
    leaves = [(f"d{a}", f"l{b}", f"s{c}", rng.choice([5, 50, 500, 5000])) for a in range(3) for b in range(3) for c in range(4)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, supply long")
    weights = {"domain": {"d0": 1.0, "d1": 5.0, "d2": 1.0}, "lang": {"l0": 3.0, "l1": 1.0}}
    found = {(r.domain, r.lang, r.source): r.budget for r in mx.leaf_budgets(
        frame, F.col("supply") * 1.3, weights, other_weight=0.5, max_epochs=2).collect()}
    supply = defaultdict(int)
    for a, b, c, n in leaves:
        for path in ((), (a,), (a, b), (a, b, c)):
            supply[path] += n

    def share(path, budget):
        kids = sorted({p for p in supply if len(p) == len(path) + 1 and p[:-1] == path})
        if not kids:
            return {path: budget}
        level = ["domain", "lang", "source"][len(path)]
        weight = [weights[level].get(p[-1], 0.5) if level in weights else float(supply[p]) for p in kids]
        given = fill(budget, [(w, 2.0 * supply[p]) for w, p in zip(weight, kids)])
        return {k: v for p, b in zip(kids, given) for k, v in share(p, b).items()}

    expected = share((), 1.3 * supply[()])
    assert found.keys() == expected.keys()
    for k in found:
        assert found[k] == pytest.approx(expected[k], abs=1e-6)


def rows(n=300):
    rng = random.Random(3)
    return [(d, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["en", "en", "de", "xx", None]),
             rng.choice(["src0", "src1", "blog", None])) for d in range(n)]


def test_prefix_is_longest_that_fits(make_docs):
    docs = make_docs(rows())
    sized = mx._sized(docs, mx.source_domain())
    chosen = mx.plan(sized, F.col("supply") * 0.6, {"lang": mx.LANGUAGE_WEIGHTS}, 0.05, 4, mx.SEED)
    leaves = defaultdict(list)
    from netwatch.llm.common import materialise
    keyed = mx._with_leaf(sized, materialise(chosen, "t")).withColumn("key", mx._order_key(mx.SEED, F.col("epochs")))
    for r in keyed.collect():
        leaves[r.domain, r.lang, r.source].append(r)
    got = defaultdict(int)
    for r in mx.mix(docs, 0.6).collect():
        got[r.domain, r.lang, r.source, r.doc_id] += 1
    budgets = {(r.domain, r.lang, r.source): r.budget for r in mx.leaf_budgets(
        sized.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("supply")),
        F.col("supply") * 0.6, {"lang": mx.LANGUAGE_WEIGHTS}).collect()}
    for leaf, members in leaves.items():
        supply = sum(r.n_tokens for r in members)
        whole, rest = divmod(int(round(budgets[leaf], 3)), supply)
        upto = 0
        for r in sorted(members, key=lambda r: r.key):
            upto += r.n_tokens
            assert got[(*leaf, r.doc_id)] == whole + (upto <= rest)


def test_every_document_once_when_budget_is_supply(make_docs):
    docs = make_docs(rows())
    out = mx.mix(docs, 1.0, weights={}).collect()
    assert sorted(r.doc_id for r in out) == list(range(300)) and {r.epoch for r in out} == {0}


def test_documents_keep_their_columns(make_docs, edge_rows):
    docs = make_docs(rows() + edge_rows).withColumn("epochs", F.lit("x")).withColumn("rest", F.lit(1)).withColumn("domain", F.lit("z"))
    out = mx.mixed_documents(docs, 0.7)
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in mx.mix(docs, 0.7).collect():
        counts[str(r.doc_id)] += 1
    found = defaultdict(int)
    for r in out.collect():
        found[str(r.doc_id)] += 1
    assert found == counts and counts
    assert mx.mix(docs.limit(0)).collect() == [] and mx.mixed_documents(docs.limit(0)).collect() == []


def test_the_query_fills_a_domain_a_language_and_a_source(spark):
    """On the tables: nodes of every level reach their limit while their
    parent does not, so that shortages go to siblings, then to the next level."""
    sized = mx._sized(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), mx.source_domain())
    leaves = sized.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("supply"))
    budgets = mx.leaf_budgets(leaves, F.col("supply") * 1.0, mx.TARGETS, max_epochs=mx.TARGET_EPOCHS).collect()
    limit, given = defaultdict(float), defaultdict(float)
    for r in budgets:
        for path in ((), (r.domain,), (r.domain, r.lang), (r.domain, r.lang, r.source)):
            limit[path] += mx.TARGET_EPOCHS * r.supply
            given[path] += r.budget
    full = {p for p in limit if given[p] > limit[p] - 1e-3}
    assert all(given[p] < limit[p] + 1e-3 for p in limit)
    assert given[()] == pytest.approx(limit[()] / mx.TARGET_EPOCHS)
    for depth in (1, 2, 3):
        assert [p for p in full if len(p) == depth and p[:-1] not in full], depth
