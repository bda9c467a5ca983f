import random
from itertools import combinations

import numpy as np
import xxhash

from netwatch.llm.components import components
from netwatch.llm.simhash import close_pairs, fingerprint, keep_one, links, near_duplicates, position_sets


def slow_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [(d, slow_print(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        same_id = prints[i][0] is not None and prints[i][0] == prints[j][0]
        if same_id or (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, (d, p) in enumerate(prints)), key=str)


def near_rows():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(400)]
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows) + 10, " ".join(own)))
    rng.shuffle(rows)
    return rows


def test_fingerprints():
    for text in (None, "", " \n", "One", "One TWO", "a b c", "É é A b c d", "x " * 500):
        assert fingerprint(None if text is None else text.encode()) == slow_print(text)


def test_position_sets_cover_every_choice():
    sets = position_sets(3)
    assert len(sets) == 14
    for shared in combinations(range(8), 5):
        assert sum(set(s) <= set(shared) for s in sets) == 1
    for bits in (0, 1, 2, 4):
        assert all(any(set(s) <= set(c) for s in position_sets(bits)) for c in combinations(range(8), 8 - bits))


def test_documents_against_brute_force(make_docs, edge_rows):
    rows = near_rows() + [r[:2] for r in edge_rows] + [(8, "another text under a known id")]
    expected = brute(rows)
    assert sorted(map(tuple, near_duplicates(make_docs(rows)).collect()), key=str) == expected
    assert len({r[2] for r in expected}) < len(rows) - 10


def test_links_with_small_blocks_connect_the_same(spark):
    rng = random.Random(7)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 120:
        value = rng.choice(sorted(values))
        for _ in range(rng.randint(1, 3)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values |= {rng.getrandbits(64) for _ in range(60)}
    values = sorted(values)
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "node long, fp long")
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= 3:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    for block in (512, 4):
        found = {r.node: r.component for r in components(links(frame, block=block), "test").collect()}
        assert [found.get(i, i) for i in range(len(values))] == [find(i) for i in range(len(values))]


def test_close_pairs():
    values = np.array([0, 7, 15, 1 << 63, 0xFF00], np.uint64)
    assert sorted(map(tuple, close_pairs(values, 3).tolist())) == [(0, 1), (0, 3), (1, 2)]


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7), (None, 3)], "x long, y long")
    found = {r.node: r.component for r in components(edges, "chain").collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}
    assert components(edges.limit(0), "none").collect() == []


def test_keep_one_keeps_columns_and_rows_without_id(make_docs, spark):
    from pyspark.sql import functions as F

    text = " ".join(f"w{i}" for i in range(100))
    docs = make_docs([(5, text), (3, text), (9, "other words here and more"), (None, text), (3, text)])
    docs = docs.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(7)).withColumn("node", F.lit(1))
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 9), (True, None)]
    assert keep_one(docs.limit(0)).collect() == []


def test_keep_one_joins_the_same_way_at_every_size(make_docs):
    """A join that is sent to the workers while the corpus is small would
    say nothing about what a large one needs."""
    kept = keep_one(make_docs([(d, f"{d}a {d}b {d}c {d}d {d}e") for d in range(40)]))
    assert kept.count() == 40
    assert "SortMergeJoin" in kept._jdf.queryExecution().sparkPlan().toString()


def spread_prints(count, bits=3, seed=5):
    """Texts and their fingerprints: each of the rest within ``bits`` of the
    one before, the ends of the chain farther apart."""
    rng = random.Random(seed)
    words = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(1500)]
    chain, prints = [" ".join(words)], [slow_print(" ".join(words))]
    while len(chain) < count:
        own = list(words)
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
        here = slow_print(" ".join(own))
        if 0 < (here ^ prints[-1]).bit_count() <= bits and all((here ^ p).bit_count() > bits for p in prints[:-1]):
            chain.append(" ".join(own))
            prints.append(here)
            words = own
    return chain


def test_rows_without_an_id_link_their_neighbours(make_docs):
    a, bridge, b = spread_prints(3)
    rows = [(9, a), (None, bridge), (5, b)]
    assert brute(rows) != brute([r for r in rows if r[0] is not None])
    got = sorted(map(tuple, near_duplicates(make_docs(rows)).collect()), key=str)
    assert got == brute(rows)
    assert {c for _, _, c in got} == {5}
    # A group without any id has no component id; copies of a bridge change nothing.
    rows = [(None, a), (None, bridge), (None, bridge), (7, "something else")]
    assert sorted(map(tuple, near_duplicates(make_docs(rows)).collect()), key=str) == brute(rows)
    kept = keep_one(make_docs([(9, a), (None, bridge), (5, b), (5, b), (5, "x y z")])).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 5]


def test_keep_one_has_no_window(make_docs):
    plan = keep_one(make_docs(near_rows()))._jdf.queryExecution().toString()
    assert "Window" not in plan
