import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from netwatch.llm import merkle
from netwatch.llm.oracle import SQL


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)))


def climb(levels, i, folded):
    """Fold ``folded`` at place i up a list of levels; siblings on the way."""
    proof = []
    for nodes in levels[:-1]:
        first = i // 16 * 16
        run = nodes[first:first + 16]
        proof += run[:i - first] + run[i - first + 1:]
        run[i - first] = folded
        folded, i = h(*run), i // 16
    return folded, proof


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def brute(rows):
    rows = [(d, t, lang, source, None if t is None else len(t)) for d, t, lang, source in rows]
    by = {}
    for row in rows:
        by.setdefault(row[3], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[source] = grow([leaf(*r) for r in by[source]])
    top = grow([trees[s][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        for i, (d, t, lang, s, n) in enumerate(by[source]):
            own = leaf(d, t, lang, s, n)
            start = own
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and t is not None:
                start = leaf(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in t), lang, s, n)
            folded, proof = climb(trees[source], i, start)
            folded, more = climb(top, k, folded)
            out.append((d, own, trees[source][-1][0], top[-1][0], h(*proof, *more), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(docs):
    return sorted(map(tuple, merkle.manifest(docs).collect()), key=str)


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows, doc = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((doc, rng.choice(["Upper Case", "lower case", "Ünïcode Ä", ""]) + str(rng.random()), "en", source))
            doc += rng.randint(1, 3)
    return rows


def test_several_levels_against_brute_force(make_docs):
    rows = corpus({"s1": 1, "s2": 16, "s3": 17, "s0": 273, "é": 33, None: 40})
    got = run(make_docs(rows))
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


def test_more_sources_than_an_arity(make_docs):
    rows = corpus({f"site{i:03d}": i % 3 + 1 for i in range(300)})
    assert run(make_docs(rows)) == brute(rows)


def test_one_source_and_one_row(make_docs):
    rows = corpus({"only": 20})
    assert run(make_docs(rows)) == brute(rows)
    single = run(make_docs([(3, "Text", "en", "only")]))
    assert single == brute([(3, "Text", "en", "only")])
    assert single[0][1] == single[0][2] == single[0][3] and single[0][4] == h()


def test_a_changed_row_changes_its_root(make_docs):
    rows = corpus({"a": 40, "b": 5})
    before = merkle.build(make_docs(rows))
    rows[7] = (rows[7][0], rows[7][1] + " ", *rows[7][2:])
    after = merkle.build(make_docs(rows))
    assert before.root != after.root
    old, new = ({r["source"]: r["subroot"] for r in t.subroots.collect()} for t in (before, after))
    assert old["a"] != new["a"] and old["b"] == new["b"]


def test_edge_rows(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    clash = docs.withColumns({c: F.lit(1) for c in ("place", "sid", "up", "pos", "idx", "digest", "__at", "run")})
    assert run(clash) == brute(edge_rows)
    assert merkle.manifest(docs.limit(0)).collect() == []


def test_null_and_empty_differ(make_docs):
    a, b = (merkle.build(make_docs([(1, text, "en", "s"), (2, "x", "en", "s")])).root for text in (None, ""))
    assert a != b


def test_sql_agrees_with_brute_force():
    """The statement that checks the query, on more levels than sf0.01 has."""
    rows = corpus({"s0": 300, "s1": 3, None: 2} | {f"t{i}": 1 for i in range(20)})
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [(d, t, la, s, len(t)) for d, t, la, s in rows])
    assert sorted(con.execute(SQL["op12_merkle_manifest"]).fetchall(), key=str) == brute(rows)


def test_plan_has_no_single_task_window(make_docs):
    plan = merkle.manifest(make_docs(corpus({"a": 30, "b": 3})))._jdf.queryExecution().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan
