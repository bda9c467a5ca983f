import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from netwatch.llm import quality_rules as q


def slow_counts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)]


def documents(n=1200, seed=1):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        lang = rng.choice(["en", "fr"])
        words = ["".join(rng.choice("aeiourstln" if lang == "en" else "éaiouqmpv") for _ in range(rng.randint(2, 8)))
                 for _ in range(rng.randint(30, 200))]
        text = " ".join(w.capitalize() + "." if i % 9 == 0 else w for i, w in enumerate(words))
        if d % 20 == 0:
            text = " ".join(w + "###" for w in words)
        elif d % 20 == 1:
            text = text.upper().replace(".", "!!")
        rows.append((d, text, lang, rng.choice(["a", "a", "b"])))
    return rows


def test_counts(edge_rows):
    for _, text, *_ in edge_rows + documents(40):
        assert q.text_counts(None if text is None else text.encode())[0] == slow_counts(text)


def test_junk_goes_and_clean_stays(make_docs):
    rows = documents()
    found = {r.doc_id: r for r in q.quality_rules(make_docs(rows)).collect()}
    junk = {d for d, *_ in rows if d % 20 < 2}
    assert len(found) == len(rows)
    assert {d for d, r in found.items() if not r.kept} == junk
    for d, text, *_ in rows[:50]:
        assert [found[d][c] for c in q._COUNTS] == slow_counts(text)


def resolutions(rows):
    """Variance of each coordinate that the size of a text alone gives."""
    chars = np.array([0.25 / (r.word_chars + 40) for r in rows])
    words = np.array([0.25 / (r.n_words + 10) for r in rows])
    return np.array([chars, words, 8 * words, words, chars, chars]).T


def own_distances(x, sizes, typical, centre, cov):
    coarser = np.maximum(0, sizes - typical)
    y = (x - centre) / np.sqrt(1 + coarser / np.diag(cov))
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y)


def test_estimate_matches_concentration_steps_in_numpy(make_docs):
    """One site: the same steps on arrays give nearly the same distances
    (quantiles differ by the sketch's accuracy)."""
    rows = [(d, t, "en", "a") for d, t, lang, _ in documents(700) if lang == "en"]
    stats = q.statistics(make_docs(rows)).filter("NOT base_failed").orderBy("doc_id").collect()
    x = np.array([[r[f"x{i}"] for i in range(q.DIMENSIONS)] for r in stats])
    sizes = resolutions(stats)
    floors = np.diag(sizes.mean(axis=0))
    quart = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    centre, cov = quart[1], np.diag(((quart[2] - quart[0]) / 1.349) ** 2) + floors
    inner = q._quantile(1 - q.COVERAGE, q.DIMENSIONS)
    scale = q.COVERAGE / (1 - q._upper_tail(inner, q.DIMENSIONS + 2))
    for _ in range(q.STEPS):
        d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        core = x[d2 <= np.quantile(d2, q.COVERAGE)]
        centre, cov = core.mean(axis=0), np.cov(core.T, bias=True) * scale + floors
    d2 = own_distances(x, sizes, sizes.mean(axis=0), centre, cov)
    found = [r.distance for r in q.quality_rules(make_docs(rows)).filter("NOT base_failed").orderBy("doc_id").collect()]
    assert np.allclose(found, d2, rtol=0.1, atol=0.3)


def test_shrinkage_by_formula(make_docs):
    """Site and language: n / (n + prior) of the own estimate, the mixture's
    covariance. Without a prior every site stands alone."""
    docs = make_docs([r for r in documents(300) if r[0] % 20 > 1])
    stats = q.statistics(docs).cache()
    alone = {(r.lang, r.source): r for r in q.estimates(stats, prior=0).collect()}
    found = {(r.lang, r.source): r for r in q.estimates(stats, prior=30).collect()}
    up = {}
    for lang in ("en", "fr"):  # one source only: the site is the language
        one = stats.filter(stats.lang == lang).withColumn("source", F.lit("x"))
        up[lang] = q.estimates(one, prior=0).first()
    top = q.estimates(stats.withColumn("lang", F.lit("x")).withColumn("source", F.lit("x")), prior=0).first()

    def parts(e):
        return np.array([e[f"c{i}"] for i in range(6)]), q._matrix([e[f"v{i}{j}"] for i, j in q._PAIRS])

    def mix(own, parent, docs):
        share, apart = docs / (docs + 30), own[0] - parent[0]
        return (share * own[0] + (1 - share) * parent[0],
                share * own[1] + (1 - share) * parent[1] + share * (1 - share) * np.outer(apart, apart))

    assert len(found) == 4
    for (lang, source), e in found.items():
        n = stats.filter((stats.lang == lang) & (stats.source == source) & ~stats.base_failed).count()
        want = mix(parts(alone[lang, source]), mix(parts(up[lang]), parts(top), up[lang].docs), n)
        assert n == e.docs and np.allclose(parts(e)[0], want[0]) and np.allclose(parts(e)[1], want[1])


def test_spread_of_a_site_decides(make_docs):
    """The same text is usual at a site of code and an outlier among news."""
    rng = random.Random(8)
    rows = []
    for d in range(600):
        words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(80, 160))]
        if d % 3 == 0 or d >= 590:
            words = [w + rng.choice("<>&|") if rng.random() < 0.25 else w for w in words]
        rows.append((d, " ".join(words), "en", "code" if d % 3 == 0 else "news"))
    kept = {r.doc_id for r in q.quality_rules(make_docs(rows)).filter("kept").collect()}
    assert kept == {d for d, *_ in rows if d % 3 == 0 or d < 590}


def test_chi_square_tail():
    assert abs(q._upper_tail(q._quantile(0.01, 6), 6) - 0.01) < 1e-9
    assert abs(q._quantile(0.05, 2) - 5.991464547) < 1e-6


def test_edge_rows_and_columns(make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("x0", F.lit("clash")).withColumn("kept", F.lit(1)).withColumn("site", F.lit(2))
    out = q.quality_rules(docs).collect()
    assert len(out) == len(edge_rows)
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept in (True, False) and not (r.kept and r.base_failed)
    kept = q.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r.kept)
    assert q.quality_rules(make_docs([])).collect() == []
    assert q.accepted(make_docs([])).collect() == []


def test_site_of_forty_percent_junk(make_docs):
    """Junk does not enter the core of a site that has much of it."""
    rng = random.Random(5)
    rows = []
    for d in range(800):
        words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 200))]
        if d % 5 < 2:
            words = [w + "#" * rng.randint(0, 2) for w in words]
        rows.append((d, " ".join(words), "en", "spam"))
    found = q.quality_rules(make_docs(rows)).collect()
    assert {r.doc_id for r in found if not r.kept} == {d for d, *_ in rows if d % 5 < 2}
