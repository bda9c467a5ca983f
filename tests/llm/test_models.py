"""Language, quality and toxicity: accuracy on rows held out, and edges."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from netwatch.llm import language_id as li
from netwatch.llm import quality_classifier as qc
from netwatch.llm import toxicity as tx
from netwatch.llm.logistic import Logistic

ROOT = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{ROOT}/{name}.parquet")


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in table(spark, "documents").collect()}
    found = li.op2_language_id(spark, ROOT).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.lang_pred in set(truth.values()) for r in found)
    accepted = [r for r in held if r.accepted]
    assert sum(r.lang_pred == truth[r.doc_id] for r in accepted) / len(accepted) > 0.99


def test_language_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("lang_pred", F.lit("x"))
    contents = {"en": b"the cat and the dog and the house of the rising sun", "xx": b"zzz qqq zzz qqq"}
    out = {str(r.doc_id): r for r in li.predict(docs, contents).collect()}
    assert [out[k].lang_pred for k in ("1", "2", "3")] == ["und"] * 3
    assert out["9"].lang_pred in contents and out["4"].lang_pred in contents
    assert li.predict(docs, {}).filter("lang_pred <> 'und' OR score <> 0 OR accepted").count() == 0
    assert li.predict(docs.limit(0), contents).collect() == []
    assert li.dictionaries(docs.limit(0)) == {}
    assert None not in li.dictionaries(docs)


def test_language_without_letters(make_docs):
    contents = {"en": b"the quick brown fox jumps over the lazy dog", "fr": "où est passée la bibliothèque".encode()}
    rows = [(i, t) for i, t in enumerate(["½ ² Ⅷ ①", "123 _ 4", "\u0301\u0302", "", None, "½a", "ª", "漢"])]
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.predict(make_docs(rows), contents).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(5))
    assert all(got[i][0] != "und" for i in (5, 6, 7))
    assert li.letters("cafe\u0301 X2Y ½z") == "cafe\u0301 x y z".encode()


def test_language_against_plain_sizes(make_docs, spark):
    """Sizes by fresh compressors, pieces and words cut by hand."""
    import unicodedata
    import zstandard

    contents = li.dictionaries(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert len(contents) > 1
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:60]
    texts += ["Été ½ " * 900, "x" * 5000, "The end."]
    got = {r.doc_id: r for r in li.predict(make_docs(list(enumerate(texts))), contents).collect()}
    for i, text in enumerate(texts):
        word, clean = "", []
        for c in (text or "").lower() + " ":
            kind = unicodedata.category(c)[0]
            if kind == "L" or kind == "M" and word:
                word += c
            elif word:
                clean.append(word)
                word = ""
        data = " ".join(clean).encode()
        if not data:
            assert got[i].lang_pred == "und"
            continue
        sizes = {}
        for lang, content in contents.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            total, at = 0, 0
            while at < len(data):
                end = min(at + 2048, len(data))
                if end < len(data) and b" " in data[at:end]:
                    end = data.rindex(b" ", at, end) + 1
                coder = zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False)
                total += len(coder.compress(data[at:end]))
                at = end
            sizes[lang] = total
        assert got[i].lang_pred == min(sizes, key=lambda k: (sizes[k], list(contents).index(k)))
        weight = {k: 2.718281828459045 ** ((min(sizes.values()) - v) / 2) for k, v in sizes.items()}
        assert abs(got[i].score - 1 / sum(weight.values())) < 1e-9


def test_equal_sizes_go_to_the_first_language():
    same = {"b": b"some raw content here", "a": b"some raw content here"}
    assert li.Classifier(same)("some words")[0] == "b"


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    found = qc.op5_quality_classifier(spark, ROOT).collect()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_site_posteriors_shrink(make_docs, spark):
    """Against the formulas, written out."""
    good = "plain words in a row that are not odd at all and go on for a while as texts do here " * 2
    bad = "x### y*** z%%% w$$$ " * 12
    rows = [(d, (good if d % 5 else bad) + f" number {d}", "en", "big") for d in range(200)]
    rows += [(200 + d, bad + f" number {d}", "en", "spam") for d in range(40)]
    rows += [(300, good, "en", "tiny"), (301, None, None, None)]
    labels = spark.createDataFrame([(d, int(d % 5 > 0)) for d in range(100)] + [(0, 0), (None, 1), (5, 7)], "doc_id long, label int")
    docs = make_docs(rows).withColumn("host", F.lit("clash"))
    out = {r.doc_id: r for r in qc.classify(docs, labels, F.col("source"), F.col("lang")).collect()}
    assert len(out) == len(rows)
    hosts = {}
    for d, _, _, s in rows:
        hosts.setdefault(s, []).append(out[d].evidence)
    overall = sum(map(sum, hosts.values())) / len(rows)
    # Three unknowns (both strengths) hide behind the posteriors: check the order they must have.
    assert out[200].host_posterior < overall < out[1].host_posterior
    assert abs(out[300].host_posterior - overall) < abs(hosts["tiny"][0] - overall)
    assert all(r.predicted == int(r.score >= 0.5) and r.kept == (r.score >= 0.5) for r in out.values())
    assert out[1].predicted == 1 and out[205].predicted == 0
    assert qc.classify(docs.limit(0), labels, F.col("source"), F.col("lang")).collect() == []
    assert len(qc.classify(docs, labels.limit(0), F.col("source"), F.col("lang")).collect()) == len(rows)


def toxic_rows(n=600):
    import random

    rng = random.Random(9)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rude = ["zorkel", "vashnik", "zorkelast", "vashnikol"]
    rows, labels = [], []
    for d in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        toxic = d % 6 == 0
        for _ in range(max(2, len(words) // 20) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(rude)
        rows.append((d, " ".join(words)))
        labels.append((d, int(toxic)))
    return rows, labels


def test_toxicity_of_texts_not_trained_on(make_docs, spark):
    rows, labels = toxic_rows()
    frame = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, label int")
    out = {r.doc_id: r for r in tx.score(make_docs(rows), frame).collect()}
    held = [(out[d].predicted, y) for d, y in labels if d % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())


def ranked(pairs):
    """Share of pairs of a 1 and a 0 in which the 1 scores higher."""
    ones, zeros = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


def rude_rows(n, seed=5):
    """Texts of made-up words, most of them rare; every sixth has a few rude ones."""
    import random

    rng = random.Random(seed)
    syllables = [a + b for a in "bdklmnrst" for b in ("a", "en", "i", "or", "u")]
    rude = ["morkel", "tanshik", "sudrin", "nellask", "bakorim"]
    rows = []
    for d in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(60, 300))]
        for _ in range(max(2, len(words) // 60) if d % 6 == 0 else 0):
            words[rng.randrange(len(words))] = rng.choice(rude)
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("marked", [1, 0])
def test_toxicity_ranks_label_1_above_label_0(make_docs, spark, marked):
    """With few labels, also when it is label 0 that has words of its own."""
    rows = rude_rows(240)
    labels = [(d, marked if d % 6 == 0 else 1 - marked) for d, _ in rows]
    frame = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, label int")
    out = {r.doc_id: r.score for r in tx.score(make_docs(rows), frame).collect()}
    assert ranked([(out[d], y) for d, y in labels if d % 5 == 0]) > 0.95


def test_model_matches_the_formulas(make_docs, spark):
    rows = [(1, "abab aba"), (2, "abc"), (3, "ab b"), (4, None)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, label int")
    counts = tx.count_sequences(make_docs(rows), labels)
    table_ = {r.gram: (r.toxic, r.ordinary) for r in counts.collect()}
    expected = {}
    for k, words in ((0, ["abab", "aba"]), (1, ["abc", "ab", "b"])):
        for w in words:
            for g in tx.sequences(w):
                expected.setdefault(g, [0, 0])[k] += 1
    assert table_ == {g: tuple(v) for g, v in expected.items()}
    model = tx.build(counts)
    pieces = {g[i:] for g in expected for i in range(len(g))}
    n1 = {}
    for p in pieces:
        if len(p) > 1:
            n1[p[1:]] = n1.get(p[1:], 0) + 1

    def low(g):
        if not g:
            return 1 / 256
        peers = [n for p, n in n1.items() if p[:-1] == g[:-1]]
        if not peers:
            return low(g[1:])
        return (max(n1.get(g, 0) - 0.75, 0) + 0.75 * len(peers) * low(g[1:])) / sum(peers)

    def diff(g):
        peers = [v for x, v in expected.items() if x[:-1] == g[:-1]]
        both = sum(map(sum, peers))
        pooled = (max(sum(expected[g]) - 0.75, 0) + 0.75 * len(peers) * low(g[1:])) / both
        p = [(max(expected[g][k] - 0.75, 0) + (0.75 * sum(v[k] > 0 for v in peers) + tx.PRIOR) * pooled)
             / (sum(v[k] for v in peers) + tx.PRIOR) for k in (0, 1)]
        return math.log(p[0]) - math.log(p[1])

    assert model.grams == {g: pytest.approx(diff(g)) for g in expected}


def test_toxicity_edges(make_docs, spark, edge_rows):
    docs = make_docs(edge_rows).withColumn("x", F.lit("clash")).withColumn("label", F.lit(3))
    none = spark.createDataFrame([], "doc_id long, label int")
    for labels in (none, spark.createDataFrame([(4, 1), (8, 1), (None, 0), (9, 5)], "doc_id long, label int")):
        out = tx.score(docs, labels).collect()
        assert len(out) == len(edge_rows) and len({r.score for r in out}) == 1
    assert tx.score(docs.limit(0), none).collect() == []


def test_logistic():
    import numpy as np

    x = np.array([[0.0], [1.0], [2.0], [3.0]] * 20)
    model = Logistic(x, (x[:, 0] > 1.5).astype(int))
    assert model.probability([[0.0]])[0] < 0.1 < 0.9 < model.probability([[3.0]])[0]
    assert Logistic(np.empty((0, 2)), np.empty(0)).probability([[1.0, 2.0]])[0] == pytest.approx(0.25)


def test_toxicity_model_keeps_rare_sequences(spark):
    """Nothing is cut when a class has very many sequences."""
    rows = [("\x02a", 30_000_000, 40_000_000), ("a\x03", 30_000_000, 40_000_000), ("\x02q", 20, 0), ("\x02qa", 0, 3), ("\x02z", 1, 0)]
    model = tx.build(spark.createDataFrame(rows, "gram string, toxic long, ordinary long"))
    assert set(model.grams) == {g for g, *_ in rows}
    assert model.grams["\x02q"] > 0 > model.grams["\x02qa"]


def test_toxicity_of_texts_does_not_depend_on_what_is_sent(make_docs, spark):
    rows, labels = toxic_rows(200)
    rows += [(900, None), (901, ""), (3, rows[3][1]), (902, "zorkel unseen wörd 漢字")]
    frame = spark.createDataFrame(labels, "doc_id long, label int")
    scores = [sorted((r.doc_id, round(r.score, 9)) for r in tx.score(make_docs(rows), frame, held=h).collect()) for h in (0, 150, 10**6)]
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == len(rows)


def test_toxicity_counts_all_but_a_bounded_sample(make_docs, spark, monkeypatch):
    rows, labels = toxic_rows(600)
    counted = []
    real = tx.packed_texts
    monkeypatch.setattr(tx, "packed_texts", lambda docs: type("Spy", (), {"join": lambda self, other, *a: (
        counted.append(other.count()), real(docs).join(other, *a))[1]})())
    frame = spark.createDataFrame(labels, "doc_id long, label int")
    assert tx.score(make_docs(rows), frame, sample=60).count() == len(rows)
    assert 540 - 2 <= counted[0] <= 540
    for n, sample in ((600, 60), (600, 20_000), (12, 20_000)):
        drawn = tx.calibration(frame.filter(F.col("doc_id") < n), sample).collect()
        assert min(sample, n / 4) <= len(drawn) <= min(sample, n / 4) + 2 and {r.label for r in drawn} == {0, 1}
    assert tx.calibration(spark.createDataFrame([(1, 1)], "doc_id long, label int")).count() == 0
