import random

import numpy as np
from pyspark.sql import functions as F

from netwatch.llm import decontamination as dc


def brute(rows, items, similarity=dc.SIMILARITY):
    """Every window of every size, no fingerprints."""
    out = []
    for doc, text in rows:
        h = dc.shingles(text).tolist()
        for item, own in items:
            g = dc.shingles(own).tolist()
            if not g or not h:
                continue
            wide = min(len(g), len(h))
            scores = [dc.weighted_jaccard(dc.Counter(h[s:s + wide]), dc.Counter(g)) for s in range(len(h) - wide + 1)]
            best = max(scores)
            if best >= similarity:
                out.append((doc, item, round(best, 9), scores.index(best), wide + 4))
    return sorted(out)


def planted():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 60)))) for i in range(30)]
    items += [(50, "too short here"), (51, None), (52, ""), (53, items[3][1])]
    rows = []
    for d in range(120):
        own = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if d % 4 == 0:
            part = items[d % 30][1].split()
            if d % 8 == 0 and len(part) > 55:
                part[len(part) // 2] = "changed"
            if d % 12 == 0:
                part = part[:-1]
            cut = rng.randint(0, len(own))
            own[cut:cut] = [w.upper() + "," for w in part]
        rows.append((d, " ".join(own)))
    rows += [(500, items[5][1]), (501, " ".join(items[6][1].split()[2:]))]
    return rows, items


def test_against_all_windows(make_docs, spark):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (dc.ITEMS, 7):
        found = dc.contaminated(make_docs(rows), bench, block=block).collect()
        assert sorted((r.doc_id, r.item_id, round(r.similarity, 9), r.start_word, r.n_words) for r in found) == brute(rows, items)


def test_radius_is_guaranteed_by_the_blocks():
    """Any two fingerprints within the radius agree within RADIUS // 8 bits
    in some byte, so the block lookup finds every one of them."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(30)) for _ in range(40)]
    index = dc.ItemIndex(list(enumerate(texts)), dc.RADIUS)
    size = 26
    ks, blocks = index.blocks[size]
    for k, own in zip(ks.tolist(), range(len(ks))):
        for bits in range(dc.RADIUS + 1):
            other = int(index.prints[k])
            for b in rng.sample(range(64), bits):
                other ^= 1 << b
            octets = np.array([other], np.uint64).view(np.uint8)
            assert any(blocks[b][octets[b]][own] for b in range(8))


def test_clean_documents_stay(make_docs, spark, edge_rows):
    rows, items = planted()
    rows = [(d + 1000, t) for d, t in rows]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows + [r[:2] for r in edge_rows]).withColumn("item_id", F.lit(3)).withColumn("similarity", F.lit("x"))
    left = dc.decontaminated(docs, bench)
    bad = {d for d, *_ in brute(rows, items)}
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(r[0]) for r in rows + edge_rows if r[0] not in bad)
    assert dc.contaminated(docs.limit(0), bench).collect() == []
    assert dc.contaminated(docs, bench.limit(0)).collect() == []
    assert dc.decontaminated(docs, bench.limit(0)).count() == docs.count()
