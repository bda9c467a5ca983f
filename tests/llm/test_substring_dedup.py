import hashlib
import random

import pytest

from netwatch.llm.substring_dedup import remove_repeats, super_kmers


def brute(rows, window):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        if doc is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i:i + window])] < doc:
                    gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, **options):
    return sorted(map(tuple, remove_repeats(docs, texts=False, **options).drop("kept").collect()), key=str)


@pytest.mark.parametrize("bucket", [1000, 1])
def test_small_alphabet_against_brute_force(make_docs, bucket):
    rng = random.Random(3)
    rows = [(d, " ".join(rng.choice("a" if d % 3 == 0 else "abc") for _ in range(rng.randint(0, 60)))) for d in range(90)]
    rows += [(200 + i, rows[5][1] + " x" * i) for i in range(20)]
    assert run(make_docs(rows), window=6, run=2, bucket=bucket) == brute(rows, 6)


@pytest.mark.parametrize("bucket", [1000, 2])
def test_shared_passage_and_copies(make_docs, bucket):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    rows = []
    for d in range(40):
        own = [rng.choice(words) for _ in range(120)]
        cut = rng.randint(0, 120)
        rows.append((d, " ".join(own[:cut]) + "\n" + passage + "\t" + " ".join(own[cut:]) if d % 2 else " ".join(own)))
    rows += [(100 + i, rows[7][1]) for i in range(15)]
    expected = brute(rows, 50)
    assert run(make_docs(rows), bucket=bucket) == expected
    assert sum(r[2] for r in expected) > 1000


def test_edge_rows(make_docs, edge_rows):
    expected = brute([r[:2] for r in edge_rows], 50)
    assert run(make_docs(edge_rows)) == expected


def test_one_id_with_two_texts(make_docs):
    text = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, text), (2, text), (2, other), (3, other)]
    assert run(make_docs(rows)) == brute(rows, 50)


@pytest.mark.parametrize("bucket", [1000, 1])
def test_ids_repeated_with_other_texts(make_docs, bucket):
    rng = random.Random(8)
    rows = [(rng.randrange(12), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for _ in range(60)]
    assert run(make_docs(rows), window=7, run=3, bucket=bucket) == brute(rows, 7)


def test_kept_text_and_empty_table(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    kept = {r.doc_id: r.kept for r in remove_repeats(make_docs([(1, text), (2, "before " + text)])).collect()}
    assert kept == {1: text, 2: "before"}
    assert run(make_docs([])) == []


def test_super_kmers_cover_every_window_once():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    key, start, count = super_kmers(hashes, 50, 8)
    assert np.array_equal(np.concatenate([np.arange(s, s + n) for s, n in zip(start, count)]), np.arange(251))
    assert count.max() <= 43 and len(key) < 40
