import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table."""
    def make(rows):
        full = []
        for row in rows:
            doc, text, *rest = row
            lang, source = (rest + ["en", "src1"])[:2] if not rest else rest
            full.append((doc, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, one word, odd white space, a long text, repeats."""
    rng = random.Random(4)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ünïcödé"]) + str(i % 97)
                         for i in range(40_000))
    return [
        (1, None, "en", "src1"), (2, "", "en", "src1"), (3, " \t\n ", None, None), (4, "word", "fr", None),
        (5, "a\x0bb\x0cc\rd\ne", None, "src2"), (6, long_text, "en", "src0"), (7, long_text, "en", "src0"),
        (None, "no id here", "en", "src1"), (8, "same text twice", "en", "src1"), (8, "same text twice", "en", "src1"),
        (9, "漢字 😀 and more　space", "zh", "src9"), (10, "one two three four five six " * 30, "en", "src1"),
    ]
