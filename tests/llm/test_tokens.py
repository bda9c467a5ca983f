import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netwatch.llm import token_counts as tc
from netwatch.llm import token_output as to
from netwatch.session import fresh_dir

ODD = [" ", "  ", "\n", "\t", "a", "b's", "I'm", "é", "12", "!!", "<|endoftext|>", "\x00", "　", "\xa0", "word",
       "\x1c", "\x85", " ", "ǅ", "²", "½", "▁", "The", "漢", "😀", "<0x41>"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_encoder_equals_the_library():
    encoder = to.ChunkEncoder(to.TOKENIZER)
    for text in odd_texts(4000, 1):
        assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_latin_texts_are_cut_into_pieces():
    """Every character below 256 in any order; a word is merged once
    whatever mark follows it."""
    rng = random.Random(4)
    encoder = to.ChunkEncoder(to.TOKENIZER)
    common = [" ", " ", "\n", "'", "a", "s", "ll", "7", "."]
    for _ in range(4000):
        text = "".join(rng.choice([*common, chr(rng.randrange(256))]) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder.clear()
    encoder(" zorkel zorkel. zorkel, zorkel;\n zorkel!")
    assert set(encoder) == {" zorkel", ".", ",", ";", "\n", "!"}


def test_round_trip(spark, make_docs, edge_rows):
    rows = [(d, t) for d, t in enumerate(odd_texts(2500, 2), 100)] + [r[:2] for r in edge_rows]
    random.Random(3).shuffle(rows)
    docs = make_docs(rows).withColumn("ids", F.lit("x")).withColumn("part", F.lit(1))
    path = fresh_dir(spark, "tests", "tokens")
    to.write_tokens(docs, path)
    stored = to.read_tokens(spark, path)
    library = to.ChunkEncoder(to.TOKENIZER).tokenizer
    expected = {}
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.setdefault(doc, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = sorted(to.token_index(stored).collect(), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert [r.doc_id is not None and r.doc_id for r in found] == sorted(r[0] or 0 for r in rows)
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    # The filter on the id reaches the files.
    one = stored.filter("doc_id = 150")
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,150)]" in one._jdf.queryExecution().toString()


def test_bloom_filter_and_row_index_are_written(spark, make_docs, tmp_path):
    from pyarrow import orc

    path = fresh_dir(spark, "tests", "orc")
    to.write_tokens(make_docs([(i, f"text {i}") for i in range(50)]), path)
    names = [r.f for r in spark.read.orc(path).select(F.input_file_name().alias("f")).distinct().collect()]
    file = orc.ORCFile(names[0].replace("file://", "").replace("file:", ""))
    assert file.nstripes >= 1 and file.row_index_stride == 1000 and file.compression == "ZSTD"


def test_empty_table_of_tokens(make_docs):
    assert to.write_and_index(make_docs([])).collect() == []


def reference(vocabulary, by_bytes):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=by_bytes))
    t.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
    return t


def test_counts_equal_the_library(make_docs, edge_rows):
    rows = [(d, t) for d, t in enumerate(odd_texts(1500, 4), 100)] + [r[:2] for r in edge_rows]
    library = reference(tc.load_vocabulary(), True)
    expected = sorted(((d, len(library.encode(t or "").ids)) for d, t in rows), key=str)
    docs = make_docs(rows).withColumn("n_tokens", F.lit("clash"))
    assert sorted(map(tuple, tc.token_counts(docs).collect()), key=str) == expected
    assert tc.token_counts(make_docs([])).collect() == []


@pytest.mark.parametrize("by_bytes", [False, True])
def test_ties_and_unknowns(by_bytes):
    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0), ("ba", -2.0), ("aba", -3.0)]
    if by_bytes:
        vocabulary += [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    library, counter = reference(vocabulary, by_bytes), tc.PieceCounter(vocabulary)
    rng = random.Random(6)
    for _ in range(2000):
        word = "".join(rng.choice("aabbcé▁") for _ in range(rng.randint(1, 12)))
        assert counter[word] == len(library.encode(word).ids), word


def test_files_with_other_pieces_are_encoded_whole():
    """A normalizer or other pre-tokenizer in the file is obeyed."""
    encoder = to.ChunkEncoder("word_bpe_49k.json")
    for text in ("Hello World 2024, plain  Latin Text.", "Café café 漢字", "", " a\n\nb "):
        library = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(text), "<u4").tolist() == library
    assert to.ChunkEncoder(to.TOKENIZER).chunked and not encoder.chunked
