import random
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from roadmill.llm import token_blocks as tb
from roadmill.llm.queries import tokenizer_path


@given(st.lists(st.integers(0, 2**62), max_size=200))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    data = b"xx" + tb.EliasFano.of(np.array(values, np.uint64)).to_bytes()
    found, end = tb.EliasFano.read(data, 2)
    assert end == len(data)
    assert found.all().tolist() == values
    assert [found.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        found.select(len(values))


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 3000, 10_000))
    assert len(tb.EliasFano.of(ends).to_bytes()) * 8 < len(ends) * 15


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**60), 2**60)), st.lists(st.integers(0, 65535), max_size=8)), max_size=30))
def test_block_round_trip(docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    data = tb.pack_block([i for i, _ in docs], np.cumsum([len(t) for _, t in docs]), b"".join(np.array(t, "<u2").tobytes() for _, t in docs), 2)
    block = tb.open_block(data)
    assert block.doc_ids() == [i for i, _ in docs]
    assert [block.doc_id(k) for k in range(len(docs))] == [i for i, _ in docs]
    assert [block.tokens(k).tolist() for k in range(len(docs))] == [t for _, t in docs]


def test_what_is_no_block_is_refused():
    with pytest.raises(ValueError):
        tb.open_block(b"\0" * 64)


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


TEXTS = [
    "", " ", "Hello  world", "don't we'LL", "é É ß Ü ñ Ñ × ÷ ÿ", "x y z", "éclair café", "<|endoftext|> <|startoftext|>", "a<|endoftext|>b", "١٢٣ ²³", "a\x1cb\x85c", "日本語 テスト", "İstanbul ΣΑΣ", "!!! ??%$", "__a_b__",
    "1234 5a6", "it's 's 's's", "🙂 emoji🙂x", "́a", "tab\tnew\nline\r\n", "ﬁ ligature", "o'clock ' 'd've",
]


def test_encoder_equals_the_library():
    encoder = tb.Encoder(tokenizer_path(), 1)
    assert encoder.by_chunk and encoder.by_model
    rng = random.Random(2)
    letters = "abcXYZ 019'!.,éÉßñ-_<|>\t\n ²"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(60)) for _ in range(400)]
    encoder.LIMIT = 50  # generations turn over
    got = []
    for i in range(0, len(texts), 7):
        got += encoder.encode(texts[i : i + 7])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [ids + [1] for ids in plain_ids(texts)]


def test_tokenizers_that_look_past_white_space_get_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    encoder = tb.Encoder(path, 1)
    assert not encoder.by_chunk
    whole = Tokenizer.from_file(path).encode("two  words", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(["two  words"])[0], encoder.type).tolist() == [*whole, 1]


def brute(rows):
    ids = plain_ids([t or "" for _, t in rows])
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    out, start = [], 0
    for k in order:
        a = [*ids[k], 1]
        out.append((rows[k][0], start, len(a), zlib.crc32(np.array(a, "<u4").tobytes())))
        start += len(a)
    return out


@pytest.mark.parametrize("block_ids,block_docs", [(1 << 18, 1 << 14), (10, 1 << 14), (1 << 18, 1)])
def test_documents_read_back_equal_brute_force(spark, block_ids, block_docs):
    rng = random.Random(5)
    rows = [(i, rng.choice(TEXTS) * rng.randrange(1, 4)) for i in rng.sample(range(-50, 10_000), 80)] + [(20_000, None), (20_001, ""), (None, "null id"), (20_002, "long " * 30_000)]
    df = spark.createDataFrame([(i, t, "e") for i, t in rows], "doc_id long, text string, n_tokens string")
    got = tb.read_documents(tb.write_blocks(df, tokenizer_path(), 1, block_ids, block_docs)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute(rows)


def test_repeated_ids_are_documents_of_their_own(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (0, "d")], "doc_id long, text string")
    got = sorted(map(tuple, tb.read_documents(tb.write_blocks(df, tokenizer_path(), 1)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [0, 1, 1, 1]
    assert sum(r[2] for r in got) == got[-1][1] + got[-1][2]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tb.read_documents(tb.write_blocks(df, tokenizer_path(), 1)).count() == 0


def test_blocks_with_a_path_outlive_the_scratch_tables(spark, tmp_path):
    from roadmill.llm.common import sweep

    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    tb.write_blocks(df, tokenizer_path(), 1, path=f"{tmp_path}/blocks")
    sweep(spark)
    rows = tb.read_blocks(spark, f"{tmp_path}/blocks").orderBy("part", "seq").collect()
    found = [(b.doc_id(k), b.tokens(k).tolist()) for b in (tb.open_block(r.payload) for r in rows) for k in range(b.n_docs)]
    assert found == [(k, [*ids, 1]) for k, ids in enumerate(plain_ids(TEXTS))]
