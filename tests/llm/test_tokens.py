import pickle
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feira.llm import bpe, idcoder, token_files
from feira.llm.common import read_documents
from tests.llm.conftest import SF

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
GIVEN = "/root/testdata/sf0.01"


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, idcoder.MOST - 1) | st.integers(0, 3), max_size=300),
    st.integers(1, 40),
)
def test_segments_round_trip(ids, block):
    numbers = np.array(ids, np.int64)
    assert idcoder.decode(idcoder.encode(numbers, block)).tolist() == ids


@pytest.mark.parametrize("kind", ["same", "random", "periodic", "skewed"])
def test_long_segments_round_trip(kind):
    rng = np.random.default_rng(4)
    size = 40_000
    numbers = {
        "same": np.full(size, 50256),
        "random": rng.integers(0, idcoder.MOST, size),
        "periodic": np.arange(size) % 37,
        "skewed": (50_000 * rng.random(size) ** 8).astype(np.int64),
    }[kind]
    segment = idcoder.encode(numbers)
    assert (idcoder.decode(segment) == numbers).all()
    bits = 8 * len(segment) / size
    assert bits < {"same": 0.5, "random": 26, "periodic": 2, "skewed": 14}[kind]


def test_blocks_are_checked():
    segment = bytearray(idcoder.encode(np.arange(5000)))
    segment[-20] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        idcoder.decode(bytes(segment))


def test_the_list_of_ids_is_checked():
    segment = bytearray(idcoder.encode(np.arange(5000) % 700))
    segment[idcoder._HEAD.size + 9] ^= 1
    with pytest.raises(ValueError, match="list"):
        idcoder.decode(bytes(segment))


def test_ids_of_texts_are_packed_better_than_by_zlib():
    """And than by the frequencies of the ids alone."""
    ids = []
    for (text,) in duckdb.sql(f"SELECT text FROM '{GIVEN}/documents.parquet' ORDER BY doc_id").fetchall():
        ids += LIBRARY.encode(text, add_special_tokens=False).ids + [token_files.END_ID]
    numbers = np.array(ids)
    segment = idcoder.encode(numbers)
    assert (idcoder.decode(segment) == numbers).all()
    shares = np.bincount(numbers)[np.unique(numbers)] / len(numbers)
    alone = -(shares * np.log2(shares)).sum() * len(numbers) / 8
    assert len(segment) < alone
    assert len(segment) < 0.95 * len(zlib.compress(numbers.astype("<u2").tobytes()))


@pytest.mark.parametrize("size", [1, 2, 1023, 1024, 1025, 70_000])
def test_rare_and_many_different_ids(size, monkeypatch):
    monkeypatch.setattr(idcoder, "MOST_LISTED", 50)
    rng = np.random.default_rng(size)
    numbers = np.where(rng.random(size) < 0.2, rng.integers(0, idcoder.MOST, size), rng.integers(0, 300, size))
    assert (idcoder.decode(idcoder.encode(numbers)) == numbers).all()


def test_ids_out_of_range_are_refused():
    for value in (-1, idcoder.MOST):
        with pytest.raises(ValueError):
            idcoder.encode(np.array([value]))


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


def test_whole_table(spark):
    rows = sorted((r.doc_id, r.text) for r in read_documents(spark, SF).collect())
    found = token_files.op10_token_files(spark, SF).orderBy("start").collect()
    assert [tuple(row) for row in found] == expected(rows)


def test_small_segments(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    rows = sorted((r.doc_id, r.text) for r in read_documents(spark, SF).collect())
    found = token_files.op10_token_files(spark, SF).orderBy("start").collect()
    assert [tuple(row) for row in found] == expected(rows)


def test_rows_of_any_kind(documents, rows):
    found = token_files.stored_ids(documents, PATH).orderBy("start").collect()
    order = [row.doc_id for row in found]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert [row.start for row in found] == np.cumsum([0, *[r.n_tokens for r in found[:-1]]]).tolist()
    by_content = {(i, n, crc) for i, _, n, crc in expected([row[:2] for row in rows])}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in found} == by_content
    assert len(found) == len(rows)


def test_very_long_texts_go_to_the_library(monkeypatch):
    vocabulary = bpe.Bpe.from_file(PATH)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.Encoder(vocabulary, file.read())
    for text in ["some text<|endoftext|> more", " " * 3000 + "a", "word " * 2000]:
        assert encoder.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        monkeypatch.setattr(token_files, "LONG_TEXT", 10)
        assert encoder.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        monkeypatch.undo()


def own_encoder():
    with open(PATH, encoding="utf-8") as file:
        return token_files.Encoder(bpe.Bpe.from_file(PATH), file.read())


def test_different_words_of_a_batch_are_encoded_once(monkeypatch):
    """the seconds of a GB went into encoding words again and again."""
    encoder, seen = own_encoder(), []
    whole = encoder.fast.encode_to_numpy
    monkeypatch.setattr(encoder.fast, "encode_to_numpy", lambda text, **how: seen.append(len(text)) or whole(text, **how))
    texts = [f"{i} " + "some words that come again, and again" for i in range(100)]
    found = [ids.tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert found == [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts]
    assert sum(seen) < 300 < sum(map(len, texts))


@pytest.mark.parametrize("kept", [0, 3, 1 << 19])
def test_words_of_earlier_batches(kept, monkeypatch):
    """remembered, within a bound, and with the same ids."""
    monkeypatch.setattr(token_files, "WORDS_KEPT", kept)
    encoder, seen = own_encoder(), []
    whole = encoder._new_words
    monkeypatch.setattr(encoder, "_new_words", lambda words: seen.append(len(words)) or whole(words))
    for texts in (["a b c", "d b"], ["a c b", None, "x y z y"], ["a y", ""], ["a c y"]):
        found = [ids.tolist() for ids in encoder.encode_all(pa.array(texts))]
        assert found == [LIBRARY.encode(text or "", add_special_tokens=False).ids for text in texts]
        assert encoder.known is None or len(encoder.known[0]) <= kept
    assert seen == {0: [2, 4, 1, 2], 3: [2, 2, 1, 1], 1 << 19: [2, 2]}[kept]


def test_tables_are_made_once_in_a_process():
    encoder = pickle.loads(pickle.dumps(own_encoder()))
    assert encoder.fast is encoder.fast
    assert "exact" not in vars(encoder)


ENCODER = own_encoder()
SIGNS = ["a", "b'", "s", " ", "  ", "\n", "\r\n", "\x0b", "\x85", "\x1c", "\u180e", "\u200b", "\u3000"]
SIGNS += [" the", " word.", "1", "²", "é", "字", "!", "<|endoftext|>", "<|end", "\U0001f600"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(SIGNS), max_size=12).map("".join), max_size=12))
def test_batches_are_encoded_as_by_the_library(texts):
    found = list(ENCODER.encode_all(pa.array(texts, pa.string())))
    assert [ids.tolist() for ids in found] == [LIBRARY.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_long_texts_of_a_batch(monkeypatch):
    monkeypatch.setattr(token_files, "LONG_TEXT", 20)
    texts = ["short text", "a text of more than twenty characters", None, "end", " and spaces "]
    found = list(ENCODER.encode_all(pa.array(texts)))
    assert [ids.tolist() for ids in found] == [LIBRARY.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_empty(empty):
    assert token_files.stored_ids(empty, PATH).collect() == []
