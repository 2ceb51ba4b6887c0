import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feira.llm import bpe
from feira.llm.common import read_documents
from tests.llm.conftest import SF, same

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Bpe.from_file(PATH).made()

PARTS = ["a", "th", " the", "'ll", "'", "é", "字", "😀", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c"]
PARTS += ["\x85", " ", "1", "²", "½", "...", "!", "<|endoftext|>", "<|endof", "zzzz", "‍"]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=40))
def test_ids_and_text_are_the_library_s(text):
    ids = OWN.encode(text)
    assert ids.tolist() == library_ids(text)
    assert OWN.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("unit", ["a", "ab ", "th", "\n", " ", "a" * 70 + "b", "é", "!?"])
def test_very_long_runs(unit):
    text = unit * (30_000 // len(unit))
    assert OWN.encode(text).tolist() == library_ids(text)


def test_every_token_is_its_own_encoding():
    special = set(OWN.special.values())
    assert all(OWN._piece(data) == [i] for i, data in OWN.tokens.items() if i not in special)


def test_remembered_results_are_bounded():
    made = bpe.Remembered(str, size=10)
    assert [made[i] for i in range(1000)] == [str(i) for i in range(1000)]
    assert len(made) + len(made.old) <= 20


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Bpe.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(found, rows):
    expected = []
    for doc_id, text in rows:
        ids = library_ids(text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert same(map(tuple, found.collect()), expected)


def test_rows_of_any_kind(documents, rows):
    check(bpe.round_trip(documents, PATH), [row[:2] for row in rows])


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).collect()]
    check(bpe.op1_bpe(spark, SF), rows)


def test_tables_of_ids_and_back(documents, rows):
    encoded = bpe.encode_documents(documents, PATH)
    assert same([tuple(r.ids) for r in encoded.collect()], [tuple(library_ids(r[1] or "")) for r in rows])
    decoded = bpe.decode_documents(encoded, PATH)
    assert same([tuple(r) for r in decoded.collect()], [(r[0], r[1] or "") for r in rows])


def test_joined_parts_of_a_table():
    table = bpe.Table([b"", b"ab", b"c"])
    numbers = np.array([1, 0, 2, 2] * 100_000)
    assert table.joined(numbers) == b"abcc" * 100_000
    assert table.joined(np.zeros(0, np.int64)) == b""


def test_empty(empty):
    assert bpe.round_trip(empty, PATH).collect() == []


def test_every_code_point_is_cut_as_the_library_does():
    """Behind and before a letter, a digit, a sign and a space."""
    from tokenizers.pre_tokenizers import ByteLevel

    cutter = ByteLevel(add_prefix_space=False, use_regex=True)
    pattern = bpe.Bpe.from_file(PATH).made().pattern
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for begin in range(0, len(points), 1 << 15):
        text = "\n".join(f"a{c}b {c}1{c}2!{c}? " for c in map(chr, points[begin : begin + (1 << 15)]))
        expected = [span for _, span in cutter.pre_tokenize_str(text)]
        assert [m.span() for m in pattern.finditer(text)] == expected


@pytest.mark.parametrize("text", [chr(0x1DF36) + chr(0x69D7), chr(0x19148) + chr(0x8082), "a\x1cb \x1c c", "\x85 x\u180e y"])
def test_newer_characters(text):
    assert bpe.Bpe.from_file(PATH).made().encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_words_are_not_remembered():
    made = bpe.Bpe.from_file(PATH).made()
    made.encode(" ".join("x" * 60 + str(i) * 10 for i in range(500)))
    tables = (made.after_space, made.piece)
    assert max((len(word) for table in tables for word in table), default=0) <= bpe.LONGEST_KEPT
