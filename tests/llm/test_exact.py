import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from feira.llm import exact_dedup, golomb
from tests.llm.conftest import same


@given(st.sets(st.integers(0, 2**62)))
def test_golomb_round_trip(values):
    numbers = np.array(sorted(values), np.uint64)
    assert golomb.decode(golomb.encode(numbers)).tolist() == numbers.tolist()


def test_golomb_code_is_short():
    numbers = np.unique(np.random.default_rng(1).integers(0, 2**46, 100_000).astype(np.uint64))
    assert len(golomb.encode(numbers)) < 4 * len(numbers)


def expected(rows):
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[row[1] or ""].append((-1 if row[0] is None else row[0], i))
    return groups


def test_groups_match_brute_force(documents, rows):
    found = exact_dedup.exact_groups(documents).collect()
    groups = expected(rows)
    assert len(found) == len(rows)
    for row in found:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == row.text_sha256)
        largest = max(groups[text])[0]
        assert row.group_size == len(groups[text])
        assert (-1 if row.keep_id is None else row.keep_id) == largest
    kept = [row.text_sha256 for row in found if row.kept]
    assert len(kept) == len(set(kept)) == len(groups)
    assert all(row.doc_id == row.keep_id for row in found if row.kept)


def test_one_row_of_each_text_stays_whole(documents):
    left = exact_dedup.drop_exact_copies(documents)
    assert left.columns == documents.columns
    texts = [row.text or "" for row in left.collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) == {row.text or "" for row in documents.collect()}


def test_many_senders_and_owners_find_the_same(documents, tmp_path):
    light = exact_dedup.digests(documents).coalesce(1).cache()
    one = exact_dedup.suspects(light, 1).collect()
    assert same(map(tuple, one), map(tuple, exact_dedup.suspects(light, 7).collect()))


def test_empty(empty):
    assert exact_dedup.exact_groups(empty).collect() == []
    assert exact_dedup.drop_exact_copies(empty).collect() == []
