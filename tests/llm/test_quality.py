import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from feira.llm import quality_rules
from feira.llm.common import read_documents
from tests.llm.conftest import same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
    )


@given(st.lists(st.sampled_from(["a", "b", "c#", "\n", " ", " ", "\x1c", "\x85", "é", "\r", ""])))
def test_base_counts(parts):
    text = " ".join(parts)
    assert quality_rules.base_counts(text, text.encode().split()) == brute(text)


def test_many_kinds_of_words_still_fit():
    ids = np.array([5, 6, 7, 8, 5, 6, 7])
    assert quality_rules.repeated_words(ids, 9) == 6
    assert quality_rules.repeated_words(ids, 1 << 40) == 6


def test_short_words_are_told_by_letters_in_any_script():
    text = "Привет, привет है नमस्ते ひらがなです (((((word))))) ............. longest straße"
    found = quality_rules.short_words(text.encode().split(), quality_rules._Plain())
    expected = {"привет": 2, "है": 1, "नमस्ते": 1, "ひらがなです": 1, "word": 1, "straße": 1}
    assert found == expected


def test_js_distance():
    a = np.array([1.0, 0.0])
    assert quality_rules.js_distance(a, np.array([0.0, 3.0])) == pytest.approx(1.0)
    assert quality_rules.js_distance(a, 5 * a) == 0.0
    assert quality_rules.js_distance(a, 0 * a) == 0.0


def test_rows_of_any_kind(documents, rows):
    found = quality_rules.quality_verdicts(documents).collect()
    own = [tuple(row)[:6] for row in found]
    assert same(own, [(row[0], *brute(row[1] or "")) for row in rows])
    for row in found:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert not (row.kept and failed)


def test_the_stage_drops_what_the_query_rejects(documents):
    left = quality_rules.drop_rejected(documents)
    assert left.columns == documents.columns
    kept = [row.doc_id for row in quality_rules.quality_verdicts(documents).where("kept").collect()]
    assert same([row.doc_id for row in left.collect()], kept)


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    verdicts = quality_rules.quality_verdicts(read_documents(spark, folder))
    rows = verdicts.join(labels, "doc_id").where("not base_failed").collect()
    good = [row.kept for row in rows if row.quality == 1]
    bad = [row.kept for row in rows if row.quality == 0]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.1


def judged(spark, texts):
    """Verdicts on texts of one language, in their order."""
    frame = spark.createDataFrame([(i, "en", text) for i, text in enumerate(texts)], "doc_id long, lang string, text string")
    return quality_rules.quality_verdicts(frame.repartition(4)).orderBy("doc_id").collect()


def prose(rng, n):
    letters = "eeeeaaoottiinnsshrdlcum"
    words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, n, 12)) + "."


def junk(rng, n, signs):
    return " ".join("".join(rng.choices(signs, k=rng.randint(2, 9))) for _ in range(n))


JUNK = ["0123456789", "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]


@pytest.mark.parametrize("long", [1, 40])
def test_junk_of_a_third_does_not_shape_the_reference(spark, long):
    """Junk in a third of the documents, or in a few very long ones with as many characters."""
    rng = random.Random(5)
    clean = [prose(rng, 400) for _ in range(80)]
    dirty = [junk(rng, 400 * long, signs) for signs in JUNK for _ in range(14 if long == 1 else 1)]
    share = sum(map(len, dirty)) / sum(map(len, clean + dirty))
    assert 0.3 < share < 0.7
    rows = judged(spark, clean + dirty)
    limit = quality_rules.MAX_CLASS_DISTANCE + quality_rules.CLASS_CHANCE * 400**-0.5
    assert max(row.class_distance for row in rows[:80]) < limit
    assert min(row.class_distance for row in rows[80:]) > limit
    assert not any(row.kept for row in rows[80:])


def test_a_language_without_usual_documents_has_a_reference(spark):
    """A third of the documents each in digits, signs and capitals: all medians but white space are 0."""
    rng = random.Random(6)
    rows = judged(spark, [junk(rng, 400, signs) for signs in JUNK for _ in range(10)])
    distances = [row.class_distance for row in rows]
    assert 0.3 < min(distances)
    assert max(distances) - min(distances) < 0.1


def test_empty(empty):
    assert quality_rules.quality_verdicts(empty).collect() == []
    assert quality_rules.drop_rejected(empty).collect() == []
