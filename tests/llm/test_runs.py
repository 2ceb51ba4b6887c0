import random
import re
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from feira.llm import periodic_runs as pr
from feira.llm.common import read_documents
from tests.llm.conftest import SF, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every period is tried on its own."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                root = words[i : i + q]
                divisors = [d for d in range(1, q) if q % d == 0]
                if not any(root == root[:d] * (q // d) for d in divisors):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_rewritten(doc_id, words):
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = brute_rewritten(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digests = [sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *best, milli, *digests, len(words))


def generated(rng):
    """Words of few kinds, periodic parts inside periodic parts, one word changed here and there."""
    words = []
    while len(words) < rng.randint(1, 400):
        period = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 13, 16, 31, 40]))]
        if rng.random() < 0.5:
            period += rng.choice("ab") * rng.randint(0, 40)
        words += (period * 12)[: int(len(period) * rng.uniform(0.5, 9))]
        words += [f"w{rng.randrange(3)}" for _ in range(rng.randrange(4))]
    if rng.random() < 0.4:
        words[rng.randrange(len(words))] = "odd"
    return [w.encode() for w in words]


def test_runs_equal_brute_force():
    rng = random.Random(11)
    documents = [generated(rng) for _ in range(400)]
    documents += [[b"a"] * n for n in range(12)] + [[], [b"a", b"b"] * 3, [b"a", b"b"] * 4]
    documents += [[bytes([c]) for c in rng.choices(b"ab", k=200)] for _ in range(60)]
    expected = [brute_runs(words) for words in documents]
    assert sum(map(len, expected)) > 1000
    for size in (1, 7, len(documents)):
        found = []
        for i in range(0, len(documents), size):
            found += [list(map(tuple, r.tolist())) for r in pr.runs_of(documents[i : i + size])]
        assert found == expected


def test_long_periods_and_long_texts():
    rng = random.Random(4)
    period = [b"%d" % rng.randrange(10**6) for _ in range(997)]
    words = [b"x"] * 5 + period * 5 + period[:300] + [b"y"] * 4000
    assert pr.runs_of([words])[0].tolist() == [[5, 5285, 997], [5290, 4000, 1]]


@pytest.mark.parametrize("t", [4, 8, 16])
def test_selection_is_consistent_and_dense(t):
    """Equal contexts are selected alike; t positions without one are highly periodic."""
    rng = np.random.default_rng(t)
    words = np.concatenate([rng.integers(0, 2, 300), np.tile([0], 150), np.tile([0, 1], 90), rng.integers(0, 2, 300)])
    stretch = [tuple(words[i : i + t]) for i in range(len(words) - t + 1)]
    number = {s: k for k, s in enumerate(dict.fromkeys(stretch))}
    names = np.array([number[s] for s in stretch] + [0] * (t - 1))

    def smallest(s):
        return next(p for p in range(1, len(s) + 1) if all(a == b for a, b in zip(s, s[p:], strict=False)))

    periodic = np.array([smallest(s) * 4 <= t for s in stretch] + [False] * (t - 1))
    left = len(words) - np.arange(len(words))
    chosen = pr.selected(names, left, t, periodic)
    by_context = {}
    for i in range(len(words) - 2 * t + 1):
        by_context.setdefault(tuple(words[i : i + 2 * t]), set()).add(bool(chosen[i]))
    assert all(len(kinds) == 1 for kinds in by_context.values())
    for i in range(len(words) - 3 * t + 2):
        if not chosen[i : i + t].any():
            assert 4 * smallest(tuple(words[i : i + 3 * t - 1])) <= t


def test_query_on_a_given_table(spark):
    rows = read_documents(spark, SF).select("doc_id", "text").collect()
    expected = [brute_row(*row) for row in rows]
    assert sum(row[1] > 0 for row in expected) > 5
    found = pr.op13_periodic_runs(spark, SF)
    assert same(map(tuple, found.collect()), expected)


def test_rows_of_any_kind(documents, rows):
    found = pr.periodic_runs(documents).collect()
    expected = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = brute_runs(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        expected.append((doc_id, len(words), runs, kept))
    assert same([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found], expected)


def test_empty(empty):
    assert pr.periodic_runs(empty).collect() == []
