import random
import re

import numpy as np
import xxhash

from feira.llm import components, simhash
from tests.llm.conftest import same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, ids, radius=4):
    group = list(range(len(values)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                group[find(i)] = find(j)
    lowest = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc_id), doc_id)
    return [lowest.get(find(i)) for i in range(len(values))]


def test_masks_cover_every_pair_within_the_radius():
    masks = np.array(simhash.masks(4), np.uint64)
    assert len(masks) == 31
    rng = random.Random(3)
    for _ in range(20_000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert (masks & np.uint64(difference) == 0).any()


def test_rows_of_any_kind(documents, rows):
    found = simhash.near_groups(documents).collect()
    values = [brute_fingerprint(row[1] or "") for row in rows]
    ids = [row[0] for row in rows]
    expected = zip(ids, [f"{v:016x}" for v in values], brute_components(values, ids), strict=True)
    assert same(map(tuple, found), expected)


def test_one_of_each_group_stays(documents, tmp_path):
    """Two groups may have the same smallest doc_id: numbers can come twice."""
    left = simhash.drop_near_copies(documents)
    assert left.columns == documents.columns
    groups = simhash.grouped(documents, str(tmp_path)).select("component", "component_id").distinct()
    assert same([row.doc_id for row in left.collect()], [row.component_id for row in groups.collect()])


def test_dense_groups_and_chains(spark, tmp_path, monkeypatch):
    """Buckets that are cut into parts give the components that whole ones give."""
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(5)
    values, chain = set(), 0
    for bit in range(40):
        chain ^= 1 << bit
        values.add(chain)
    centre = rng.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(120)}
    values |= {rng.getrandbits(64) for _ in range(60)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    table = spark.createDataFrame(signed, "fp long").repartition(3)
    links = simhash.links(table, str(tmp_path))
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in links.collect())
    found = {r.node: r.component for r in components.components(links, str(tmp_path)).collect()}
    own = [row[0] for row in signed]
    expected = brute_components(values, own)
    assert [found.get(v, v) for v in own] == expected


def test_long_texts_are_counted_in_parts():
    hashes = np.random.default_rng(2).integers(0, 2**63, 200_000).astype(np.uint64)
    ones = [(hashes >> np.uint64(b) & np.uint64(1)).sum() for b in range(64)]
    assert simhash.majority(hashes) == sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes))


def test_empty(empty):
    assert simhash.near_groups(empty).collect() == []
    assert simhash.drop_near_copies(empty).collect() == []
