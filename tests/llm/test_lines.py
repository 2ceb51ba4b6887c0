import hashlib
import re

import duckdb

from feira.llm import line_dedup
from tests.llm.conftest import SF, same


def plain(unit):
    words = re.findall(r"[^\x20\x09-\x0D]+", unit)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(words))


def pieces_of(text):
    """Lines, each as the list of its sentences."""
    out = []
    for line in re.split(r"(?<=\n)", text):
        if line:
            out.append([p for p in re.split(r"(?<=[.!?] )", line) if p])
    return out


def brute(rows):
    """(doc_id, text) rows; rows with equal ids and texts are one document."""
    rank = {None: -(10**20)}
    documents = {(i, text or ""): pieces_of(text or "") for i, text in rows}

    def units(pieces):
        yield None, plain("".join(pieces)), 1
        if len(pieces) > 1:
            for k, piece in enumerate(pieces):
                yield k, plain(piece), 16

    first = {}
    for (i, _), lines in documents.items():
        for pieces in lines:
            for _, key, least in units(pieces):
                if len(key) >= least:
                    first[key] = min(first.get(key, 10**20), rank.get(i, i))
    out = []
    for i, text in rows:
        seen, kept, removed, runs, last = set(), [], 0, 0, False
        for pieces in documents[i, text or ""]:
            gone = set()
            for k, key, least in units(pieces):
                if len(key) >= least:
                    if key in seen or first[key] < rank.get(i, i):
                        gone |= set(range(len(pieces))) if k is None else {k}
                    seen.add(key)
            for k, piece in enumerate(pieces):
                runs += k in gone and not last
                last = k in gone
                removed += len(piece) * last
                kept += [] if last else [piece]
        digest = hashlib.sha256("".join(kept).encode()).hexdigest()
        out.append((i, len(text or ""), removed, runs, digest))
    return out


def test_rows_of_any_kind(documents, rows):
    found = line_dedup.deduplicated_units(documents).collect()
    assert same(map(tuple, found), brute([row[:2] for row in rows]))


def test_texts_are_cut(documents):
    left = line_dedup.without_repeated_units(documents)
    assert left.columns == documents.columns
    digests = [hashlib.sha256((row.text or "").encode()).hexdigest() for row in left.collect()]
    expected = [row.kept_sha256 for row in line_dedup.deduplicated_units(documents).collect()]
    assert same(digests, expected)


def test_offsets_are_those_of_the_text():
    text = "One two three four. Zwei wörter\nfive six seven eight"
    assert [(b, e) for b, e, _ in line_dedup.units(text)] == [(0, 32), (0, 20), (32, 52)]


def test_short_lines_and_text_without_spaces(frame):
    """A menu, a line of Chinese, and short sentences of a line: the first two go."""
    one = "Menu\nHome\n我喜欢在公园里散步\nYes. No. A sentence of its own here. End"
    two = "Start\nMenu\n我喜欢在公园里散步\nNo. Yes. A sentence of its own here. Stop\n\nHome"
    docs = frame("doc_id long, text string", (1, one), (2, two))
    left = {row.doc_id: row.text for row in line_dedup.without_repeated_units(docs).collect()}
    assert left == {1: one, 2: "Start\nNo. Yes. Stop\n\n"}
    found = line_dedup.deduplicated_units(docs).collect()
    assert same(map(tuple, found), brute([(1, one), (2, two)]))


def test_query_and_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = connection.execute(line_dedup.OP8_SQL).fetchall()
    assert same(map(tuple, line_dedup.op8_line_dedup(spark, SF).collect()), expected)
    table = connection.execute("SELECT doc_id, text FROM documents").fetchall()
    assert same(brute(table), expected)


def test_empty(empty):
    assert line_dedup.deduplicated_units(empty).collect() == []
    assert line_dedup.without_repeated_units(empty).collect() == []
