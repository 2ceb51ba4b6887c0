"""Substring dedup by hashing units of text: lines, and sentences within lines.

Units are all lines with a word in them, however short, and the sentences of lines that have
several, cut after a sentence sign with a space. A sentence must have ``SENTENCE_CHARS`` code
points or more: "Yes. " or "No. 5. " between others says nothing on its own. A unit is normalised
(letters A-Z in lower case, white space as one space) and digested. It is removed if its digest
occurs before it in its document, or anywhere in a document with a smaller doc_id, so the
earliest ranked occurrence stays. Offsets are those of the original text, in code points.

All joins are by a shuffle, at every size: units and the texts that they are cut from move
once, in proportion to the input.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import read_documents, ship, sliced, stored, texts
from feira.sources.working import new_folder

# Normalised sentences inside a line are units from so many code points on.
SENTENCE_CHARS = 16

_LINE = re.compile(r"[^\n]*\n|[^\n]+")
_SENTENCE_END = re.compile(r"[.!?] ")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {letter: letter + 32 for letter in range(65, 91)}
# Key and spans of a row, beside columns of any name.
_DOC, _TIE, _SPANS = "_feira_doc", "_feira_tie", "_feira_spans"
# What a null doc_id counts as: it comes before all others.
_NO_ID = -(1 << 63)


def _normal(text: str) -> str:
    return " ".join(_WORDS.findall(text.translate(_LOWER)))


def units(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Begin, end and digest of every unit, a line before its sentences."""
    for line in _LINE.finditer(text):
        begin, end = line.span()
        if normal := _normal(line[0]):
            yield begin, end, xxhash.xxh3_128_digest(normal)
        ends = [mark.end() for mark in _SENTENCE_END.finditer(text, begin, end)]
        if ends and ends[-1] != end:
            ends.append(end)
        for stop in ends if len(ends) > 1 else []:
            sentence = _normal(text[begin:stop])
            if len(sentence) >= SENTENCE_CHARS:
                yield begin, stop, xxhash.xxh3_128_digest(sentence)
            begin = stop


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "tie", "begin", "end", "digest", "again"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    for batch in sliced(batches, 1 << 22):
        columns = [[] for _ in names]
        keys = zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), strict=True)
        for (doc, tie), text in zip(keys, texts(batch["text"]), strict=True):
            seen = set()
            for begin, end, digest in units(text):
                for column, value in zip(columns, (doc, tie, begin, end, digest, digest in seen), strict=True):
                    column.append(value)
                seen.add(digest)
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the key and text. Rows with equal keys are the same document."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(_NO_ID)).alias(_DOC),
        F.xxhash64("text").alias(_TIE),
        "text",
    )


def removed_units(docs: DataFrame, folder: str) -> DataFrame:
    """(doc, tie, begin, end) of every removed unit."""
    ship(docs.sparkSession)
    found = _keyed(docs).select(F.col(_DOC).alias("doc"), F.col(_TIE).alias("tie"), "text").mapInArrow(
        _unit_batches, "doc long, tie long, begin long, end long, digest binary, again boolean"
    )
    found = stored(found, "units", folder)
    ranks = found.where("not again").groupBy("digest").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last")
    )
    shared = stored(ranks.where("first < last").select("digest", "first"), "shared", folder)
    elsewhere = found.where("not again").join(shared, "digest").where("doc > first")
    span = ["doc", "tie", "begin", "end"]
    return elsewhere.select(*span).union(found.where("again").select(*span))


def _cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """What is left of a text, how many code points go, and in how many runs. A line's span may
    hold those of its sentences."""
    parts, place, removed, runs, last = [], 0, 0, 0, -1
    for begin, end in sorted(spans):
        if end <= place:
            continue
        begin = max(begin, place)
        parts.append(text[place:begin])
        runs += begin != last
        removed += end - begin
        place = last = end
    return "".join([*parts, text[place:]]), removed, runs


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "n_removed", "n_spans", "kept_sha256"]
    for batch in sliced(batches):
        rows = []
        for text, spans in zip(texts(batch["text"]), batch[_SPANS].to_pylist(), strict=True):
            left, removed, runs = _cut(text, [(s["begin"], s["end"]) for s in spans or []])
            rows.append((len(text), removed, runs, hashlib.sha256(left.encode()).hexdigest()))
        columns = [np.array([row[i] for row in rows], np.int64) for i in range(3)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *map(pa.array, columns), pa.array([row[3] for row in rows], pa.string())],
            names,
        )


def _text_batches(columns: list[str]):
    def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            left = [
                _cut(text, [(s["begin"], s["end"]) for s in spans])[0] if spans else value
                for text, spans, value in zip(
                    texts(batch["text"]), batch[_SPANS].to_pylist(), batch["text"].to_pylist(), strict=True
                )
            ]
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "text", pa.array(left, pa.string())).select(columns)

    return text_batches


def _with_spans(docs: DataFrame, keyed: DataFrame, folder: str) -> DataFrame:
    """``keyed`` (with its key) and the removed spans of each row."""
    removed = stored(removed_units(docs, folder), "removed", folder)
    spans = removed.groupBy(F.col("doc").alias(_DOC), F.col("tie").alias(_TIE)).agg(
        F.collect_set(F.struct("begin", "end")).alias(_SPANS)
    )
    spans = stored(spans, "spans", folder)
    return keyed.join(spans, [_DOC, _TIE], "left")


def deduplicated_units(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, n_removed, n_spans, kept_sha256.

    n_removed counts code points, n_spans runs of removed units, the digest is that of what is
    left. A null text is an empty one, a null doc_id comes before all others. Rows that repeat
    a doc_id and its text are the same document and get the same result; of different texts
    with one doc_id none comes before the other. An empty table gives no rows. Other columns
    are not read.
    """
    folder = folder or new_folder(docs.sparkSession)
    joined = _with_spans(docs, _keyed(docs), folder)
    return joined.select("doc_id", "text", _SPANS).mapInArrow(
        _result_batches,
        "doc_id long, n_chars long, n_removed long, n_spans long, kept_sha256 string",
    )


def without_repeated_units(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` with the repeated units cut out of the texts, all other columns as they were."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    keyed = docs.withColumns({_DOC: doc, _TIE: F.xxhash64("text")})
    joined = _with_spans(docs, keyed, folder or new_folder(docs.sparkSession))
    return joined.mapInArrow(_text_batches(docs.columns), docs.schema)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_units(read_documents(spark, sf_dir))


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines FROM documents)),
c AS (
  SELECT doc_id, line, line_no, regexp_extract_all(line, '(?s).*?[.!?] |.+') AS pieces FROM l),
p AS (
  SELECT doc_id, line_no, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS piece_no, len(pieces) AS n FROM c),
u AS (
  SELECT doc_id, line_no, 0 AS piece_no, line AS unit, 1 AS least FROM l
  UNION ALL SELECT doc_id, line_no, piece_no, piece, 16 FROM p WHERE n > 1),
n AS (
  SELECT doc_id, line_no, piece_no, least, array_to_string(regexp_extract_all(
           translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), ' ') AS plain
  FROM u),
r AS (
  SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, line_no, piece_no) > 1 AS removed
  FROM n WHERE length(plain) >= least),
g AS (
  SELECT p.doc_id, p.line_no, p.piece_no, p.piece,
         coalesce(whole.removed, false) OR coalesce(part.removed, false) AS removed
  FROM p LEFT JOIN r whole ON (whole.doc_id, whole.line_no, whole.piece_no) = (p.doc_id, p.line_no, 0)
         LEFT JOIN r part ON (part.doc_id, part.line_no, part.piece_no) = (p.doc_id, p.line_no, p.piece_no)),
s AS (
  SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY line_no, piece_no), false) AS opens
  FROM g)
SELECT d.doc_id, CAST(coalesce(sum(length(piece)), 0) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(length(piece)) FILTER (removed), 0) AS BIGINT) AS n_removed,
       count(*) FILTER (opens) AS n_spans,
       sha256(coalesce(string_agg(piece, '' ORDER BY line_no, piece_no) FILTER (NOT removed), '')) AS kept_sha256
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
