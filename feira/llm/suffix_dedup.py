"""Removal of repeated 50-byte strings, by a difference cover over all texts.

Suffixes are compared to a depth of 50 bytes only. The positions of a buffer that are in a
difference cover modulo 31 are sampled: for any two positions there is a shift below 31 that
brings both into the sample, so two equal strings of 50 bytes have equal sampled tuples of 20
bytes at the same shift. With tuples that long one level of names settles the depth, and no
recursion on names is left to do.

1. Equal texts are found first; of each, the one with the smallest doc_id is worked on.
2. Texts are put into blocks in order of doc_id and stored. Each block names its sampled
   tuples (by fingerprints), sorts the names, and sends them to the owners of ranges of names
   as Golomb codes; an owner merges the sorted lists and answers with a bitmap: which names
   another block has as well.
3. The remaining suffixes that are up to 30 bytes before a repeated tuple are merged in: their
   50-byte prefixes are named by strongly universal hashes, sorted and sent in the same way,
   with a check beside each name. Prefixes of equal names and checks are neighbours in the
   owner's merge; it answers which prefixes an earlier block has.
4. Each block marks what is covered by prefixes that an earlier block, or a smaller doc_id in
   itself, has.

What moves is a few bytes per name and a bit for the answer, never the texts.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import golomb
from feira.llm.common import read_documents, ship, small, stored
from feira.sources.working import new_folder

LENGTH = 50
# A difference cover modulo 31; every difference occurs once.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
TUPLE = LENGTH - MODULUS + 1
# Names of tuples only have to be rarely equal by chance: so many bits more than it takes to
# number all tuples. Names of prefixes decide, together with a check of 32 bits more.
SPARE_BITS, PREFIX_BITS = 12, 62
# Bytes of text worked on at once, and names that an owner merges.
PIECE = 1 << 22
OWNER_NAMES = 1 << 21
# Bytes of text of a block, on average. Blocks times owners is the number of messages.
BLOCK_BYTES = 12 << 20
# Answers up to this size are sent to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

# What a null doc_id counts as: it comes before all others.
_NO_ID = -(1 << 63)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Words of 8 bytes that hold a prefix; the last two overlap.
_OFFSETS = [*range(0, LENGTH - 8, 8), LENGTH - 8]
# Keys of three hashes of a prefix: a sum to start from, and a factor for each half of a word.
_KEYS = np.frombuffer(
    hashlib.shake_256(b"feira.suffix_dedup").digest(24 * (1 + 2 * len(_OFFSETS))), "<u8"
).reshape(-1, 3)
# Prefixes hashed at once, so that what is worked on stays in a processor's cache.
_HASHED = 1 << 14
_CODES = "owner int, block int, code binary"

# 62-bit names of prefixes, and a check of each: a string is told by both.
Names = tuple[np.ndarray, np.ndarray]


class Piece:
    """Some texts in one buffer, with where each begins and ends."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"".join([*texts, b"\0" * 8]), np.uint8)
        self.ends = np.cumsum([len(text) for text in texts])
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.words = np.ndarray(len(self.buffer) - 7, "<u8", self.buffer, 0, (1,))

    def text_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def names(self, places: np.ndarray, length: int, bits: int) -> np.ndarray:
        """Fingerprints of the ``length`` bytes at each place."""
        found = np.full(len(places), length, np.uint64)
        for offset in [*range(0, length - 8, 8), length - 8]:
            found ^= self.words[places + offset]
            found *= _MULTIPLIER
            found ^= found >> np.uint64(31)
        found *= _MULTIPLIER
        return found >> np.uint64(64 - bits)

    def prefix_names(self, places: np.ndarray) -> Names:
        """Names and checks of the prefixes at each place.

        Three multilinear hashes of 32-bit words with 64-bit keys, of which the upper bits are
        taken. These are strongly universal: whatever two different strings look like, they
        agree in all 94 bits for one of 2^94 choices of keys.
        """
        names, checks = np.empty(len(places), np.uint64), np.empty(len(places), np.uint32)
        lower = np.uint64((1 << 32) - 1)
        for start in range(0, len(places), _HASHED):
            some = slice(start, start + _HASHED)
            sums = [np.full(len(places[some]), key) for key in _KEYS[0]]
            for i, offset in enumerate(_OFFSETS):
                words = self.words[places[some] + offset]
                for half, keys in ((words & lower, _KEYS[2 * i + 1]), (words >> 32, _KEYS[2 * i + 2])):
                    for lane, key in zip(sums, keys, strict=True):
                        lane += half * key
            names[some] = (sums[0] >> 33 << 31 | sums[1] >> 33) >> (62 - PREFIX_BITS)
            checks[some] = sums[2] >> 32
        return names, checks

    def sampled(self) -> np.ndarray:
        """Places of the cover at which a whole tuple fits into its text."""
        size = len(self.buffer) - 8
        rows = np.arange(0, size, MODULUS)[:, None] + np.array(COVER)
        places = rows.ravel()
        places = places[places + TUPLE <= size]
        return places[places + TUPLE <= self.ends[self.text_at(places)]]

    def before(self, places: np.ndarray) -> np.ndarray:
        """Ranges (first, last) of places from which a prefix holds the tuple at a place."""
        text = self.text_at(places)
        first = np.maximum(places - MODULUS + 1, self.begins[text])
        last = np.minimum(places, self.ends[text] - LENGTH)
        some = first <= last
        first, last = first[some], last[some]
        new = np.ones(len(first), bool)
        new[1:] = first[1:] > last[:-1] + 1
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(first)) - 1 if len(first) else starts
        return np.column_stack([first[starts], last[stops]]).astype(np.int64)

    @staticmethod
    def within(ranges: np.ndarray) -> np.ndarray:
        """All places of the ranges."""
        sizes = ranges[:, 1] - ranges[:, 0] + 1
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(ranges[:, 0] - ends + sizes, sizes)


def pieces(texts: list[bytes]) -> Iterator[tuple[int, Piece]]:
    """The texts of a block in pieces, each with the number of its first text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= PIECE or i == len(texts) - 1:
            yield begin, Piece(texts[begin : i + 1])
            begin, size = i + 1, 0


def _cut(names: np.ndarray, owners: int, bits: int) -> list[np.ndarray]:
    """Sorted different names, cut by owner into numbers from the start of its range."""
    width = -(-(1 << bits) // owners)
    cuts = np.searchsorted(names, np.arange(1, owners, dtype=np.uint64) * np.uint64(width))
    return [part - np.uint64(i * width) for i, part in enumerate(np.split(names, cuts))]


def _codes(block: int, names: np.ndarray, owners: int, bits: int) -> list[tuple[int, int, bytes]]:
    parts = _cut(names, owners, bits)
    return [(i, block, golomb.encode(part)) for i, part in enumerate(parts) if len(part)]


def _prefix_codes(block: int, prefixes: Names, owners: int) -> list[tuple[int, int, bytes]]:
    """Codes of names as of ``_codes``, each after its length and before its checks."""
    names, checks = prefixes
    parts = _cut(names, owners, PREFIX_BITS)
    ends = np.cumsum([len(part) for part in parts])
    rows = []
    for i, (part, end) in enumerate(zip(parts, ends, strict=True)):
        if len(part):
            code = golomb.encode(part)
            own = checks[end - len(part) : end].astype("<u4").tobytes()
            rows.append((i, block, len(code).to_bytes(8, "little") + code + own))
    return rows


def _prefix_names(code: bytes) -> Names:
    end = 8 + int.from_bytes(code[:8], "little")
    return golomb.decode(code[8:end]), np.frombuffer(code, "<u4", offset=end)


def _marks(answer: list[dict], names: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """The bits of the owners' answers, in the order of the names."""
    bitmaps = {row["owner"]: row["bitmap"] for row in answer or []}
    found = [
        np.unpackbits(np.frombuffer(bitmaps[i], np.uint8), count=len(part)).astype(bool)
        for i, part in enumerate(_cut(names, owners, bits))
        if len(part)
    ]
    return np.concatenate(found) if found else np.zeros(0, bool)


class _Block:
    """The rows of one block: keys, texts and what came with its first row."""

    def __init__(self, number: int):
        self.number, self.docs, self.digests, self.texts = number, [], [], []
        self.answer, self.ranges = None, None

    def add(self, row: dict) -> None:
        key = (row["doc"], row["digest"])
        if self.docs and (self.docs[-1], self.digests[-1]) == key:
            return  # a repeated row
        self.docs.append(row["doc"])
        self.digests.append(row["digest"])
        self.texts.append(row["data"])
        if row.get("answer") is not None:
            self.answer = row["answer"]
        if row.get("ranges") is not None:
            self.ranges = row["ranges"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """Whole blocks: a block's rows follow one another in one file, read by one task."""
    current = None
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            for row in batch.slice(start, 1000).to_pylist():
                if current is None or row["block"] != current.number:
                    if current is not None:
                        yield current
                    current = _Block(row["block"])
                current.add(row)
    if current is not None:
        yield current


def _code_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["owner", "block", "code"])


def _tuples(block: _Block, bits: int) -> Iterator[tuple[Piece, np.ndarray, np.ndarray]]:
    """Each piece with its sampled places and their names."""
    for _, piece in pieces(block.texts):
        places = piece.sampled()
        yield piece, places, piece.names(places, TUPLE, bits)


def _sorted_names(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different names in order, and which of them came more than once."""
    names = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])
    return names[starts], np.diff(starts, append=len(names)) > 1


def _ordered(prefixes: Names, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The order of prefixes by name and check, and which but the first equal the one before.

    Equal ones keep their order in a sort of the stable kind.
    """
    names, checks = prefixes
    order = np.argsort(names, kind=kind)
    same = names[order[1:]] == names[order[:-1]]
    differ = checks[order[1:]] != checks[order[:-1]]
    if (same & differ).any():  # different strings share a name
        order = np.lexsort((checks, names))
        same = names[order[1:]] == names[order[:-1]]
        differ = checks[order[1:]] != checks[order[:-1]]
    return order, same & ~differ


def _sorted_prefixes(parts: list[Names]) -> tuple[Names, np.ndarray]:
    """Different prefixes in order, and which of them came more than once."""
    if not parts:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint32)), np.zeros(0, bool)
    names, checks = (np.concatenate(column) for column in zip(*parts, strict=True))
    order, same = _ordered((names, checks))
    starts = np.flatnonzero(np.append(True, ~same)[: len(names)])
    again = np.diff(starts, append=len(names)) > 1
    order = order[starts]
    return (names[order], checks[order]), again


def _candidates(names: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Numbers of the names that can be among others. Most are ruled out by a bit table."""
    table = np.zeros(1 << 22, bool)
    low = np.uint64((1 << 22) - 1)
    table[among & low] = True
    return np.flatnonzero(table[names & low])


def _member(names: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which names are among others, which are sorted."""
    found = np.zeros(len(names), bool)
    some = _candidates(names, among)
    if len(some):
        places = np.minimum(np.searchsorted(among, names[some]), len(among) - 1)
        found[some] = among[places] == names[some]
    return found


def _find(prefixes: Names, among: Names) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the prefixes that are among others, which are sorted, and where there."""
    (names, checks), (names_there, checks_there) = prefixes, among
    some = _candidates(names, names_there)
    there = np.searchsorted(names_there, names[some])
    numbers, places = [], []
    while len(some):  # more than once only if different strings share a name
        left = there < len(names_there)
        some, there = some[left], there[left]
        left = names_there[there] == names[some]
        some, there = some[left], there[left]
        equal = checks_there[there] == checks[some]
        numbers.append(some[equal])
        places.append(there[equal])
        some, there = some[~equal], there[~equal] + 1
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *numbers]), np.concatenate([nothing, *places])


def _send_tuples(owners: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            names, _ = _sorted_names([found for _, _, found in _tuples(block, bits)])
            yield _code_batch(_codes(block.number, names, owners, bits))

    return send


def _send_prefixes(tuple_owners: int, bits: int, owners: int):
    """Names of prefixes near repeated tuples; and where these prefixes are, which goes to the
    block's own owner with a number below zero."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            names, again = _sorted_names([found for _, _, found in _tuples(block, bits)])
            repeated = names[_marks(block.answer, names, tuple_owners, bits) | again]
            ranges, prefixes = [], []
            for piece, places, found in _tuples(block, bits):
                ranges.append(piece.before(places[_member(found, repeated)]))
                prefixes.append(piece.prefix_names(piece.within(ranges[-1])))
            sizes = np.array([len(r) for r in ranges], np.int64)
            where = np.concatenate([[len(sizes)], sizes, *[r.ravel() for r in ranges]])
            prefixes, _ = _sorted_prefixes(prefixes)
            rows = _prefix_codes(block.number, prefixes, owners)
            kept = (-1 - block.number, block.number, where.astype("<i8").tobytes())
            yield _code_batch([*rows, kept])

    return send


def _ranges(code: bytes) -> list[np.ndarray]:
    numbers = np.frombuffer(code, "<i8")
    sizes = numbers[1 : 1 + numbers[0]]
    rows = numbers[1 + numbers[0] :].reshape(-1, 2)
    return np.split(rows, np.cumsum(sizes)[:-1])


def _others(key: tuple, codes: pd.DataFrame) -> pd.DataFrame:
    """For each block a bitmap: which of its names another block has."""
    lists = [golomb.decode(code) for code in codes["code"]]
    merged = np.sort(np.concatenate(lists))
    shared = np.unique(merged[1:][merged[1:] == merged[:-1]])
    return _answers(key[0], codes["block"], [_member(names, shared) for names in lists])


def _earlier(key: tuple, codes: pd.DataFrame) -> pd.DataFrame:
    """For each block a bitmap: which of its names an earlier block has. What is for a block
    itself is passed on."""
    if key[0] < 0:
        return codes.rename(columns={"code": "bitmap"})[["owner", "block", "bitmap"]]
    codes = codes.sort_values("block")
    lists = [_prefix_names(code) for code in codes["code"]]
    # equal prefixes stay in order of their blocks
    merged = tuple(np.concatenate(column) for column in zip(*lists, strict=True))
    order, same = _ordered(merged, "stable")
    again = np.zeros(len(order), bool)
    again[order[1:]] = same
    cuts = np.cumsum([len(names) for names, _ in lists])[:-1]
    return _answers(key[0], codes["block"], np.split(again, cuts))


def _answers(owner: int, blocks: pd.Series, marks: list[np.ndarray]) -> pd.DataFrame:
    bitmaps = [np.packbits(mark).tobytes() for mark in marks]
    return pd.DataFrame({"owner": owner, "block": blocks.to_numpy(), "bitmap": bitmaps})


def covered(places: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (text, begin, end) of the maximal runs covered by prefixes at ascending places."""
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] > places[:-1] + LENGTH) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(places)) - 1 if len(places) else starts
    return np.column_stack([text[starts], places[starts], places[stops] + LENGTH])


def _prefixes(
    block: _Block, ranges: list[np.ndarray]
) -> Iterator[tuple[int, Piece, np.ndarray, Names]]:
    """Each piece with the number of its first text, its places and their names."""
    for (first, piece), own in zip(pieces(block.texts), ranges, strict=True):
        places = piece.within(own)
        yield first, piece, places, piece.prefix_names(places)


def _smallest(block: _Block, ranges: list[np.ndarray], prefixes: Names) -> np.ndarray:
    """The smallest doc_id of the block that has each of some prefixes, which are sorted."""
    smallest = np.full(len(prefixes[0]), np.iinfo(np.int64).max)
    docs = np.array(block.docs, np.int64)
    for first, piece, places, found in _prefixes(block, ranges):
        some, there = _find(found, prefixes)
        owners = docs[piece.text_at(places[some]) + first]
        np.minimum.at(smallest, there, owners)
    return smallest


def _block_runs(block: _Block, owners: int) -> list[list[tuple[int, int]]]:
    """Removed runs of each text of a block, from its ranges and the owners' answer."""
    runs: list[list[tuple[int, int]]] = [[] for _ in block.texts]
    ranges = _ranges(block.ranges) if block.ranges is not None else []
    if not sum(map(len, ranges)):
        return runs
    (names, checks), again = _sorted_prefixes([found for *_, found in _prefixes(block, ranges)])
    marks = _marks(block.answer, names, owners, PREFIX_BITS)
    # only prefixes that come more than once can be in a smaller doc_id of the block itself
    again &= ~marks
    elsewhere, within = (names[marks], checks[marks]), (names[again], checks[again])
    del names, checks, marks, again
    smallest = _smallest(block, ranges, within) if len(within[0]) else None
    docs = np.array(block.docs, np.int64)
    for first, piece, places, found in _prefixes(block, ranges):
        removed = np.zeros(len(places), bool)
        removed[_find(found, elsewhere)[0]] = True
        if smallest is not None:
            some, there = _find(found, within)
            own = docs[piece.text_at(places[some]) + first]
            removed[some] = own > smallest[there]
        places = places[removed]
        for text, begin, end in covered(places, piece.text_at(places)).tolist():
            start = int(piece.begins[text])
            runs[text + first].append((begin - start, end - start))
    return runs


def _without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, place = [], 0
    for begin, end in runs:
        parts.append(data[place:begin])
        place = end
    return b"".join([*parts, data[place:]])


def _cut_texts(owners: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "digest", "n_removed", "n_spans", "kept_sha256", "runs"]
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), span]
        for block in _blocks(batches):
            rows = []
            found = _block_runs(block, owners)
            for doc, digest, data, runs in zip(block.docs, block.digests, block.texts, found, strict=True):
                kept = hashlib.sha256(_without(data, runs)).hexdigest() if runs else digest
                size = sum(end - begin for begin, end in runs)
                spans = [{"begin": begin, "end": end} for begin, end in runs]
                rows.append((doc, digest, size, len(runs), kept, spans))
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def _with_answers(blocks: DataFrame, answers: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Blocks, with the answers and ranges of a block beside its first row."""
    per_block = answers.groupBy("block").agg(
        F.collect_list(F.struct("owner", "bitmap")).alias("answer")
    )
    if ranges is not None:
        per_block = ranges.join(per_block, "block", "left")
    size = answers.agg(F.sum(F.octet_length("bitmap"))).first()[0] or 0
    if ranges is not None:
        size += ranges.agg(F.sum(F.octet_length("ranges"))).first()[0] or 0
    per_block = per_block.withColumn("row", F.lit(0))
    if size <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(per_block), ["block", "row"], "left")
    joined = blocks.join(per_block, ["block", "row"], "left")
    return joined.repartition("block").sortWithinPartitions("block", "doc", "digest")


def removed_runs(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Light rows of all documents (doc_id, doc, digest, n_bytes, first), and per different
    text (doc, digest) its n_removed, n_spans, kept_sha256 and runs."""
    spark = docs.sparkSession
    ship(spark)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), data.alias("data")
    ).withColumn("digest", F.sha2("data", 256))
    light = stored(
        keyed.select("doc_id", "doc", "digest", F.octet_length("data").cast("long").alias("n_bytes")),
        "light",
        folder,
    )
    firsts = stored(light.groupBy("digest").agg(F.min("doc").alias("first")), "firsts", folder)
    unique = keyed.where(F.octet_length("data") >= LENGTH).join(
        small(firsts), (keyed["digest"] == firsts["digest"]) & (keyed["doc"] == firsts["first"]), "left_semi"
    )
    # all rows of a doc_id are in one block, and blocks are in the order of doc_id
    total = light.agg(F.sum("n_bytes")).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    ordered = unique.repartitionByRange(count, "doc").sortWithinPartitions("doc", "digest")
    numbered = ordered.select(
        F.spark_partition_id().alias("block"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"),
        "doc",
        "digest",
        "data",
    )
    path = f"{folder}/blocks"
    # one row group per file: a file is read by one task, however its bytes are split
    writer = numbered.write.option("parquet.block.size", 1 << 30).option("compression", "zstd")
    writer.parquet(path)
    blocks = spark.read.schema(numbered.schema).parquet(path)

    samples = max(1, total * len(COVER) // MODULUS)
    bits = min(PREFIX_BITS, samples.bit_length() + SPARE_BITS)
    tuple_owners = max(1, -(-samples // OWNER_NAMES))
    owners = max(1, -(-total // 4 // OWNER_NAMES))
    tuples = blocks.mapInArrow(_send_tuples(tuple_owners, bits), _CODES)
    others = tuples.groupBy("owner").applyInPandas(_others, "owner int, block int, bitmap binary")
    others = stored(others, "others", folder)
    send = _send_prefixes(tuple_owners, bits, owners)
    prefixes = _with_answers(blocks, others).mapInArrow(send, _CODES)
    earlier = prefixes.groupBy("owner").applyInPandas(
        _earlier, "owner int, block int, bitmap binary"
    )
    earlier = stored(earlier, "earlier", folder)
    ranges = earlier.where("owner < 0").select("block", F.col("bitmap").alias("ranges"))
    results = _with_answers(blocks, earlier.where("owner >= 0"), ranges).mapInArrow(
        _cut_texts(owners),
        "doc long, digest string, n_removed long, n_spans long, kept_sha256 string,"
        " runs array<struct<begin: long, end: long>>",
    )
    return light.join(small(firsts), "digest"), stored(results, "results", folder)


_NOTHING = hashlib.sha256(b"").hexdigest()


def deduplicated_bytes(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs.

    A byte is removed if a 50-byte string that covers it also starts in a document with a
    smaller doc_id. A null text is an empty one; texts under 50 bytes stay. A null doc_id is
    smaller than all others. Documents with the same doc_id take nothing from one another, so
    repeated rows get the same result. An empty table gives no rows. ``runs`` are the removed
    bytes' begins and ends in the whole text. Other columns are not read.
    """
    light, results = removed_runs(docs, folder or new_folder(docs.sparkSession))
    long = F.col("n_bytes") >= LENGTH
    copy = long & (F.col("doc") > F.col("first"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    joined = light.join(results, ["doc", "digest"], "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("runs", none)).alias("runs"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_bytes(read_documents(spark, sf_dir)).drop("runs")


OP2_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS g
  FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS p FROM d)),
f AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g),
r AS (SELECT doc_id, p FROM w JOIN f USING (g) WHERE doc_id > first),
o AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens
  FROM r),
n AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o),
runs AS (SELECT doc_id, run, min(p) AS b, max(p) + 50 AS e FROM n GROUP BY ALL),
parts AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS s, b AS t FROM runs
  UNION ALL SELECT doc_id, max(e), NULL FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id,
         string_agg(substr(h, 2 * s + 1, 2 * (coalesce(t, length(h) // 2) - s)), '' ORDER BY s) AS h
  FROM parts JOIN d USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(e - b) AS n, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
