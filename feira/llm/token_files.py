"""Token ids as files: documents in ascending order, coded in segments of checked blocks.

Documents are dealt by ranges of doc_id and sorted, so the files in order of their part
number, and the segments in them, hold all ids in ascending order of doc_id. A segment row has
its documents' doc_ids and numbers of ids beside the coded ids, and is read alone. Where a
document's ids begin among all ids follows from the segments' sizes, which are a light table.
"""

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feira.llm import bpe, idcoder
from feira.llm.common import read_documents, ship, sliced, small
from feira.sources.working import new_folder

END_ID = 2
# A segment is closed when it has so many ids; one document is never cut.
SEGMENT_IDS = 8192 * idcoder.BLOCK_IDS
# Longer texts go to the tokenizers library itself: the faster one is built for shorter runs.
LONG_TEXT = 1 << 20
# Words that a process remembers with their ids, and their bytes; words laid out at once.
WORDS_KEPT, WORD_BYTES_KEPT = 1 << 19, 1 << 24
WORDS_AT_ONCE = 1 << 14
# White space, as all versions of Unicode since 6.3 have it.
_WHITE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# bpe.PIECES for an encoder whose pattern may forbid going back: the same pieces, found sooner.
_PIECES = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
)

_FILE = (
    "part int, segment int, n_ids long, doc_ids array<long>, sizes array<long>, ids binary"
)


class Encoder:
    """Ids as the tokenizers library gives them for a byte-level BPE vocabulary.

    The same tokens and pattern are handed to a faster public encoder; texts that are very
    long are encoded by the tokenizers library.

    No piece goes through the border before a space that follows anything but white space. So
    texts are cut there, and of all words of a batch behind a space each different one is encoded
    once. Texts with white space before a space or at their end are encoded one by one.

    Only the vocabulary travels; a process makes tables when it needs them, and once.
    """

    def __init__(self, vocabulary: bpe.Bpe, file: str):
        self.tokens, self.special, self.file = vocabulary.tokens, vocabulary.special, file
        self.by_words = not any(" " in mark for mark in self.special)
        self.known: tuple[pa.Array, np.ndarray, np.ndarray] | None = None

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        ranks = {data: i for i, data in self.tokens.items() if i not in self.special.values()}
        return tiktoken.Encoding(
            "own", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens=self.special
        )

    @cached_property
    def exact(self) -> Tokenizer:
        return Tokenizer.from_str(self.file)

    @cached_property
    def spaced(self) -> np.ndarray:
        """Whether an id's token begins with a space."""
        found = np.zeros(max(self.tokens) + 1, bool)
        found[[i for i, data in self.tokens.items() if data[:1] == b" "]] = True
        return found

    def encode(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")

    def encode_all(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column, null as the empty string."""
        filled = pc.fill_null(column, "")
        cut = pc.invert(pc.match_substring_regex(filled, f"[{_WHITE}](?: |$)"))
        cut = pc.and_(cut, pc.less_equal(pc.utf8_length(filled), LONG_TEXT))
        by_words = iter(self._by_words(filled.filter(cut)) if self.by_words else ())
        for text, whole in zip(filled, cut.to_pylist(), strict=True):
            yield next(by_words) if whole and self.by_words else self.encode(text.as_py())

    def _by_words(self, column: pa.Array) -> list[np.ndarray]:
        if not len(column):
            return []
        lists = pc.split_pattern(column, " ")
        words, begins = lists.flatten(), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        behind = np.ones(len(words), bool)
        behind[begins] = False
        different = words.filter(pa.array(behind)).dictionary_encode()
        table, sizes = self._words(different.dictionary)
        # the first words, which no space comes before, stand behind the others
        firsts = [self.encode(word) for word in words.take(pa.array(begins)).to_pylist()]
        numbers = np.empty(len(words), np.int32)
        numbers[behind] = different.indices.to_numpy()
        numbers[begins] = np.arange(len(sizes), len(sizes) + len(firsts))
        table = np.concatenate([table, *firsts])
        sizes = np.concatenate([sizes, [len(first) for first in firsts]]).astype(np.int32)
        ids = _joined(table, sizes, numbers)
        ends = np.cumsum(np.add.reduceat(sizes.take(numbers), begins, dtype=np.int64))
        return np.split(ids, ends[:-1])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, each with a space before it, and how many ids each has.

        Words of the batches before are remembered.
        """
        known, table, sizes = self.known or (words.slice(0, 0), np.zeros(0, np.uint32), np.zeros(0, np.int32))
        numbers = pc.index_in(words, value_set=known)
        new = words.filter(numbers.is_null())
        if len(new):
            found = self._new_words(new)
            numbers = pc.coalesce(numbers, pc.add(len(known), pc.index_in(words, value_set=new)))
            known = pa.concat_arrays([known, new])
            table, sizes = np.concatenate([table, found[0]]), np.concatenate([sizes, found[1]])
        numbers = numbers.to_numpy()
        ids, lengths = _joined(table, sizes, numbers), sizes.take(numbers)
        # if all are too many, those of this batch stay, the frequent ones among them
        both = ((known, table, sizes), (words, ids, lengths))
        self.known = next(
            (kept for kept in both if len(kept[0]) <= WORDS_KEPT and kept[0].nbytes <= WORD_BYTES_KEPT), None
        )
        return ids, lengths

    def _new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        ids = self.fast.encode_to_numpy(" " + joined, allowed_special="all")
        # words hold no space, so their ids begin where a token begins with one
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(words):
            raise ValueError("the ids of words do not begin where the words do")
        return ids, np.diff(starts, append=len(ids)).astype(np.int32)


def _joined(table: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Of the entries that stand in ``table`` one after the other, those with these numbers."""
    starts, parts = np.cumsum(sizes, dtype=np.int32) - sizes, [table[:0]]
    for i in range(0, len(numbers), WORDS_AT_ONCE):
        some = numbers[i : i + WORDS_AT_ONCE]
        lengths = sizes.take(some)
        ends = np.cumsum(lengths)
        places = np.repeat(starts.take(some) - (ends - lengths), lengths)
        places += np.arange(len(places))
        parts.append(table.take(places))
    return np.concatenate(parts)


def _segments(vocabulary):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = vocabulary.value, None, 0
        doc_ids, sizes, parts, waiting = [], [], [], 0
        end = np.array([END_ID], np.uint32)

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts).astype(np.int64)
            columns = [[part], [number], [len(ids)], [list(doc_ids)], [list(sizes)], [idcoder.encode(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                ["part", "segment", "n_ids", "doc_ids", "sizes", "ids"],
            )

        for batch in sliced(batches):
            part = batch["part"][0].as_py()
            encoded = encoder.encode_all(batch["text"])
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                sizes.append(len(ids) + 1)
                parts += [ids, end]
                waiting += len(ids) + 1
                if waiting >= SEGMENT_IDS:
                    yield close()
                    number += 1
                    doc_ids, sizes, parts, waiting = [], [], [], 0
        if parts:
            yield close()

    return segments


def write_token_files(docs: DataFrame, vocabulary_path: str, path: str) -> None:
    """Write the ids of all documents, each closed by ``END_ID``, into the folder ``path``.

    Documents that repeat a doc_id come in the order of their texts' hashes, null doc_ids
    first. A null text is an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        content = file.read()  # some MB, as every vocabulary
    vocabulary = spark.sparkContext.broadcast(Encoder(bpe.Bpe.from_file(vocabulary_path), content))
    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text"
    )
    ordered = light.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    numbered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    numbered.mapInArrow(_segments(vocabulary), _FILE).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = idcoder.decode(batch["ids"][row].as_py()).astype("<u4")
            sizes = batch["sizes"][row].values.to_numpy()
            ends = np.cumsum(sizes)
            if ends[-1] != len(ids):
                raise ValueError("a segment has other ids than its documents")
            begins = ends - sizes
            crcs = [
                zlib.crc32(ids[i:j]) for i, j in zip(begins.tolist(), ends.tolist(), strict=True)
            ]
            count = len(sizes)
            columns = [
                pa.repeat(batch["part"][row], count),
                pa.repeat(batch["segment"][row], count),
                batch["doc_ids"][row].values,
                pa.array(begins, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(crcs, pa.int64()),
            ]
            names = ["part", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, from the files in ``path``."""
    files = spark.read.schema(_FILE).parquet(path)
    rows = files.select("part", "segment", "doc_ids", "sizes", "ids").mapInArrow(
        _documents,
        "part int, segment int, doc_id long, inner long, n_tokens long, ids_crc32 long",
    )
    index = files.select("part", "segment", "n_ids")
    earlier_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(earlier_parts), F.lit(0)).alias("part_start")
    )
    earlier = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.join(parts, "part").select(
        "part",
        "segment",
        (F.col("part_start") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("begin"),
    )
    return rows.join(small(starts), ["part", "segment"]).select(
        "doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def stored_ids(docs: DataFrame, vocabulary_path: str, folder: str | None = None) -> DataFrame:
    """Write token files and read them back: doc_id, start, n_tokens, ids_crc32 per document.

    Each document has at least its end id, so a null or empty text has one id. An empty table
    gives no files' rows and no rows. Other columns are not read.
    """
    path = f"{folder or new_folder(docs.sparkSession)}/ids"
    write_token_files(docs, vocabulary_path, path)
    return read_token_files(docs.sparkSession, path)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_ids(read_documents(spark, sf_dir), public_tokenizers.path(bpe.VOCABULARY))
