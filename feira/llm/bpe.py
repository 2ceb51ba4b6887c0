"""Byte-level BPE, encoding and decoding.

Encoding walks a piece of text once. At each place the longest token that begins there is
taken (found for all places by one Aho-Corasick pass over the reversed piece), if it may stand
after the token before it; else the next shorter one; else the walk goes back one token and
never comes to this place again. Two tokens may stand side by side if no merge across their
border would have come before the merges inside them: that table is worked out from the merges
and remembered. The result is what merging in rank order gives, in linear time. Decoding
copies from one table of all tokens' bytes by offset.

Words repeat, so results are remembered per word, in tables of bounded size.
"""

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import read_documents, ship, sliced, texts

VOCABULARY = "byte_bpe_50k.json"

# Fixed value: how byte-level vocabularies of this kind cut text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SIGNS = frozenset(".,;:!?")

# Remembered results per generation (there are two), none of a word with more characters than
# LONGEST_KEPT; ids handled at once when decoding.
WORDS_KEPT = 150_000
LONGEST_KEPT = 64
IDS_AT_ONCE = 1 << 17


class Remembered(dict):
    """Results of a function, kept while they are used: at most two generations of ``size``."""

    def __init__(self, make: Callable, size: int = WORDS_KEPT):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if not isinstance(key, str | bytes) or len(key) <= LONGEST_KEPT:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


def _ranges(numbers: np.ndarray) -> str:
    """A set of code points as the inside of a character class."""
    ends = np.flatnonzero(np.diff(numbers) != 1)
    starts = numbers[np.concatenate([[0], ends + 1])]
    stops = numbers[np.concatenate([ends, [len(numbers) - 1]])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts.tolist(), stops.tolist(), strict=True))


@cache
def character_classes() -> tuple[str, str, str]:
    """Letters, numbers and white space, as the tokenizers library has them.

    Which characters these are depends on the version of Unicode that a program was built with.
    So the library's own cutter is asked: a character behind a letter, a digit or a sign is in
    one piece with it if it is of the same kind. White space is what goes with none of them.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    cutter = ByteLevel(add_prefix_space=False, use_regex=True)
    found: dict[str, list[int]] = {"a": [], "1": [], "!": [], "": []}
    # ranges are halved until all of a range goes with one sign, in one piece
    pending = [(i, i + 2048) for i in range(0, 0x110000, 2048) if not 0xD800 <= i < 0xE000]
    while pending:
        begin, end = pending.pop()
        together = "".join(map(chr, range(begin, end)))
        kind = next((sign for sign in "a1!" if len(cutter.pre_tokenize_str(sign + together)) == 1), "")
        if kind or end - begin == 1:
            found[kind] += range(begin, end)
        else:
            middle = (begin + end) // 2
            pending += [(begin, middle), (middle, end)]
    letter, number, white = (_ranges(np.array(sorted(found[kind]))) for kind in ("a", "1", ""))
    return letter, number, white


class Table:
    """Byte strings by number, in one array with offsets."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(entry) for entry in entries], np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        """The entries of ``numbers``, one after the other."""
        parts = []
        for i in range(0, len(numbers), IDS_AT_ONCE):
            part = numbers[i : i + IDS_AT_ONCE]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes, dtype=np.int64)
            if not len(ends) or not ends[-1]:
                continue
            places = np.arange(ends[-1]) + np.repeat(self.starts[part] - ends + sizes, sizes)
            parts.append(self.data[places].tobytes())
        return b"".join(parts)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if it can be printed,
    else the next unused one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(byte): byte for byte in printed}
    for i, byte in enumerate(b for b in range(256) if b not in set(printed)):
        letters[chr(256 + i)] = byte
    return letters


class Bpe:
    """A vocabulary. Only its tokens and merges travel; tables are made where it is used."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        self.tokens, self.merges, self.special = tokens, merges, special
        self.classes = character_classes()
        self._made = False

    @classmethod
    def from_file(cls, path: str) -> "Bpe":
        """Read a file of the tokenizers library: byte-level BPE without normaliser or options."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, cutter = content["model"], content["pre_tokenizer"]
        plain = not any(
            model.get(option)
            for option in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        byte_level = cutter["type"] == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
        if not (plain and byte_level and model["type"] == "BPE" and content["normalizer"] is None):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        letters, ids = _byte_letters(), model["vocab"]
        tokens = {i: bytes(letters[letter] for letter in token) for token, i in ids.items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        merges = [(ids[left], ids[right], ids[left + right]) for left, right in pairs]
        special = {added["content"]: added["id"] for added in content["added_tokens"]}
        return cls(tokens | {i: text.encode() for text, i in special.items()}, merges, special)

    def __getstate__(self):
        kept = ("tokens", "merges", "special", "classes")
        return {name: getattr(self, name) for name in kept} | {"_made": False}

    def made(self) -> "Bpe":
        """This vocabulary with its tables."""
        if self._made:
            return self
        size = max(self.tokens) + 1
        special = set(self.special.values())
        plain = {data: i for i, data in self.tokens.items() if i not in special}
        self.sizes = [len(self.tokens.get(i, b"")) for i in range(size)]
        self.rank, self.parts = [-1] * size, [(0, 0)] * size
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        for rank, (left, right, whole) in enumerate(self.merges):
            self.rank_of_pair.setdefault((left, right), rank)
            if self.rank[whole] < 0:
                self.rank[whole], self.parts[whole] = rank, (left, right)
        self.shorter = [-1] * size
        self.backward = ahocorasick.Automaton()
        for data, i in plain.items():
            self.backward.add_word(data[::-1].decode("latin-1"), i)
            self.shorter[i] = next(
                (plain[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in plain), -1
            )
        self.backward.make_automaton()
        self.by_id = Table([self.tokens.get(i, b"") for i in range(size)])
        self.decimals = Table([b"%d," % i for i in range(size)])
        letter, number, white = self.classes
        spelled = {r"[^\s\p{L}\p{N}]": f"[^{white}{letter}{number}]", r"\p{L}": f"[{letter}]"}
        spelled |= {r"\p{N}": f"[{number}]", r"\S": f"[^{white}]", r"\s": f"[{white}]"}
        pieces = PIECES
        for short, long in spelled.items():
            pieces = pieces.replace(short, long)
        self.pattern = re.compile(pieces)
        self.letters = re.compile(f"[{letter}]+")
        # a cut before a space that follows anything but white space never goes through a piece
        self.cut = re.compile(f"(?<=[^{white}])(?= )")
        self.space_after_white = re.compile(f"[{white}] ")
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.compatible = Remembered(self._compatible)
        self.piece = Remembered(self._piece)
        self.after_space = Remembered(self._after_space)
        self._made = True
        return self

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging leaves a border between these two tokens.

        Their merges are undone from the last to the first. A merge across the border that
        would have come before the one undone, or, if that lies to its right, at the same
        rank, would have joined them.
        """
        left, right = pair
        limit = len(self.merges)
        while True:
            if self.rank_of_pair.get((left, right), limit) < limit:
                return False
            if self.rank[left] > self.rank[right]:
                limit = self.rank[left]
                left = self.parts[left][1]
            elif self.rank[right] >= 0:
                limit = self.rank[right] + 1
                right = self.parts[right][0]
            else:
                return True

    def _piece(self, piece: bytes) -> list[int]:
        size, sizes, compatible = len(piece), self.sizes, self.compatible
        longest = [-1] * size
        for end, token in self.backward.iter(piece[::-1].decode("latin-1")):
            start = size - 1 - end  # of all tokens from here the longest comes first
            if longest[start] < 0:
                longest[start] = token
        found: list[int] = []
        reachable = bytearray(b"\1") * (size + 1)
        place, token = 0, longest[0]
        while place < size:
            end = place + sizes[token]
            if reachable[end] and (not found or compatible[found[-1], token]):
                found.append(token)
                place = end
                token = longest[place] if place < size else -1
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                reachable[place] = 0
                token = found.pop()
                place -= sizes[token]
        return found

    def _ids(self, piece: str) -> list[int]:
        data = piece.encode()
        return self.piece[data] if len(data) <= 64 else self._piece(data)

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(chunk):
            ids += self._ids(piece)
        return array("I", ids).tobytes()

    def _after_space(self, word: str) -> bytes:
        """Ids of a space and ``word``. Letters, and letters with one sign, need no pattern."""
        letters = self.letters.match(word)
        end = letters.end() if letters else 0
        if end and end == len(word):
            return array("I", self._ids(" " + word)).tobytes()
        if end and end == len(word) - 1 and word[-1] in _SIGNS:
            return array("I", self._ids(" " + word[:-1]) + self._ids(word[-1])).tobytes()
        return self._chunk(" " + word)

    def _plain(self, text: str) -> list[bytes]:
        """Ids of a text without special tokens, as bytes, in parts."""
        if self.space_after_white.search(text):
            return [self._chunk(chunk) for chunk in self.cut.split(text)]
        first, *rest = text.split(" ")
        return [self._chunk(first), *map(self.after_space.__getitem__, rest)]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as numbers of 32 bits."""
        parts, begin = [], 0
        for mark in self.marks.finditer(text) if self.marks else ():
            parts += self._plain(text[begin : mark.start()])
            parts.append(array("I", [self.special[mark[0]]]).tobytes())
            begin = mark.end()
        parts += self._plain(text[begin:])
        return np.frombuffer(b"".join(parts), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.by_id.joined(ids).decode("utf-8", errors="replace")

    def listed(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers with commas between."""
        return self.decimals.joined(ids)[:-1]


def _vocabulary(spark: SparkSession, path: str):
    """The vocabulary, sent to every executor once: its size is that of the file, some MB."""
    ship(spark)
    return spark.sparkContext.broadcast(Bpe.from_file(path))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every document; a null text has no ids."""
    vocabulary = _vocabulary(docs.sparkSession, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.value.made()
        for batch in sliced(batches):
            ids = [bpe.encode(text).astype(np.int32) for text in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return light.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of what ``encode_documents`` returned; null ids give an empty text."""
    vocabulary = _vocabulary(encoded.sparkSession, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.value.made()
        for batch in batches:
            found = [bpe.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for.

    Each text is encoded whole and decoded from its ids in the same task, so ids do not leave
    it. A null text is an empty one: no tokens, digests of nothing. Repeated rows give repeated
    rows, a null doc_id stays null, an empty table gives none. Other columns are not read.
    """
    vocabulary = _vocabulary(docs.sparkSession, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.value.made()
        for batch in sliced(batches):
            rows = []
            for text in texts(batch["text"]):
                ids = bpe.encode(text)
                decoded = bpe.decode(ids).encode()
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(bpe.listed(ids)).hexdigest(),
                        hashlib.sha256(decoded).hexdigest(),
                        ids.astype(np.int32) if with_ids else None,
                    )
                )
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())][: len(names) - 1]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""
    names = [field.split()[0] for field in schema.split(", ")]
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return light.mapInArrow(digest, schema)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
