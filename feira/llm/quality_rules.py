"""Quality rules: counts per document, and its distance from what its language looks like.

A language's reference is made from all its documents that are not very short: a histogram of
character classes, each the median of its share in a document, and one of its most common short
words, summed. So neither long documents nor many unusual ones, up to nearly half of all, move
the classes far. A document that is long enough
to be judged is rejected if the Jensen-Shannon distance between its histogram and the
reference is above a threshold. Texts are read twice: once for the references, of which each
task sends sums, and once to measure and judge each document.
"""

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.common import byte_texts, read_documents, ship, sliced, small, stored
from feira.sources.working import new_folder

# Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# Divergence rules: a distance above the threshold rejects, if there is enough text to judge.
MAX_CLASS_DISTANCE, CLASS_CHANCE, MIN_CLASS_CHARS = 0.12, 0.9, 200
MAX_WORD_DISTANCE, WORD_CHANCE, MIN_WORD_COUNT = 0.18, 1.5, 50
# Shares of character classes are counted in parts of so many, so that few different ones occur.
SHARES = 1 << 14
COMMON_WORDS = 32
# Words that can be common ones: without outer punctuation, of so many characters at most.
SHORT_WORD = 6

# A word can have so many bytes at most, without outer punctuation, to be looked at.
_SHORT_BYTES = 4 * SHORT_WORD

WHITE = " \t\n\r\x0b\x0c"
OUTER = ".,;:!?()\"'"
_OUTER_BYTES = OUTER.encode()
CLASSES = ["lower", "upper", "digit", "space", "sentence", "symbol", "other"]

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_VERDICT = "base_failed boolean, kept boolean, class_distance double, word_distance double"


@cache
def _class_table() -> np.ndarray:
    """Class number of every code point, by its Unicode category."""
    by_category = {"Lu": 1, "Lt": 1, "Nd": 2, "Nl": 2, "No": 2, "Zs": 3, "Zl": 3, "Zp": 3}
    by_category |= {"Sm": 5, "Sc": 5, "Sk": 5, "So": 5, "Cc": 6, "Cf": 6, "Co": 6, "Cn": 6}
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        table[point] = by_category.get(category, 4 if category[0] == "P" else 0)
    for sign in SYMBOLS + "@_\\/[]{}":
        table[ord(sign)] = 5
    for sign in WHITE:
        table[ord(sign)] = 3
    return table


def _is_word(plain: str) -> bool:
    """Whether there are only letters and their marks, such as the vowel signs of Hindi."""
    if plain.isalpha():
        return True
    letters = [char for char in plain if unicodedata.category(char)[0] != "M"]
    return bool(letters) and "".join(letters).isalpha()


class _Plain(dict):
    """Word in bytes to its form among common words, "" if it cannot be one; bounded."""

    def __missing__(self, word: bytes) -> str:
        plain = word.decode().lower().strip(OUTER)
        found = plain if len(plain) <= SHORT_WORD and _is_word(plain) else ""
        if len(self) > 300_000:
            self.clear()
        self[word] = found
        return found


def short_words(words: list[bytes], plain: dict[bytes, str]) -> dict[str, int]:
    """How often each form that can be a common word occurs."""
    found: dict[str, int] = {}
    counted = Counter(
        [w for w in words if len(w) <= _SHORT_BYTES or len(w.strip(_OUTER_BYTES)) <= _SHORT_BYTES]
    )
    for form, n in zip(map(plain.__getitem__, counted), counted.values(), strict=True):
        if form:
            found[form] = found.get(form, 0) + n
    return found


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(_class_table()[points], minlength=len(CLASSES))


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """How many words lie in a window of three words that occurs twice or more."""
    if len(ids) < 3:
        return 0
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds > 1 << 20:  # three ids no longer fit one number
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, window, counts = np.unique(
        pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[window] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(again) + shift] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, ...]:
    """The counts of ``_COUNTS``."""
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids, max(1, len(number))),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def diverges(n_words: int, word_chars: int, class_distance: float, word_distance: float) -> bool:
    """Whether a distance is above its threshold, for a document with enough text to judge.

    Short texts lie further from any reference by chance, in proportion to the root of their
    number of words, so a threshold has a part that shrinks with it.
    """
    chance = max(1, n_words) ** -0.5
    by_class = class_distance > MAX_CLASS_DISTANCE + CLASS_CHANCE * chance
    by_word = word_distance > MAX_WORD_DISTANCE + WORD_CHANCE * chance
    return (word_chars >= MIN_CLASS_CHARS and by_class) or (n_words >= MIN_WORD_COUNT and by_word)


def js_distance(left: np.ndarray, right: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence, base 2) of two arrays of counts or shares.

    0 if either has no counts: nothing is known, nothing is held against it.
    """
    if not left.sum() or not right.sum():
        return 0.0
    p, q = left / left.sum(), right / right.sum()
    mean = (p + q) / 2
    ratios = np.log2(np.where(p > 0, p, 1) / np.where(p > 0, mean, 1))
    others = np.log2(np.where(q > 0, q, 1) / np.where(q > 0, mean, 1))
    return float(np.sqrt(max(0.0, (p @ ratios + q @ others) / 2)))


def word_vector(found: list[int], all_words: int) -> np.ndarray:
    """Counts of the common words, and one entry for all other words."""
    return np.array([*found, max(0, all_words - sum(found))], float)


def _reference_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of class counts per document, and sums of short words per language and task."""
    plain, sums = _Plain(), {}
    names = ["lang", "n_words", "classes", "word", "n"]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.int64()]

    def rows(values: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([v[i] for v in values], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    def summed() -> pa.RecordBatch:
        entries = [(lang, None, None, word, n) for (lang, word), n in sums.items()]
        sums.clear()
        return rows(entries)

    for batch in sliced(batches):
        found = []
        for lang, data in zip(batch["lang"].to_pylist(), byte_texts(batch["text"]), strict=True):
            words = data.split()
            if len(words) < MIN_WORDS:
                continue
            found.append((lang, len(words), class_counts(data.decode()).tolist(), None, None))
            for word, n in short_words(words, plain).items():
                sums[lang, word] = sums.get((lang, word), 0) + n
        yield rows(found)
        if len(sums) > 200_000:
            yield summed()
    yield summed()


def _usual_classes(rows: DataFrame) -> DataFrame:
    """Per language the medians of the classes' shares in a document, each document counted once.

    Where no document is usual, the medians of different classes come from different documents
    and make up less than half a text together; there it is the sums of the shares. Shares are
    whole numbers, so neither depends on the order of rows.
    """
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    numbers = range(len(CLASSES))
    shares = [F.floor(F.col("classes")[i] * SHARES / total).alias(f"share_{i}") for i in numbers]
    medians = F.array(*[F.percentile(f"share_{i}", 0.5) for i in numbers])
    sums = F.array(*[F.sum(f"share_{i}").cast("double") for i in numbers])
    found = rows.select("lang", *shares).groupBy("lang").agg(medians.alias("medians"), sums.alias("sums"))
    covered = F.aggregate("medians", F.lit(0.0), lambda a, b: a + b)
    usual = F.when(covered * 2 >= SHARES, F.col("medians")).otherwise(F.col("sums"))
    return found.select("lang", usual.alias("ref_classes"))


def references(docs: DataFrame, folder: str) -> DataFrame:
    """Per language: usual character classes, number of words, common words and their counts.

    Of words that are equally common the one that sorts first counts.
    """
    ship(docs.sparkSession)
    light = docs.select(_language().alias("lang"), "text")
    counts = light.mapInArrow(
        _reference_batches, "lang string, n_words long, classes array<long>, word string, n long"
    )
    counts = stored(counts, "counts", folder)
    by_document, by_word = counts.where("word is null"), counts.where("word is not null")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        by_word.groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= COMMON_WORDS)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
        .select("lang", F.col("top.word").alias("ref_top"), F.col("top.n").alias("ref_counts"))
    )
    words = by_document.groupBy("lang").agg(F.sum("n_words").alias("ref_words"))
    joined = words.join(top, "lang", "left").join(_usual_classes(by_document), "lang", "left")
    return stored(joined, "references", folder)


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


# What the columns of a reference are called beside columns of any name.
_REFERENCE = "_feira_ref_"


class _Judge:
    """Measures texts and compares them with their language's reference."""

    def __init__(self):
        self.plain = _Plain()

    def verdict(self, data: bytes, reference: tuple) -> tuple:
        text, words = data.decode(), data.split()
        usual, top, expected = reference
        counts = base_counts(text, words)
        own = short_words(words, self.plain)
        found = word_vector([own.get(word, 0) for word in top], len(words))
        by_class = js_distance(class_counts(text).astype(float), usual)
        by_word = js_distance(found, expected)
        failed = base_failed(counts[0], counts[4])
        kept = not failed and not diverges(counts[0], counts[1], by_class, by_word)
        return (*counts, failed, kept, by_class, by_word)

    def verdicts(self, batch: pa.RecordBatch) -> list[tuple]:
        languages = batch["_feira_lang"].to_pylist()
        known = {}
        for i, lang in enumerate(languages):
            if lang not in known:
                classes, top, counts, total = (
                    batch[_REFERENCE + name][i].as_py() for name in ("classes", "top", "counts", "words")
                )
                usual = np.array(classes or [0] * len(CLASSES), float)
                known[lang] = usual, top or [], word_vector(counts or [], total or 0)
        return [
            self.verdict(data, known[lang])
            for lang, data in zip(languages, byte_texts(batch["text"]), strict=True)
        ]


def _with_references(docs: DataFrame, folder: str) -> DataFrame:
    known = small(references(docs, folder), rows=10_000)
    reserved = {f"ref_{name}": _REFERENCE + name for name in ("classes", "top", "counts", "words")}
    known = known.withColumnsRenamed(reserved | {"lang": "_feira_lang"})
    return docs.withColumn("_feira_lang", _language()).join(known, "_feira_lang", "left")


def _verdict_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    judge = _Judge()
    names = [*_COUNTS, *[field.split()[0] for field in _VERDICT.split(", ")]]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
    for batch in sliced(batches):
        rows = judge.verdicts(batch)
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *names])


def quality_verdicts(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, five counts, base_failed, kept and both distances.

    A null text has no words and fails the base rules. A null language is a language, the same
    as the empty one. A language without a document of ``MIN_WORDS`` words has no reference,
    but there all fail the base rules. Repeated rows are judged each, ties cannot occur, an
    empty table gives no rows. Of other columns none is read.
    """
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    joined = _with_references(light, folder or new_folder(docs.sparkSession))
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    return joined.mapInArrow(_verdict_batches, f"doc_id long, {counts}, {_VERDICT}")


def drop_rejected(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` without the documents that the rules reject, all columns as they were."""
    columns = docs.columns

    def kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge()
        for batch in sliced(batches):
            kept = [row[6] for row in judge.verdicts(batch)]
            yield batch.filter(pa.array(kept, pa.bool_())).select(columns)

    joined = _with_references(docs, folder or new_folder(docs.sparkSession))
    return joined.mapInArrow(kept_batches, docs.schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_documents(spark, sf_dir))
