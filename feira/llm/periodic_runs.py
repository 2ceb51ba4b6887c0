"""Periodic runs of words, found through string synchronising sets.

A run is a stretch with smallest period q and at least 4 * q words that no neighbouring word
extends. Scale t = 1, 2, 4, ... looks for the periods t <= q < 2 * t:

* Every stretch of t words has a name, made by pairing the names of its halves, so equal names
  mean equal words. A position is *highly periodic* if its t words have a period of t / 4 or
  less; such words lie in runs that smaller scales have found, which is where they are taken
  from: each scale supplies the small periods that the next ones leave out.
* A position i is *selected* if the smallest hash among the names at i .. i + t, highly periodic
  ones left out, stands at i or at i + t. That depends on the words i .. i + 2 * t - 1 alone, so
  equal contexts are selected alike; and among any t positions one is selected, unless 3 * t - 1
  words from the first have a period of t / 4 or less.
* A run of period q < 2 * t and 4 * q words or more holds t positions whose context of 2 * t words
  comes again q words on, inside the run. They are not all left out: words that had both q and
  a period of t / 4 or less would have a smaller period than q. So some selected position and the
  next one with an equal context are q apart, and not less: with two distances the stretch would
  have their common divisor as a period. Each such pair proposes a period, which is then
  extended in both directions by comparing words.

Documents are handled many at a time: their words are laid end to end, with names of their own
for each document. Documents without two equal contexts of 2 * t words are done after scale t.
"""

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import byte_texts, read_documents, ship, sliced

# A run has so many periods at least, and so many words.
MIN_PERIODS = 4
MIN_WORDS = 6
# Texts are handled together up to so many bytes; a longer one is handled alone, at about 25
# bytes of memory for each byte of text.
BATCH_BYTES = 1 << 22

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
RUN = "struct<start: long, length: long, period: long>"


def _hashed(names: np.ndarray) -> np.ndarray:
    """A mix of the names that keeps them apart; the largest value is left unused."""
    x = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.minimum(x, _NONE - np.uint64(1))


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.full(len(values), fill, values.dtype)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def _window_minima(values: np.ndarray, t: int) -> np.ndarray:
    """The smallest of the t + 1 values from each place on; t is a power of two."""
    lowest, width = values, 1
    while width < t:
        lowest = np.minimum(lowest, _shifted(lowest, width, _NONE))
        width *= 2
    return np.minimum(lowest, _shifted(lowest, 1, _NONE))


def selected(names: np.ndarray, left: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set at scale t: which positions are selected.

    ``names`` are those of t words, ``left`` the words to the document's end, ``periodic`` marks
    highly periodic positions.
    """
    hashes = _hashed(names)
    hashes[periodic | (left < t)] = _NONE
    lowest = _window_minima(hashes, t)
    at_ends = (lowest == hashes) | (lowest == _shifted(hashes, t, _NONE))
    return at_ends & (lowest != _NONE) & (left >= 2 * t)


def _equal_from(words: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j > i on."""
    done, step = 0, 16
    while j + done < len(words):
        a, b = words[i + done : i + done + step], words[j + done : j + done + step]
        differ = a[: len(b)] != b
        first = int(differ.argmax()) if len(differ) else 0
        if len(differ) and differ[first]:
            return done + first
        done += len(b)
        step *= 2
    return done


def _equal_before(words: np.ndarray, i: int, j: int) -> int:
    """How many words before i equal those before j > i."""
    done, step = 0, 16
    while i - done > 0:
        size = min(step, i - done)
        differ = words[i - done - size : i - done] != words[j - done - size : j - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done += size
        step *= 2
    return done


def _extended(words: np.ndarray, places: np.ndarray, period: int) -> Iterator[tuple[int, int, int]]:
    """The different maximal stretches of ``period`` around sorted ``places``: start, end, period."""
    k = 0
    while k < len(places):
        i = int(places[k])
        end = i + period + _equal_from(words, i, i + period)
        yield i - _equal_before(words, i, i + period), end, period
        k = int(np.searchsorted(places, end - period))


def find(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of MIN_PERIODS periods or more, as rows start, end, period, in no order.

    ``words`` are numbers of words, those of one document after those of another, and no number
    stands in two documents; ``sizes`` are the documents' numbers of words.
    """
    found: list[tuple[int, int, int]] = []
    document = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    place = np.arange(len(words))
    left = ends[document] - place if len(words) else place
    names, t = words, 1
    while True:
        # only documents with room for a run of this scale go on
        keep = sizes[document] >= MIN_PERIODS * t
        if not keep.all():
            document, place, left, names = document[keep], place[keep], left[keep], names[keep]
        if not len(place):
            break
        periodic = np.zeros(len(place), bool)
        for start, end, period in found:
            if MIN_PERIODS * period <= t <= end - start:
                begin, stop = np.searchsorted(place, [start, end - t + 1])
                periodic[begin:stop] = True
        whole = left >= 2 * t
        pairs = names * np.int64(len(words) + 1) + _shifted(names, t, 0)
        contexts = np.full(len(place), -1, np.int64)
        contexts[whole] = pd.factorize(pairs[whole])[0]
        chosen = np.flatnonzero(selected(names, left, t, periodic))
        chosen = chosen[np.argsort(contexts[chosen], kind="stable")]
        apart = np.diff(chosen)
        proposes = (np.diff(contexts[chosen]) == 0) & (apart >= t) & (apart < 2 * t)
        starts, periods = place[chosen[:-1][proposes]], apart[proposes]
        order = np.lexsort((starts, periods))
        starts, periods = starts[order], periods[order]
        for period in np.unique(periods).tolist():
            low, high = np.searchsorted(periods, [period, period + 1])
            for run in _extended(words, starts[low:high], period):
                if run[1] - run[0] >= MIN_PERIODS * period:
                    found.append(run)
        # and only those with two equal contexts, which longer ones need as well
        repeated = np.bincount(contexts[whole], minlength=1) > 1
        again = np.zeros(len(sizes), bool)
        again[document[whole][repeated[contexts[whole]]]] = True
        keep = again[document]
        # names of 2 t words; those cut off by the document's end are never looked at again
        names = np.where(whole, contexts, 0)
        document, place, left, names = document[keep], place[keep], left[keep], names[keep]
        t *= 2
    return np.array(found, np.int64).reshape(-1, 3)


def runs_of(documents: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs, as rows start, length, period by start, then period."""
    sizes = np.array([len(words) for words in documents], np.int64)
    flat = [word for words in documents for word in words]
    if not flat:
        return [np.zeros((0, 3), np.int64) for _ in documents]
    numbers, different = pd.factorize(np.array(flat, dtype=object))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own_numbers = pd.factorize(owner * np.int64(len(different)) + numbers)[0].astype(np.int64)
    runs = find(own_numbers, sizes)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(MIN_WORDS, MIN_PERIODS * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    cuts = np.searchsorted(runs[:, 0], begins)
    result = []
    for i in range(len(documents)):
        own = runs[cuts[i] : cuts[i + 1]]
        result.append(np.stack([own[:, 0] - begins[i], own[:, 1] - own[:, 0], own[:, 2]], axis=1))
    return result


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _found(rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH_BYTES):
            # bytes: splits at the six ASCII white-space characters only
            documents = [data.split() for data in byte_texts(batch["text"])]
            if rewrite:
                ids = batch["doc_id"].to_pylist()
                documents = [rewrite(i, words) for i, words in zip(ids, documents, strict=True)]
            runs = runs_of(documents)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32))
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            columns = [pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)]
            spans = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
            kept = [b" ".join(collapsed(words, r)) for words, r in zip(documents, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(words) for words in documents], pa.int64()),
                    pa.ListArray.from_arrays(offsets, spans),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return found


def periodic_runs(
    docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period in words, by start, then
    period) and collapsed, the text with every run cut to its first period.

    ``rewrite`` may change the words of a document, given its doc_id, before runs are looked for.
    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows and
    doc_ids are handled row by row, a null doc_id is kept, an empty table gives no rows, other
    columns are not read. Words are joined by one space in ``collapsed``.
    """
    ship(docs.sparkSession)
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return light.mapInArrow(
        _found(rewrite), f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"
    )


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: some documents go on periodically from a place of their own."""
    if doc_id is None or not words:
        return words
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_documents(spark, sf_dir), planted)
    # the greatest length over period, compared as exact products
    best = F.reduce(
        "runs",
        F.lit(None).cast(RUN),
        lambda kept, run: F.when(
            kept.isNull() | (run["length"] * kept["period"] > kept["length"] * run["period"]), run
        ).otherwise(kept),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
