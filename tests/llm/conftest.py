import random

import pytest

SF = "/root/testdata/sf0.001"
NAMES = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHES = (
    "row long, kept boolean, digest string, fp long, size long, block int, word string, "
    "ref_top string, ref_words long, ref_counts string, ref_classes string, term string, item long, "
    "shard int, local int, hi long, lo long, next_row long, runs string, n_words long"
)


def sample_rows():
    """Nulls, empty and long texts, copies, repeated rows and shared passages."""
    rng = random.Random(7)
    syllables = ["th", "er", "on", "ti", "an", "re", "he", "in", "ed", "nd", "ö", "é", "字"]

    def words(n):
        return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]

    def prose(n):
        found = words(n)
        for i in range(4, n, 9):
            found[i] += rng.choice([".", ".\n", ",", "!"])
        return " ".join(found)

    passage = prose(60)
    long = prose(4000)
    texts = [prose(rng.randint(1, 150)) for _ in range(24)]
    texts += [passage, prose(30) + " " + passage + " " + prose(30), prose(5) + "\n" + passage + "\n"]
    texts += [long, long + " end", long.replace("th", "ht", 3), texts[3], texts[3], texts[3].upper()]
    texts += ["", "   \n\t ", "a", "x" * 60, "x" * 120, "<|endoftext|>", "a  b\r\n\x0b c d  e"]
    rows = [
        (i, text, ["en", "de", None, ""][i % 4], [f"s{i % 3}", None][i % 7 == 0], len(text))
        for i, text in enumerate(texts)
    ]
    rows += [(100, None, None, None, None), (None, texts[5], "en", "s1", 3), (None, None, "", "", 0)]
    rows += [rows[4], rows[4], (7, "another text with the same number", "en", "s1", 1)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def documents(spark, rows):
    """The sample with extra columns of clashing names, in several partitions."""
    extra = (1, True, "d", 2, 3, 4, "w", "r", 5, "r", "r", "t", 6, 7, 8, 9, 10, 11, "r", 12)
    frame = spark.createDataFrame([(*row, *extra) for row in rows], f"{NAMES}, {CLASHES}")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"{NAMES}, {CLASHES}")


def same(left, right):
    """Whether two collections of tuples are equal as bags; None sorts too."""
    return sorted(map(repr, left)) == sorted(map(repr, right))
