import duckdb
import pandas as pd
from pyspark.sql import functions as F

from feira.llm import chat
from tests.conftest import executed_plan
from tests.llm.conftest import same

SCHEMA = "conv_id long, turn long, role string, text string, level int, at long"
TALK = [
    (1, 0, "user", "Hello there\nHow are you today my friend"),
    (1, 1, "assistant", "Ann wrote:\n> How are you today my friend\nFine"),
    (1, 2, "user", "> > How are you today my friend\n> Fine\nok then"),
    (1, 3, "user", "> Hello there\n> How are you  TODAY my friend\nThird\n> unknown text"),
    (1, 5, "other", "no quote"),
    (1, 5, "other", ">Third\nno"),
    (1, 9, "other", ">> Third\n>>  \nlast"),
    (2, 0, None, None),
    (2, 7, "x", ""),
    (2, 7, "x", ""),
    (2, 9, "x", "> > > a\n>b"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 3, 4) for row in rows], SCHEMA)


def plain(rows):
    return [tuple(None if pd.isna(v) else v for v in row) for row in rows]


def test_replies_are_linked_by_quotes(spark):
    found = chat.reply_ordered(frame(spark, TALK)).collect()
    own = {(r.conv_id, r.turn, r.text): (r.parent_turn, r.linked, r.depth, r.quote_levels) for r in found}
    assert own[1, 0, "Hello there\nHow are you today my friend"] == (None, False, 0, 0)
    assert own[1, 1, "Fine"] == (0, True, 1, 1)
    assert own[1, 2, "ok then"] == (1, True, 2, 2)
    assert own[1, 3, "Third"] == (0, True, 1, 1)
    assert own[1, 5, "no"] == (3, True, 2, 1)
    assert own[1, 9, "last"] == (3, True, 2, 2)
    assert own[2, 7, ""] == (0, False, 1, 0)
    assert len(found) == len(TALK)


def test_same_as_sql(spark):
    talk = frame(spark, TALK)
    connection = duckdb.connect()
    connection.register("conversations", talk.toPandas())
    result = connection.execute(chat.OP4_SQL)
    names = [column[0] for column in result.description]
    found = chat.reply_ordered(talk).select(*names).collect()
    assert same(plain(map(tuple, found)), plain(result.fetchall()))


def test_long_conversations_are_cut(spark, monkeypatch):
    talk = [(1, 3 * i, "user", f"message number {i}") for i in range(60)]
    expected = chat.reply_ordered(frame(spark, talk)).collect()
    monkeypatch.setattr(chat, "TURNS_AT_ONCE", 4)
    found = chat.reply_ordered(frame(spark, talk)).collect()
    assert same(map(tuple, found), map(tuple, expected))
    assert {row.depth for row in found} == set(range(60))
    assert {row.thread_turn for row in found} == {0}


def test_nulls_and_empty(spark):
    talk = [(None, 1, "a", "x"), (None, None, "a", "y"), (None, 2, None, "> y\nz")]
    found = {row.text: row for row in chat.reply_ordered(frame(spark, talk)).collect()}
    assert found["y"].parent_turn is None and found["y"].depth == 0
    assert found["x"].depth == 1 and found["z"].depth == 1 and found["z"].linked
    assert chat.reply_ordered(frame(spark, talk).limit(0)).collect() == []


def test_no_python_on_the_way(spark):
    plan = executed_plan(chat.reply_ordered(frame(spark, TALK)).where(F.col("turn") > 0))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
