"""Chat formatting: replies linked by what they quote, with DataFrame functions only.

A line that begins with signs > is quoted, as many levels deep as there are signs. Quoted
lines, and all lines of one level together, are normalised and hashed, and joined to the
message of the conversation that first wrote them itself. The message that most words of the
outermost linked level come from is the one replied to; without such a link it is the message
before. Conversations come out in reply order, without quotes.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.common import stored
from feira.sources.working import new_folder

# Fixed value: a line of one's own, right before a quote, that names whom it quotes.
ATTRIBUTION = r"(wrote|writes|schrieb|schreibt|a écrit|écrit|escribió|escribe) ?:[ \t]*$"
# Turns that are ordered in one group; conversations longer than this are cut into several.
TURNS_AT_ONCE = 4096

_SIGNS = r"^((?:[ \t]*>)+)[ \t]?"
_NONE = -(1 << 63)


def _plain(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with their key (conv, at, tie), their lines with levels, and their own text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    line = F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(
            F.length(F.translate(F.regexp_extract(x, _SIGNS, 1), " \t", "")).alias("level"),
            F.regexp_replace(x, _SIGNS, "").alias("body"),
        ),
    )
    keyed = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NONE)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_NONE)).alias("at"),
        F.xxhash64(text).alias("tie"),
        line.alias("lines"),
    )
    own = F.filter(
        "lines",
        lambda x, i: (x["level"] == 0)
        & ~(
            F.coalesce(F.get("lines", i + 1)["level"] > 0, F.lit(False))
            & F.regexp_like(x["body"], F.lit(ATTRIBUTION))
        ),
    )
    bodies = F.transform(own, lambda x: x["body"])
    clean = F.regexp_replace(F.array_join(bodies, "\n"), r"^\s+|\s+$", "")
    return keyed.select("*", bodies.alias("own"), clean.alias("clean"))


def _passages(lines: Column, whole: Column) -> Column:
    """Normalised lines and the whole, each once, without empty ones."""
    each = F.array_append(F.transform(lines, _plain), _plain(whole))
    return F.filter(F.array_distinct(each), lambda x: x != "")


def quote_links(messages: DataFrame, folder: str) -> DataFrame:
    """(conv, at, tie, level, origin, words): for every message (``parsed``, stored), level and
    linked message how many quoted words come from there. origin is a turn before ``at``."""
    written = messages.select(
        "conv", "at", F.explode(_passages(F.col("own"), F.col("clean"))).alias("passage")
    )
    # one row per passage and conversation, so that a common one meets a quote once
    originals = written.groupBy("conv", F.sha2("passage", 256).alias("hash")).agg(
        F.min("at").alias("origin")
    )
    originals = stored(originals, "originals", folder)
    levels = F.array_distinct(
        F.transform(F.filter("lines", lambda x: x["level"] > 0), lambda x: x["level"])
    )
    quoting = messages.select("conv", "at", "tie", "lines", F.explode(levels).alias("level"))
    bodies = F.transform(
        F.filter("lines", lambda x: x["level"] == F.col("level")), lambda x: x["body"]
    )
    quoted = quoting.select(
        "conv",
        "at",
        "tie",
        "level",
        F.explode(_passages(bodies, F.array_join(bodies, "\n"))).alias("passage"),
    ).select(
        "conv",
        "at",
        "tie",
        "level",
        F.sha2("passage", 256).alias("hash"),
        F.size(F.split("passage", " ")).cast("long").alias("words"),
    )
    quoted = stored(quoted.distinct(), "quoted", folder)
    return (
        quoted.join(originals, ["conv", "hash"])
        .where("origin < at")
        .groupBy("conv", "at", "tie", "level", "origin")
        .agg(F.sum("words").alias("words"))
    )


def previous_turns(messages: DataFrame, folder: str) -> DataFrame:
    """(conv, at, before): the turn before each turn of a conversation, null for the first.

    Turns are ordered in groups of ``TURNS_AT_ONCE`` numbers, then the groups' last turns, so
    a conversation of any length is never in one group.
    """
    group = F.floor(F.col("at") / TURNS_AT_ONCE)
    turns = messages.select("conv", "at", group.alias("group")).distinct()
    turns = stored(turns, "turns", folder)
    within = Window.partitionBy("conv", "group").orderBy("at")
    over = Window.partitionBy("conv").orderBy("group")
    ends = turns.groupBy("conv", "group").agg(F.max("at").alias("end"))
    ends = ends.select("conv", "group", F.lag("end").over(over).alias("end_before"))
    inner = turns.withColumn("inner", F.lag("at").over(within))
    return inner.join(ends, ["conv", "group"]).select(
        "conv", "at", F.coalesce("inner", "end_before").alias("before")
    )


def roots(parents: DataFrame, folder: str) -> DataFrame:
    """(conv, at, root, depth) from (conv, at, parent), by jumps of doubling length.

    Each round is stored, takes up only what has not come to its root, and the number of
    rounds is the logarithm of the longest chain.
    """
    jumps = parents.select(
        "conv",
        "at",
        F.coalesce("parent", "at").alias("root"),
        F.col("parent").isNotNull().cast("long").alias("depth"),
    )
    jumps, step = stored(jumps, "jumps_0", folder), 0
    begins, waiting, done = jumps.where("depth = 0"), jumps.where("depth > 0"), []
    while not waiting.isEmpty():
        step += 1
        far = reduce(DataFrame.union, [waiting, *done]).select(
            "conv", F.col("at").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more")
        )
        longer = waiting.join(far, ["conv", "root"], "left").select(
            "conv",
            "at",
            F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        longer = stored(longer, f"jumps_{step}", folder)
        done.append(longer.where("not moved").drop("moved"))
        waiting = longer.where("moved").drop("moved")
    return reduce(DataFrame.union, [begins, *done])


def reply_ordered(conversations: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per message: conv_id, turn, role, parent_turn, linked, thread_turn, depth,
    quote_levels, text, formatted.

    Sorted by conv_id, thread_turn and turn, a conversation reads in reply order: a message
    stands after the one it replies to (parent_turn), in the thread that began at thread_turn;
    ``linked`` says whether a quote decided. ``text`` is without quotes, ``formatted`` has the
    role before it. A null text is an empty message, a null role an empty one, null conv_ids
    are one conversation, a null turn comes before all others. Rows that repeat conversation,
    turn and text get the same result; different messages at one turn share its place, and the
    turn's parent is that of the best linked one. An empty table gives no rows. Other columns
    are not read.
    """
    folder = folder or new_folder(conversations.sparkSession)
    messages = stored(parsed(conversations), "messages", folder)
    best = F.max(F.struct(-F.col("level"), "words", "origin"))
    linked = quote_links(messages, folder).groupBy("conv", "at").agg(best.alias("best"))
    linked = linked.select("conv", "at", F.col("best.origin").alias("origin"))
    before = previous_turns(messages, folder)
    parents = before.join(linked, ["conv", "at"], "left").select(
        "conv",
        "at",
        F.coalesce("origin", "before").alias("parent"),
        F.col("origin").isNotNull().alias("linked"),
    )
    parents = stored(parents, "parents", folder)
    placed = roots(parents, folder).join(parents, ["conv", "at"])
    placed = stored(placed, "placed", folder)
    levels = F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0))

    def shown(turn: str) -> Column:
        return F.when(F.col(turn) != _NONE, F.col(turn))

    return messages.join(placed, ["conv", "at"]).select(
        "conv_id",
        "turn",
        "role",
        shown("parent").alias("parent_turn"),
        "linked",
        shown("root").alias("thread_turn"),
        "depth",
        levels.cast("long").alias("quote_levels"),
        F.col("clean").alias("text"),
        F.concat(
            F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("clean"), F.lit("\n")
        ).alias("formatted"),
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP4_SQL = r"""
WITH RECURSIVE l AS (
  SELECT conv_id, turn, role, text,
         list_transform(string_split(text, chr(10)), lambda x: struct_pack(
           level := length(translate(regexp_extract(x, '^((?:[ \t]*>)+)[ \t]?', 1), ' ' || chr(9), '')),
           body := regexp_replace(x, '^((?:[ \t]*>)+)[ \t]?', ''))) AS lines
  FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)),
o AS (
  SELECT *, list_transform(list_filter(lines, lambda x, i: x.level = 0 AND NOT (
           coalesce(lines[i + 1].level, 0) > 0 AND regexp_matches(x.body,
             '(wrote|writes|schrieb|schreibt|a écrit|écrit|escribió|escribe) ?:[ \t]*$'))), lambda x: x.body) AS own
  FROM l),
m AS (SELECT *, regexp_replace(array_to_string(own, chr(10)), '^\s+|\s+$', '', 'g') AS clean FROM o),
w AS (
  SELECT conv_id, turn, unnest(list_append(own, clean)) AS passage FROM m),
origin AS (
  SELECT conv_id, lower(trim(regexp_replace(passage, '[\x20\x09-\x0D]+', ' ', 'g'))) AS plain, min(turn) AS origin
  FROM w GROUP BY ALL HAVING plain <> ''),
v AS (
  SELECT conv_id, turn, text, lines, unnest(list_distinct(list_transform(list_filter(lines, lambda x: x.level > 0), lambda x: x.level))) AS level
  FROM m),
q AS (
  SELECT conv_id, turn, text, level,
         list_transform(list_filter(lines, lambda x: x.level = v.level), lambda x: x.body) AS bodies FROM v),
p AS (
  SELECT DISTINCT conv_id, turn, text, level,
         lower(trim(regexp_replace(unnest(list_append(bodies, array_to_string(bodies, chr(10)))), '[\x20\x09-\x0D]+', ' ', 'g'))) AS plain
  FROM q),
k AS (
  SELECT p.conv_id, turn, text, level, origin, sum(len(string_split(p.plain, ' '))) AS words
  FROM p JOIN origin USING (conv_id, plain) WHERE origin < turn GROUP BY ALL),
best AS (
  SELECT conv_id, turn, max(struct_pack(l := -level, w := words, o := origin)).o AS origin
  FROM k GROUP BY ALL),
t AS (SELECT DISTINCT conv_id, turn FROM m),
par AS (
  SELECT t.conv_id, t.turn, origin IS NOT NULL AS linked,
         coalesce(origin, lag(t.turn) OVER (PARTITION BY t.conv_id ORDER BY t.turn)) AS parent_turn
  FROM t LEFT JOIN best USING (conv_id, turn)),
r AS (
  SELECT conv_id, turn, turn AS thread_turn, CAST(0 AS BIGINT) AS depth FROM par WHERE parent_turn IS NULL
  UNION ALL
  SELECT par.conv_id, par.turn, r.thread_turn, r.depth + 1
  FROM par JOIN r ON par.conv_id = r.conv_id AND par.parent_turn = r.turn)
SELECT m.conv_id, m.turn, m.role, par.parent_turn, par.linked, r.thread_turn, r.depth,
       CAST(coalesce(list_max(list_transform(lines, lambda x: x.level)), 0) AS BIGINT) AS quote_levels,
       clean AS text, '<|' || coalesce(m.role, '') || '|>' || chr(10) || clean || chr(10) AS formatted
FROM m JOIN par USING (conv_id, turn) JOIN r USING (conv_id, turn)
"""
