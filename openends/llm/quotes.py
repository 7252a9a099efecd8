"""Messages linked by what they quote, and conversations without quotes, in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openends.llm.common import unique
from openends.sources.shared import stored

# "On Monday A. wrote:" above a quote is part of it, in the languages mail programs use.
ATTRIBUTION = r"(?i)^\s*.{0,200}\b(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"
MARKS = r"^((?:[ \t]*>)+)"
MESSAGE = ["conv_id", "turn"]


def normal(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """One row per line of a message: line, level (0: its own), content, and run.

    A line's level is the number of ">" before it. Lines of one level that follow each
    other are a run; blank lines end a run of own lines. A line that announces a quote
    right above it counts as quoted, with level -1: it belongs to no one's passage.
    """
    split = F.split(F.coalesce("text", F.lit("")), r"\r\n|\r|\n")
    lines = messages.select(*MESSAGE, F.posexplode(split).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 1)
    lines = lines.select(
        *MESSAGE,
        "line",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        F.trim(F.expr("substring(raw, length(regexp_extract(raw, '" + MARKS + "', 1)) + 1)")).alias("content"),
    )
    by_line = Window.partitionBy(*MESSAGE).orderBy("line")
    announced = (
        (F.col("level") == 0)
        & F.col("content").rlike(ATTRIBUTION)
        & (F.lead("level").over(by_line) > 0)
    )
    lines = lines.withColumn("level", F.when(announced, -1).otherwise(F.col("level")))
    blank = (F.col("content") == "") & (F.col("level") == 0)
    before = F.lag("level").over(by_line)
    starts = F.coalesce((before != F.col("level")), F.lit(True)) | blank
    return lines.withColumn("run", F.sum(starts.cast("int")).over(by_line))


def passages(lines: DataFrame) -> DataFrame:
    """Runs of lines as (conv_id, turn, run, level, content, key): text and 128-bit hash.

    The hash is that of the normalised text, so that a quote wrapped anew is still
    recognised. Runs without text are left out.
    """
    in_order = F.array_sort(F.collect_list(F.struct("line", "content")))
    runs = lines.groupBy(*MESSAGE, "run", "level").agg(in_order.alias("_lines"))
    content = F.array_join(F.transform("_lines", lambda x: x["content"]), "\n")
    runs = runs.select(*MESSAGE, "run", "level", content.alias("content"))
    return _keyed(runs)


def _keyed(rows: DataFrame) -> DataFrame:
    text = normal(F.col("content"))
    keyed = rows.withColumn("key", F.unhex(F.md5(text))).withColumn("size", F.length(text))
    return keyed.filter("size > 0")


def link_quotes(lines: DataFrame) -> DataFrame:
    """Quoted passages with the message they come from: conv_id, turn, run, level, original.

    A passage is looked up by the hash of the whole of it and of its lines among what
    earlier messages of the conversation wrote themselves: whole messages, runs and lines. Its
    original is the message that has most of its characters, the later one of equals; null
    if there is none. Who wrote a text first is aggregated with map-side combining
    before the join, so a text that everyone repeats adds no pairs.
    """
    runs = passages(lines)
    single = _keyed(lines.filter("level >= 0"))
    own_lines = single.filter("level = 0").select(*MESSAGE, "key")
    own_runs = runs.filter("level = 0").select(*MESSAGE, "key")
    whole = lines.filter("level = 0").withColumn("run", F.lit(0))
    own_whole = passages(whole).select(*MESSAGE, "key")
    first = (
        own_lines.unionByName(own_runs)
        .unionByName(own_whole)
        .groupBy("conv_id", "key")
        .agg(F.min("turn").alias("original"))
    )
    asked_columns = [*MESSAGE, "run", "level", "key", "size"]
    quoted = runs.filter("level > 0").select(*asked_columns)
    asked = quoted.unionByName(single.filter("level > 0").select(*asked_columns))
    found = asked.join(first, ["conv_id", "key"]).filter("original < turn")
    voted = found.groupBy(*MESSAGE, "run", "original").agg(F.sum("size").alias("votes"))
    best = voted.groupBy(*MESSAGE, "run").agg(
        F.max(F.struct("votes", "original"))["original"].alias("original")
    )
    return quoted.select(*MESSAGE, "run", "level", "size").join(best, [*MESSAGE, "run"], "left")


def _threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message's turn and the way to it.

    Every message points up; in a round those that have not arrived take over where the
    message they point at points to, which doubles their way. Messages that have
    arrived wait, so a round costs no more than the messages still under way.
    """
    ways = replies.select(
        *MESSAGE,
        F.coalesce("reply_to", "turn").alias("up"),
        F.col("reply_to").isNotNull().cast("bigint").alias("depth"),
        F.col("reply_to").isNotNull().alias("open"),
    )
    while True:
        ways = stored(ways, "ways")
        under_way = ways.filter("open")
        if under_way.isEmpty():
            return ways.select(*MESSAGE, F.col("up").alias("thread"), "depth")
        above = ways.select(
            "conv_id",
            F.col("turn").alias("up"),
            F.col("up").alias("top"),
            F.col("depth").alias("more"),
            F.col("open").alias("more_open"),
        )
        moved = under_way.drop("open").join(above, ["conv_id", "up"]).select(
            *MESSAGE,
            F.col("top").alias("up"),
            (F.col("depth") + F.col("more")).alias("depth"),
            F.col("more_open").alias("open"),
        )
        ways = ways.filter("NOT open").unionByName(moved)


def reply_order(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Messages in reply order, without quotes.

    Per message: conv_id, turn, role, text (its own lines; blank lines at the ends and repeated
    ones left out), n_passages and max_level (what it quotes), n_linked (passages
    whose original is known), reply_to, thread and depth. Ordered by conv_id, thread, depth and turn,
    every message comes after the one it replies to. No message or conversation is collected in one place.

    A message replies to the original of the passage of lowest level, the longest of those;
    without one to the message a turn earlier, if there is one; else it starts a thread.

    Null texts are empty. Rows without a conversation or turn are left out, rows that repeat both
    count once, an empty table gives no rows.
    """
    rows = messages.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = unique(rows, *MESSAGE)
    lines = stored(quoted_lines(rows), "lines")
    links = stored(link_quotes(lines), "links")
    rank = F.struct(-F.col("level"), "size", "original")
    quoted = links.groupBy(*MESSAGE).agg(
        F.count(F.lit(1)).alias("n_passages"),
        F.max("level").alias("max_level"),
        F.count("original").alias("n_linked"),
        F.max(F.when(F.col("original").isNotNull(), rank))["original"].alias("quoted"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("line", "content")))
    own = lines.filter("level = 0").groupBy(*MESSAGE).agg(in_order.alias("_own"))
    joined = F.array_join(F.transform("_own", lambda x: x["content"]), "\n")
    clean = F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    own = own.select(*MESSAGE, clean.alias("text"))
    earlier = rows.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("before"))
    replies = (
        rows.select(*MESSAGE, "role")
        .join(own, MESSAGE, "left")
        .join(quoted, MESSAGE, "left")
        .join(earlier, MESSAGE, "left")
        .select(
            *MESSAGE,
            "role",
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("n_passages", F.lit(0)).cast("bigint").alias("n_passages"),
            F.coalesce("max_level", F.lit(0)).cast("int").alias("max_level"),
            F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
            F.coalesce("quoted", "before").alias("reply_to"),
        )
    )
    replies = stored(replies, "replies")
    return replies.join(_threads(replies), MESSAGE)
