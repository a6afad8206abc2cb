"""Chat formatting by multi-party perspective rotation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import table

START, END = "<|im_start|>", "<|im_end|>"
#: The name of a speaker whose role is null.
NOBODY = "unknown"
#: The role whose turns are instructions to all: no participant, never learned.
SYSTEM = "system"
#: Turns of a training text; a longer dialogue is rendered in as many parts as it takes.
PART_TURNS = 512
#: Turn numbers that are counted together before whole dialogues are.
SPAN = 4096


def escaped(text: Column) -> Column:
    """A text in which no mark can begin: "<|" becomes "<||", which is undone by the opposite replacement."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def named(speaker: Column) -> Column:
    """A speaker's name on one line: backslashes and line ends are written as escapes."""
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        speaker = F.replace(speaker, F.lit(raw), F.lit(shown))
    return escaped(speaker)


def dialogue() -> Column:
    """A dialogue's key: its conv_id as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))


def ordered(turns: DataFrame) -> DataFrame:
    """(key, conv_id, turn, speaker, content, place): every turn with its place in its dialogue, from 0.

    Turns are ordered by turn (null first), speaker, two hexadecimal digits of the content's MD5, and content.
    No dialogue is sorted in one task: equal turns are counted before they travel, and places
    are added up from counts of spans of turn numbers, of speakers' turns in a span, and of
    contents in one of those.
    """
    content = F.coalesce("text", F.lit(""))
    said = turns.select(dialogue().alias("key"), "conv_id", F.col("turn").cast("long"), F.coalesce("role", F.lit(NOBODY)).alias("speaker"), content.alias("content"), F.substring(F.md5(content), 1, 2).alias("chunk"))
    said = said.withColumn("span", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(1 << 62))))
    cell = ["key", "span", "turn", "speaker", "chunk"]
    t = said.groupBy(*cell, "content").agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("times"))
    cells = said.groupBy(*cell).agg(F.count("*").alias("times"))
    before = lambda w: F.coalesce(F.sum("times").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = cells.groupBy("key", "span").agg(F.sum("times").alias("times")).withColumn("span_at", before(Window.partitionBy("key").orderBy("span"))).drop("times")
    cells = cells.withColumn("cell_at", before(Window.partitionBy("key", "span").orderBy("turn", "speaker", "chunk"))).drop("times").join(spans, ["key", "span"])
    t = t.withColumn("own_at", before(Window.partitionBy(*cell).orderBy("content")))
    same = [t[c].eqNullSafe(cells[c]) for c in cell]
    t = t.join(cells, same).select(t["key"], "conv_id", t["turn"], t["speaker"], "content", "times", (F.col("span_at") + F.col("cell_at") + F.col("own_at")).alias("first"))
    return t.withColumn("place", F.explode(F.sequence("first", F.col("first") + F.col("times") - 1))).drop("first", "times")


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, n_turns, text, mask): every dialogue rendered for each of its participants.

    The participants are the distinct roles but "system".  In a participant's text their own turns are the
    assistant's, all others' are users' with their names, and "system" turns stay such.  ``mask`` lists
    the character ranges of ``text`` that are learned: the participant's contents with their
    end marks.  Marks inside contents and names are escaped, see `escaped` and `named`.

    A dialogue of more than ``part_turns`` turns comes in parts of so many, numbered from 0; so a row
    is bounded by that many turns' texts, and no dialogue is gathered in one task.
    Turns are ordered as in `ordered`.  Null texts are empty; a null role is the participant "unknown"; a
    null conv_id is a dialogue of its own, apart from the empty string; null turns sort first;
    repeated turns are kept; a dialogue of system turns alone has no participant and no row; an
    empty table gives no rows; other columns are ignored.
    """
    t = ordered(turns)
    who = turns.select(dialogue().alias("key"), F.coalesce("role", F.lit(NOBODY)).alias("perspective")).where(F.col("perspective") != SYSTEM).distinct()
    said = F.struct("place", "speaker", "content")
    parts = t.groupBy("key", F.floor(F.col("place") / part_turns).alias("part")).agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(said)).alias("said"))
    own = lambda x: x["speaker"] == F.col("perspective")

    def piece(x: Column) -> Column:
        user = F.concat(F.lit(f"{START}user name="), named(x["speaker"]), F.lit("\n"))
        head = F.when(own(x), f"{START}assistant\n").when(x["speaker"] == SYSTEM, f"{START}system\n").otherwise(user)
        return F.struct(own(x).alias("own"), head.alias("head"), F.concat(escaped(x["content"]), F.lit(END)).alias("body"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("end")))
        return F.struct((stop + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    rows = parts.join(who, "key").select("conv_id", "perspective", "part", F.transform("said", piece).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    mask = F.aggregate("pieces", nothing, step, lambda acc: acc["spans"])
    return rows.select("conv_id", "perspective", "part", F.size("pieces").alias("n_turns"), text.alias("text"), mask.alias("mask"))


def op9_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform("mask", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(shown, ","))


ORACLES = {
    "op9_chat_perspectives": rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '{NOBODY}') AS speaker, coalesce(text, '') AS content FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, md5(content)[1:2], content) - 1 AS place FROM t),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
b AS (SELECT o.conv_id, perspective, place, place // {PART_TURNS} AS part, speaker = perspective AS own,
  CASE WHEN speaker = perspective THEN '{START}assistant' WHEN speaker = '{SYSTEM}' THEN '{START}system'
    ELSE '{START}user name=' || replace(replace(replace(replace(speaker, '\', '\\'), chr(10), '\n'), chr(13), '\r'), '<|', '<||') END || chr(10) AS head,
  replace(content, '<|', '<||') || '{END}' AS body FROM o JOIN who ON o.conv_id IS NOT DISTINCT FROM who.conv_id),
m AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY place) - length(body) - 1 AS pos FROM b)
SELECT conv_id, perspective, part, CAST(count(*) AS INTEGER) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CASE WHEN own THEN CAST(pos AS BIGINT) || '-' || CAST(pos + length(body) AS BIGINT) END, ',' ORDER BY place), '') AS mask
FROM m GROUP BY conv_id, perspective, part"""
}

QUERIES = {"op9_chat_perspectives": op9_chat_perspectives}
