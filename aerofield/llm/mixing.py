"""Mixing sources to target weights with a low-discrepancy schedule of blocks, equal within a source."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._rows import noted, numbered
from ._shared import fresh_name, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: Words of a block at most; a mix of fewer than `SLOTS` such blocks has smaller blocks.
BLOCK_WORDS = 4096
SLOTS = 65536
#: A source has smaller blocks where its target, or its words, would not make so many.
SOURCE_BLOCKS = 512
#: Schedule slots and documents are numbered in two steps: within chunks, then over chunks.
CHUNK_SLOTS = 4096
#: Leading hexadecimal digits of a document's shuffle key that form its chunk.
CHUNK_DIGITS = 3
#: Cells of the unit interval for finding a point's source.
CELLS = 1024
GOLDEN = 0.6180339887498949


def size() -> Column:
    """Number of words of ``text``: runs of bytes other than ASCII white space."""
    return F.expr(r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) as bigint)")


def _order(seed: str = "mix") -> Column:
    """What rows of a source are shuffled by: the MD5 of doc_id, ``seed`` and the text's MD5."""
    own = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return F.md5(F.concat(own, F.lit(f":{seed}:"), F.md5(F.coalesce("text", F.lit("")))))


def _key() -> Column:
    """A source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: its weight, source_size, target, block and part of the schedule.

    A source's blocks have ``block`` words.  Its part, from low to high of total, is its target, or
    more in proportion where its blocks are smaller than ``slot``, the words of the largest blocks.

    Sources in code-point order (null last) weigh ``weights``, repeating.  They share
    ``share`` times all words by weight; a target stops at ``cap`` times its source's
    words and the excess goes to the others: target = min(cap * size, level * weight) with
    the level at which the targets add up.  Sources without words get 0.
    """
    s = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("rank", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double"))
    full = F.col("source_size") * F.lit(float(cap))
    by_level = Window.orderBy(full / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(full).over(by_level), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))))
    # sources fill up in order; from the first one that its level does not fill, all share that level,
    # and levels worked out past it are lower
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= full, F.col("level"))).over(everything))
    s = s.withColumn("target", F.coalesce(F.least(full, F.col("level") * F.col("weight")), full))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("slot", block_words(F.sum("target").over(everything)))
    s = s.withColumn("block", F.greatest(F.lit(1), F.least("slot", F.floor(F.least("target", "source_size") / SOURCE_BLOCKS))).cast("bigint"))
    s = s.withColumn("part", F.col("target") * (F.col("slot") / F.col("block")))
    return s.withColumn("high", F.sum("part").over(upto)).withColumn("low", F.col("high") - F.col("part")).withColumn("total", F.sum("part").over(everything)).drop("level", "part")


def slots_of(plan: DataFrame) -> tuple[float, int]:
    """Words of the mix's targets, and slots of its schedule."""
    head = plan.agg(F.first("total").alias("total"), F.first("slot").alias("slot")).first()
    return float(head.total or 0), -(-int(head.total or 0) // (head.slot or 1))


def block_words(total: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(total / SLOTS))).cast("bigint")


def schedule(plan: DataFrame) -> DataFrame:
    """(slot, skey, rank, epoch, block): which block of which source each slot of the mix takes.

    Slot i has the golden-ratio point frac(i * 0.618...) and goes to the source in whose part
    of the schedule the point falls.  Slots are ranked per source; rank r takes
    block r mod n of the source's n blocks, in epoch r div n.  Ranks past the last
    allowed epoch take nothing.
    """
    spark = plan.sparkSession
    total, slots = slots_of(plan)
    at = F.col("slot") * F.lit(GOLDEN)
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", (at - F.floor(at)) * F.lit(total))
    cell = lambda x: F.floor(x * CELLS / F.lit(total or 1.0))
    parts = plan.where("target > 0").select("skey", "low", "high", F.ceil(F.col("source_size") / F.col("block")).cast("bigint").alias("blocks"), F.explode(F.sequence(cell(F.col("low")) - 1, cell(F.col("high")) + 1)).alias("cell"))
    dealt = points.withColumn("cell", cell(F.col("point"))).join(F.broadcast(parts) if plan.count() < 1000 else parts, "cell").where("point >= low and point < high")
    dealt = dealt.select("slot", "skey", "blocks", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk"))
    chunks = dealt.groupBy("skey", "chunk").count()
    before = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("skey", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot")) - 1).join(chunks, ["skey", "chunk"])
    ranked = ranked.select("slot", "skey", (F.col("nth") + F.col("before")).alias("rank"), "blocks")
    return ranked.where(f"rank < {CAP} * blocks").selectExpr("slot", "skey", "rank", "rank div blocks as epoch", "rank % blocks as block")


def placed(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry``, skey, size and start: where each row's words begin in its source's stream, shuffled by ``key``.

    Rows of equal keys have one doc_id and text, so that their order among themselves is of no account.
    """
    d = docs.withColumn("chunk", F.substring("key", 1, CHUNK_DIGITS))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    chunks = d.groupBy("skey", "chunk").agg(F.sum("size").alias("words"))
    chunks = chunks.select("skey", "chunk", F.coalesce(F.sum("words").over(before(Window.partitionBy("skey").orderBy("chunk"))), F.lit(0)).alias("before"))
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(before(Window.partitionBy("skey", "chunk").orderBy("key"))), F.lit(0)))
    return d.join(chunks, ["skey", "chunk"]).select(*carry, "skey", "size", (F.col("inside") + F.col("before")).alias("start"))


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row: the words that the schedule takes of it.

    Null texts have no words; a null source is a source; rows that share a doc_id, or have none, are
    shuffled by their texts; repeated rows are rows of their own; empty tables give no rows.
    """
    sized = written(docs.select(F.col("doc_id").cast("long"), "source", size().alias("size"), _key().alias("skey"), _order().alias("key")), "sizes")
    plan = written(targets(sized), "targets")
    if not plan.count():
        return sized.select("doc_id", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("taken"))
    d = placed(sized.withColumn("row", F.monotonically_increasing_id()), ["doc_id", "row"])
    d = written(d, "placed")
    times = schedule(plan).groupBy("skey", "block").agg(F.count("*").alias("times"))
    words = plan.select("skey", F.col("block").alias("words"))
    parts = d.where("size > 0").join(words, "skey").select("row", "skey", "words", "start", (F.col("start") + F.col("size")).alias("end"), F.explode(F.expr("sequence(start div words, (start + size - 1) div words)")).alias("block"))
    got = parts.join(times, ["skey", "block"]).groupBy("row").agg(F.sum(F.expr("times * (least(end, (block + 1) * words) - greatest(start, block * words))")).alias("taken"))
    return d.join(got, "row", "left").join(plan.select("skey", "source_size", "target"), "skey").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row per document and epoch, with the words taken there, in the schedule's order.

    A document that an epoch takes whole keeps its text; where the epoch ends inside it, it
    keeps its leading words and their white space.  A row stands at the slot of the block in which its
    words begin, rows of one block in the order of their source's stream: partitions hold ranges of slots
    in order, and rows are sorted in them, so that sources alternate as scheduled in files written from it.

    Only the rows' numbers and sizes are placed; what is taken of them is then noted on the rows, which
    travel once.  ``docs`` must give the same rows in the same order when it is read again, as files do; else it raises.

    Nulls and repeated rows are as in `taken`; rows without words go, as nothing is taken of them; columns
    may have any names; an empty table gives no rows.
    """
    sized = written(numbered(docs.select("doc_id", "source", "text")).select("row", "check", "source", size().alias("size"), _key().alias("skey"), _order().alias("key")), "sizes")
    plan = written(targets(sized.select("source", "size", "skey")), "targets")
    if not plan.count():
        return docs
    words = plan.select("skey", F.col("block").alias("words"))
    slots = written(schedule(plan).join(words, "skey"), "schedule")
    ends = slots.groupBy("skey", "words", "epoch").count().select("skey", "words", F.struct("epoch", (F.col("count") * F.col("words")).alias("stop")).alias("end"))
    ends = ends.groupBy("skey", "words").agg(F.collect_list("end").alias("ends"))  # at most CAP epochs
    rows = placed(sized, ["row"]).join(ends, "skey").select("row", "skey", "size", "start", "words", F.explode("ends").alias("end"))
    rows = rows.select("row", "skey", "size", "start", F.expr("start div words").alias("block"), "end.epoch", F.least("size", F.col("end.stop") - F.col("start")).alias("kept")).where("kept > 0")
    rows = rows.join(slots.select("skey", "epoch", "block", "slot"), ["skey", "epoch", "block"])
    takes = rows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("slot", "start", "kept", "size"))).alias("takes"))
    notes = sized.select("row", "check").join(takes, "row", "left")
    kinds = [StructField(fresh_name(docs, c), LongType()) for c in ("slot", "start", "kept", "size")]

    def take(b: pa.RecordBatch, t: pa.Table) -> pa.RecordBatch:
        lists = t["takes"].combine_chunks()
        at, each = pc.list_parent_indices(lists), lists.flatten()
        return pa.RecordBatch.from_arrays([*b.take(at).columns, *(each.field(c) for c in ("slot", "start", "kept", "size"))], names=[*b.schema.names, *(k.name for k in kinds)])

    slot, start, kept, whole = (k.name for k in kinds)
    mixed = noted(docs, notes, take, StructType([*docs.schema.fields, *kinds]))
    parts = max(1, docs.rdd.getNumPartitions())
    mixed = mixed.repartitionById(parts, F.expr(f"cast(`{slot}` * {parts} div {max(1, slots_of(plan)[1])} as int)")).sortWithinPartitions(slot, start)
    part = F.expr(rf"case when `{kept}` = `{whole}` then text else array_join(slice(regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0), 1, cast(`{kept}` as int)), '') end")
    return mixed.withColumn("text", part).select(docs.columns)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


ORACLES = {
    "op4_source_mixing": rf"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix:' || md5(coalesce(text, ''))) AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS full_size FROM src),
lv AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(full_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY full_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tg AS (SELECT *, coalesce(least(full_size, weight * max(CASE WHEN level * weight <= full_size THEN level END) OVER ()), full_size) AS target FROM lv),
plan AS (SELECT *, sum(target) OVER (ORDER BY rank) AS high, sum(target) OVER (ORDER BY rank) - target AS low, sum(target) OVER () AS total FROM tg),
blk AS (SELECT *, CAST(greatest(1, least({BLOCK_WORDS}, floor(total / {SLOTS}))) AS BIGINT) AS block FROM plan),
slots AS (SELECT slot, (slot * {GOLDEN}::DOUBLE - floor(slot * {GOLDEN}::DOUBLE)) * total AS point
  FROM (SELECT max(total) AS total, CAST(ceil(floor(max(total)) / max(block)) AS BIGINT) AS n FROM blk), range(0, 200000) AS r(slot) WHERE slot < n),
ranked AS (SELECT slot, rank AS src, row_number() OVER (PARTITION BY rank ORDER BY slot) - 1 AS nth, CAST(ceil(source_size / block) AS BIGINT) AS blocks
  FROM slots JOIN blk ON point >= low AND point < high),
times AS (SELECT src, nth % blocks AS b, count(*) AS times FROM ranked WHERE nth < 2 * blocks GROUP BY ALL),
pos AS (SELECT doc_id, size, rank AS src, source_size, target, block,
  coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized JOIN blk ON sized.source IS NOT DISTINCT FROM blk.source),
parts AS (SELECT doc_id, src, start, size, block, unnest(range(CAST(start // block AS BIGINT), CAST((start + size - 1) // block AS BIGINT) + 1)) AS b FROM pos WHERE size > 0),
got AS (SELECT doc_id, CAST(sum(times * (least(start + size, (parts.b + 1) * block) - greatest(start, parts.b * block))) AS BIGINT) AS taken FROM parts JOIN times ON parts.src = times.src AND parts.b = times.b GROUP BY doc_id)
SELECT pos.doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM pos LEFT JOIN got ON pos.doc_id = got.doc_id"""
}

QUERIES = {"op4_source_mixing": op4_source_mixing}
