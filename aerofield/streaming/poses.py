"""A stream of poses against static environment tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.search import disturbance, primary_area, property_of


def latest(poses: DataFrame, key: str = "drone", at: str = "ts", carry: tuple[str, ...] = ()) -> DataFrame:
    """The last usable pose of each drone, with columns ``carry``: poses with a null coordinate are skipped; of equal times the largest row counts."""
    ok = poses.where("x is not null and y is not null and z is not null")
    return ok.groupBy(key).agg(F.max(F.struct(at, *carry, "x", "y", "z")).alias("p")).select(key, "p.*")


def ticks(poses: DataFrame, width: str, key: str = "drone", carry: tuple[str, ...] = ()) -> DataFrame:
    """The last pose of each drone in each event-time window of ``width``; with a watermark it runs as a stream (an extension)."""
    return poses.where("x is not null").groupBy(F.window("ts", width).alias("w"), key).agg(F.max(F.struct("ts", *carry, "x", "y", "z")).alias("p")).select(F.col("w.start").alias("tick"), key, "p.*")


def felt(poses: DataFrame, areas: DataFrame, links: DataFrame, properties: DataFrame) -> DataFrame:
    """Poses with area_id and disturbance; outside every area, or without a property, all is zero.  For a batch of poses."""
    df = property_of(primary_area(poses, areas), links, properties)
    return df.withColumn("disturbance", disturbance(F.col("properties"))).drop("properties", "area_property_id")


MESSAGE = "drone long, ts timestamp, x double, y double, z double"


def messages(stream: DataFrame, schema: str = MESSAGE) -> DataFrame:
    """Poses of JSON messages (column ``value``); messages that can't be read, or lack a field, are left out."""
    m = stream.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("m")).select("m.*")
    return m.dropna()


def finished(query: StreamingQuery, callbacks: dict[str, Callable] | None = None) -> None:
    """Wait until a query has ended, and say so (``on_stop``)."""
    query.awaitTermination()
    (callbacks or {}).get("on_stop", lambda: None)()


def run(poses: DataFrame, environment: tuple[DataFrame, DataFrame, DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, callbacks: dict[str, Callable] | None = None) -> StreamingQuery:
    """Feed each micro-batch's latest poses, with what they feel, to ``sink``.

    ``every`` is the wall-clock interval of the batches; without it all that is there is taken once.
    ``environment`` is (areas, properties, links).  A failing sink fails the query, which goes on
    from its checkpoint when started again.  ``callbacks`` are called by name: on_initialize before the
    query starts, on_tick with each batch's number when it is done, on_reset with the error of a batch that failed.
    """
    areas, properties, links = environment
    call = lambda name, *args: (callbacks or {}).get(name, lambda *_: None)(*args)
    call("on_initialize")

    def step(batch: DataFrame, n: int) -> None:
        try:
            sink(felt(latest(batch), areas, links, properties), n)
        except Exception as e:
            call("on_reset", e)
            raise
        call("on_tick", n)

    w = poses.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def drift(poses: DataFrame, theta: float = 0.15) -> DataFrame:
    """Each drone's pull back to calm since its pose before: exp(-theta * seconds) (an extension)."""
    dt = F.col("ts").cast("double") - F.lag("ts").over(Window.partitionBy("drone").orderBy("ts")).cast("double")
    return poses.withColumn("keep", F.exp(-F.coalesce(dt, F.lit(0.0)) * theta))
