"""Sinks: Parquet tables, and the single-document files that other tools read."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tables(frames: dict[str, DataFrame], folder: str) -> None:
    """Each frame as a Parquet table of the folder: the form to work on."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def json_document(df: DataFrame, path: str, name: str, order: list[str], header: dict | None = None, drop: tuple[str, ...] = ("ord",)) -> None:
    """Export all rows as one document {..., name: [...]} in the given order, nulls left out.

    A single document is a single task by nature; it is for exchange with tools that read one file.
    """
    cols = [c for c in df.columns if c not in drop]
    items_document(df.select(F.struct(*order).alias("k"), F.to_json(F.struct(*cols)).alias("j")), path, name, header)


def items_document(rows: DataFrame, path: str, name: str, header: dict | None = None) -> None:
    """One document of the items ``j`` (JSON text) in order of ``k``; the task that writes it sorts on disk and holds a batch."""
    head = "{" + "".join(f'"{k}": {v}, ' for k, v in (header or {}).items()) + f'"{name}": ['

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, held = head, ""
        for b in batches:
            out = []
            for j in b.column(0).to_pylist():
                if j is not None:
                    out += [held + ","] if held else []
                    start, held = "", start + j
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array([(held or start) + "]}"])], names=["value"])

    # a first row without an item, so that a document of none is written too
    first = rows.sparkSession.range(1).select(F.lit(None).cast(rows.schema["k"].dataType).alias("k"), F.lit(None).cast("string").alias("j"))
    rows.select("k", "j").union(first).repartition(1).sortWithinPartitions("k", "j").select("j").mapInArrow(run, "value string").write.mode("overwrite").text(path)


def city_header(crs: str, origin: tuple[float, float, float, float] | None = None, bounds: tuple[float, float] | None = None) -> dict[str, str]:
    """The header of polygon and box documents: origin is (lat, lon, x, y), bounds metres to north-south and east-west."""
    head = {"version": json.dumps("1.0"), "crs": json.dumps(crs), "coordinate_system": json.dumps("enu")}
    if origin:
        head["origin"] = json.dumps(dict(zip(("lat", "lon", "x", "y"), origin, strict=True)))
    if bounds:
        head["bounds"] = json.dumps(dict(zip(("ns_m", "ew_m"), bounds, strict=True)))
    return head


def csv_lines(df: DataFrame) -> DataFrame:
    """(label, line): area label, centre and position, as comma-separated text."""
    return df.select("label", F.format_string("%s,%.3f,%.3f,%.8f,%.8f", "label", "cx", "cy", "lat", "lon").alias("line"))


def mjcf(bodies: DataFrame, path: str, name: str = "obb_world", floor: bool = False) -> None:
    """A simulator's world file of body elements (id, xml), in order of id."""
    plane = '<geom name="floor" type="plane" pos="0 0 0" size="0 0 1" rgba="0.7 0.7 0.7 1"/>\n' if floor else ""
    # fixed values: the simulator's stack and contact limits
    start = f'<mujoco model="{name}">\n<size nstack="40000000" nconmax="500000"/>\n<worldbody>\n{plane}'
    text = bodies.agg(F.concat(F.lit(start), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "xml"))), lambda r: r["xml"]), "\n"), F.lit("\n</worldbody>\n</mujoco>")).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)


def copy_manifest(selected: DataFrame, companions: DataFrame, source: str, target: str) -> DataFrame:
    """(src, dst) of files to copy; nothing is wiped or copied here."""
    every = selected.select("path").unionByName(companions.select(F.col("companion").alias("path"))).distinct()
    return every.select(F.col("path").alias("src"), F.concat(F.lit(target.rstrip("/")), F.expr(f"substring(path, {len(source.rstrip('/')) + 1})")).alias("dst"))
