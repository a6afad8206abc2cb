"""Notes on the rows of a table, brought to them without moving the table.

A row's number is its task's partition and its place there, as Spark numbers rows; it is the
same whenever the same input is read again.  Notes come as one file per partition, with a hash of each
row's text; a row whose hash differs, or that has no note, raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import _files
from ._shared import fresh_dir, fresh_name, released
from ._text import tidy

#: Bits of a row's number for its place within its partition.
PLACES = 33


def numbered(docs: DataFrame, row: str = "row", check: str = "check") -> DataFrame:
    """``docs`` with each row's number and a hash of its text."""
    return docs.withColumns({row: F.monotonically_increasing_id(), check: F.hash("text")})


def noted(docs: DataFrame, notes: DataFrame, run: Callable[[pa.RecordBatch, pa.Table], pa.RecordBatch], schema: StructType) -> DataFrame:
    """``run`` of the batches of ``docs`` and their rows' ``notes``: (row, check, ...), one for each row."""
    folder = fresh_dir(docs.sparkSession, "notes")
    fs, at = _files.opened(folder)
    fs.create_dir(at)

    def put(t: pa.Table) -> pa.Table:
        t = t.sort_by("row").combine_chunks()
        name = t["row"][0].as_py() >> PLACES
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t)
        _files.put(folder, str(name), sink.getvalue().to_pybytes())
        return pa.table({"partition": [name]})

    with released(docs.sparkSession):
        notes.groupBy(F.shiftright("row", PLACES)).applyInArrow(put, "partition long").write.format("noop").mode("overwrite").save()
    row, check = fresh_name(docs, "row"), fresh_name(docs, "check")

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = None, -1
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.asarray(b.column(row))
            if rows[0] >> PLACES != part:
                part = int(rows[0] >> PLACES)
                with pa.ipc.open_stream(_files.get(folder, str(part))) as r:
                    known = r.read_all()
            here = known.slice(int(rows[0] - (part << PLACES)), len(rows))
            if here.num_rows != len(rows) or not np.array_equal(np.asarray(here["row"]), rows) or not np.array_equal(np.asarray(here["check"]), np.asarray(b.column(check))):
                raise RuntimeError("the input must give the same rows in the same order when it is read again")
            yield run(b.select([c for c in b.schema.names if c not in (row, check)]), here)

    return numbered(docs, row, check).mapInArrow(tidy(attach), schema)
