"""Keeping a table that several later jobs read, and small join sides."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes a broadcast join side may have.
MAX_BROADCAST_BYTES = 32 << 20


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="earshot-shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else the
    one given to ``setCheckpointDir``, else, on this machine alone, one that
    goes when the process ends.  A cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _own_folder()
    return folder


def hold(table: DataFrame) -> DataFrame:
    """Compute ``table`` once for several readers and cut its lineage.

    A checkpoint in the shared folder survives the loss of executors.  With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes it once
    nothing refers to the result any more.
    """
    context = table.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(table.sparkSession))
    return table.checkpoint()


def hold_blocks(table: DataFrame, id_col: str, parts: int, block_rows: int) -> DataFrame:
    """(block, rows): the rows of ``table`` as Arrow bytes, held in blocks of twice
    ``block_rows`` at most, dealt to ``parts`` partitions by a hash of the id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, waiting, rows = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                waiting.append(batch.slice(at, block_rows))
                rows += waiting[-1].num_rows
                if rows > block_rows:
                    yield _block(f"{part}-{done}", waiting)
                    done, waiting, rows = done + 1, [], 0
        if waiting:
            yield _block(f"{part}-{done}", waiting)

    return hold(table.repartition(parts, F.xxhash64(id_col)).mapInArrow(pack, "block string, rows binary"))


def _block(name: str, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as out:
        for batch in batches:
            out.write_batch(batch)
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])


def _row_bytes(table: DataFrame):
    """About the bytes of a row: numbers at eight, lists and texts by length."""
    total = F.lit(8 * len(table.columns))
    for name, kind in table.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("array"):
            total = total + 8 * F.greatest(F.size(column), F.lit(0))
        elif kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
    return total


def small_side(table: DataFrame) -> DataFrame:
    """A join side that is expected to be small and is shown to be.

    Spark cannot tell the size of an aggregate beforehand and would shuffle
    the big side to be safe.  The table is computed and measured; within
    MAX_BROADCAST_BYTES it is broadcast, beyond it Spark joins as usual.
    """
    held = hold(table)
    size = held.agg(F.sum(_row_bytes(held).cast("long"))).first()[0] or 0
    return F.broadcast(held) if size <= MAX_BROADCAST_BYTES else held
