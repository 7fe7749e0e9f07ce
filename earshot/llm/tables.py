"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.hold import shared_folder

# Rows of a broadcast side at most; its rows are one or two longs.
BROADCAST_ROWS = 1_000_000


def keep(table: DataFrame, name: str) -> DataFrame:
    """Write ``table`` to the shared folder and read it back.

    Cuts lineage, so lost executors cost no recomputation of what lies before,
    and several readers find the rows computed once.
    """
    path = f"{shared_folder(table.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
    table.write.parquet(path)
    kept = table.sparkSession.read.schema(table.schema).parquet(path)
    kept.kept_at = path
    return kept


def release(*tables: DataFrame) -> None:
    """Delete kept tables that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.kept_at).getParent()
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def if_small(ids: DataFrame) -> DataFrame:
    """A kept table of a few longs a row, marked for broadcast only when a count
    shows that it is small; else joined as usual."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))
