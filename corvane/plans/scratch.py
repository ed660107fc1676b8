"""Scratch tables in the shared checkpoint folder.

Iterative operators and multi-pass plans cut their lineage by writing a table and
reading it back: every executor sees it, it survives lost executors, and the
planner knows its size when it picks join strategies.

The folder is the session's ``spark.checkpoint.dir``; where that is unset it is
the warehouse folder, for every master alike. The tables of an application live in
a database of their own at that place, so dropping one removes its files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def _app(spark: SparkSession) -> str:
    return re.sub(r"\W", "_", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written file set, under the folder of this application."""
    return f"{scratch_dir(spark)}/corvane/{_app(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, replaces: Sequence[DataFrame] = (),
                keyed_by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    ``replaces`` are materialized tables nothing else reads any more; they are
    deleted once the new table stands, so a loop holds a few tables at a time.
    With ``keyed_by`` the table is laid out in as many hash buckets of these columns as
    a shuffle has partitions: joins on them don't shuffle it again. ``dealt`` says that
    ``df`` comes out of a shuffle on these columns already, an aggregate on them for one.
    """
    spark = df.sparkSession
    database = f"corvane_{_app(spark)}"
    place = f"{scratch_dir(spark)}/corvane/{_app(spark)}/tables".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")
    table = f"{database}.{re.sub(r'[^0-9A-Za-z]', '_', name)}_{uuid.uuid4().hex}".lower()
    if keyed_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df if dealt else df.repartition(buckets, *keyed_by)
        (rows.write.format("parquet").option("compression", "zstd")
         .bucketBy(buckets, *keyed_by).sortBy(*keyed_by).saveAsTable(table))
    else:
        df.write.format("parquet").option("compression", "zstd").saveAsTable(table)
    release(*replaces)
    stored = spark.table(table)
    stored.scratch_table = table
    return stored


def release(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in tables:
        name = getattr(df, "scratch_table", None)
        if name is not None:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name} PURGE")
            df.scratch_table = None


def sweep(spark: SparkSession) -> None:
    """Let go of shuffle files no result reads any more.

    Spark deletes a shuffle's files once the driver's JVM has collected its plan, which may
    be long after its rows were stored. Steps that shuffle much ask for it in between.
    """
    spark.sparkContext._jvm.System.gc()
