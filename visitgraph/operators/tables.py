"""Tables written to the folder that all executors share, so that they are worked out once and outlive any executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


#: Rows of a table that one task is dealt, for what it then sorts or keeps in a hash table.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str, always: bool = False) -> DataFrame:
    """``df`` dealt by ``keys`` into so many parts that each has about ``TASK_ROWS`` of ``rows`` rows.

    Where that needs no more parts than the session gives any shuffle, it is left as it is, or dealt into these with ``always``.
    """
    parts = -(-rows // TASK_ROWS)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(parts, *keys)
    return df.repartition(*keys) if always else df


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the folder that ``spark.checkpoint.dir`` names, and read back.

    ``spent`` deletes its files; else they go when the driver ends.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/linkage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    system, at = _place(df, path)
    system.deleteOnExit(at)
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes the files of ``settled`` tables that nothing reads any more."""
    for t in tables:
        system, at = _place(t, t.stored_at)
        system.delete(at, True)


def _place(df: DataFrame, path: str) -> tuple:
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()), at
