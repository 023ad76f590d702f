"""Files of JSON pages, as a tracker exports its records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "data array<struct<gid:string,name:string,memberships:array<struct<project:struct<name:string>>>>>"


def write_pages(pages: DataFrame) -> str:
    """Writes ``pages`` (data: its records) as lines of JSON under ``spark.checkpoint.dir``; returns the folder."""
    root = pages.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/pages-{uuid.uuid4().hex}"
    pages.write.json(path)
    return path


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(gid, name, memberships): the records of all pages at ``path``; a broken page fails."""
    return spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path).select(F.explode("data").alias("r")).select("r.*")
