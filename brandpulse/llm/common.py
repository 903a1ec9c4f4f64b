"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One ASCII white-space run; words are what stands between such runs.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def workers_import(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, or from what was shipped
    with the job if that path isn't there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset a folder is made only for a local master, whose driver and executors
    share one disk; anywhere else the job stops with an error.
    """
    workers_import(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="brandpulse-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors reread files."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def null_key(col: Column) -> Column:
    """A join key that is never null: null and the empty text stay apart."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), col))


#: Where an operator keeps its input's columns, so that none of their names meets its own.
ROW = "_input_row"


def boxed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``df`` as one struct, and ``more`` columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *more)


def unboxed(df: DataFrame, cols: list[str], *new: str) -> DataFrame:
    """The columns ``cols`` out of the struct, and the ``new`` ones, which replace columns of the
    same name (in any case)."""
    names = {c.lower() for c in new}
    return df.select(*[F.col(ROW).getField(c).alias(c) for c in cols if c.lower() not in names], *new)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
