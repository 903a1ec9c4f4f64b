"""Table writers: insert-if-absent, upsert, materialised-view refresh, JDBC.

DataFrame-level functions (``append_new``, ``merge_upsert``) are pure and oracle-testable;
the path-level writers apply them to parquet tables without ever overwriting a path that
the same job is reading: merged partitions are staged under the shared checkpoint folder
first, then swapped in with dynamic partition overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from brandpulse.session import work_dir


def _keyless(keys: list[str]):
    """Whether a key column is NULL: such rows never conflict (SQL UNIQUE)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


# ------------------------------------------------------------------------------ S9 J5 P13
def append_new(new: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target`` (one row per key).

    ``INSERT ... ON CONFLICT DO NOTHING`` keeps the first row written for a key; within
    ``new`` the row kept per key is the smallest by all columns, so reruns are stable (a
    group-limited window: one row per key and task is shuffled). NULL keys never conflict, so
    every row with one is new.
    """
    others = [c for c in new.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*(others or keys))
    first = (new.filter(~_keyless(keys)).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
    return first.join(target.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(
        new.filter(_keyless(keys)))


def insert_if_absent(new: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The table after the insert: ``target`` plus :func:`append_new`."""
    return target.unionByName(append_new(new, target, keys))


# ------------------------------------------------------------------------------ S11
def _one_per_key(new: DataFrame, keys: list[str]) -> DataFrame:
    """``new``, or an error when it runs if two of its rows share a key."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ok = F.when((n > 1) & ~_keyless(keys), F.raise_error(F.lit("an upsert batch has two rows of one key")).cast("boolean"))
    return new.withColumn("_ok", F.coalesce(ok, F.lit(True))).filter("_ok").drop("_ok")


def merge_upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` as a relation: target rows whose key
    appears in ``new`` are replaced by the new rows. NULL keys never conflict (as in SQL
    UNIQUE constraints), because NULL never equals NULL in the join."""
    return target.join(new.select(*keys), keys, "left_anti").select(*target.columns).unionByName(new.select(*target.columns))


def stored(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path`` in its declared types (partition folders are not guessed at), or
    None if there is no such path. Any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _staged(df: DataFrame, name: str, observation: Observation | None = None) -> DataFrame:
    """``df`` written once under the shared scratch folder and read back; ``observation`` gets its
    ``rows`` from that write."""
    path = work_dir(df.sparkSession, name)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _touched_partitions(target: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of ``target`` in the partitions ``new`` has rows for.

    The least and greatest value of each partition column (one row) prune folders in the scan;
    the exact tuples are matched by a null-safe semi join, as a NULL partition value is a folder
    like any other, and its stored rows must be carried into a rewrite."""
    ends = new.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(partition_by) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for i, c in enumerate(partition_by):
        inside = F.col(c).isNull()
        if ends[f"lo{i}"] is not None:
            inside = inside | F.col(c).between(F.lit(ends[f"lo{i}"]), F.lit(ends[f"hi{i}"]))
        target = target.filter(inside)
    t, n = target.alias("_t"), new.select(*partition_by).distinct().alias("_n")
    cond = F.lit(True)
    for c in partition_by:
        cond = cond & F.col(f"_t.{c}").eqNullSafe(F.col(f"_n.{c}"))
    return t.join(n, cond, "left_semi").select(*[F.col(f"_t.{c}").alias(c) for c in target.columns])


def upsert_table(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
                 partition_by: list[str], observation: Observation | None = None) -> DataFrame:
    """S11 on a parquet table partitioned by ``partition_by``: key columns, or columns that a key
    determines (the day of an hour bucket).

    ``new`` is staged once and must have one row per key. Only partitions it touches are read,
    merged and rewritten (dynamic partition overwrite); the merged partitions are staged before
    the overwrite, so the job never reads from the files it replaces. Returns the staged rows;
    ``observation`` gets the number of rows in ``new``.
    """
    batch = _staged(_one_per_key(new, keys), "upsert-batch", observation)
    target = stored(spark, path, new.schema)
    if target is None:
        batch.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
        return batch
    staged = _staged(merge_upsert(_touched_partitions(target.select(*new.columns), batch, partition_by), batch, keys), "upsert-stage")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return staged


def append_if_absent(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
                     partition_by: list[str] | None = None, observation: Observation | None = None) -> DataFrame:
    """Append rows of ``new`` whose key is not stored yet; returns the appended rows, and
    their number in ``observation``.

    When the partition columns are part of the key, only the touched partitions' keys are
    read. The batch and the rows to append are staged under the shared scratch folder: the
    append copies durable files, and the returned rows don't change once the table has them."""
    batch = _staged(new, "append-batch")
    had = stored(spark, path, new.schema)
    if had is None:
        had = batch.limit(0)
    elif partition_by and set(partition_by) <= set(keys):
        had = _touched_partitions(had.select(*new.columns), batch, partition_by)
    staged = _staged(append_new(batch, had, keys), "append-stage", observation)
    w = staged.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return staged


def refresh_view(df: DataFrame, path: str) -> None:
    """Materialised-view refresh = overwrite the gold table with the query result."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A serving table (parquet). Filters and projections on the result reach the scan
    (``PushedFilters`` / ``ReadSchema``); partition columns prune folders."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as the table ``table``, bucketed and sorted by ``key``: tables of equal key and number of buckets join,
    and group by that key, where they are."""
    df.write.mode("errorifexists").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


# ------------------------------------------------------------------------------ S7 S8
def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 10_000, num_partitions: int | None = None,
                 isolation: str = "READ_COMMITTED") -> dict[str, str]:
    """Options for Spark's JDBC data source (S7 writer / S8 reader)."""
    o = {"url": url, "dbtable": table, "batchsize": str(batchsize), "isolationLevel": isolation}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if driver is not None:
        o["driver"] = driver
    if num_partitions is not None:
        o["numPartitions"] = str(num_partitions)
    return o


def jdbc_append(df: DataFrame, options: dict[str, str]) -> None:
    """Append rows to a JDBC table (batched inserts, one connection per partition)."""
    df.write.format("jdbc").options(**options).mode("append").save()


def jdbc_read(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None) -> DataFrame:
    """Read a JDBC table; with a numeric ``partition_column`` the scan is split over
    ``numPartitions`` range queries. Filters on the result are pushed into the SQL."""
    r = spark.read.format("jdbc").options(**options)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower)).option("upperBound", str(upper)))
    return r.load()
