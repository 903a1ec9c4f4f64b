"""Stored tables of a stream: batch folders, compaction under a manifest, and a key index.

A micro-batch is published as one folder ``batch_id=N``: written beside the table under ``_staged``, which
no reader looks into, and renamed. A folder that is there is complete, so a replayed batch is skipped, and
nothing that a reader or the next stream has seen is ever rewritten. (On a store without an atomic rename, use a
table format instead.)

Compaction folds batch folders into day partitions, ``<root>_days/version=K``, and publishes a manifest row,
``<root>_manifest/version=K``: the last batch it covers, and the folders that hold them. Readers take
the folders of the newest manifest and the batch folders behind it; replays ask it too. Covered
folders stay for readers that have them open, and :func:`covered_folders` lists them for removal.

The key index answers which of a batch's keys earlier batches had, from a part of them that follows the batch: keys
lie in one folder per batch and bucket of their hash, with Bloom filters of ``SLOT_KEYS`` keys each; only
folders whose filter may hold a key are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "batch_id"
#: Keys that share one Bloom filter of 32,768 bits, on average at most, and bits set per key.
SLOT_KEYS = 2_500
PROBES = 4
BITS = 32_768
#: Folders of one batch or generation.
BUCKETS = 256
#: Rows of a batch that one task writes.
TASK_ROWS = 50_000


# ------------------------------------------------------------------------------------ folders
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def numbered(spark: SparkSession, root: str, name: str) -> list[int]:
    """The numbers N of the folders ``name=N`` under ``root``, ascending."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


def publish(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> bool:
    """Writes ``df`` as the folder ``path`` unless it is there. Returns whether it wrote."""
    spark = df.sparkSession
    if exists(spark, path):
        return False
    root, leaf = path.rstrip("/").rsplit("/", 1)
    staged = f"{root}/_staged/{leaf}-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(*partition_by).parquet(staged)
    fs, p = _fs(spark, path)
    if fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), p):
        return True
    if fs.exists(p):    # another attempt of the same folder came first
        return False
    raise OSError(f"{staged} can't be renamed to {path}")


def day_column(time_col: str) -> str:
    return f"{time_col}_day"


def _tasks(spark: SparkSession, wanted: int) -> int:
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted))


def with_day(df: DataFrame, time_col: str, rows: int | None = None) -> DataFrame:
    """Adds the day partition of ``time_col``, rows of a day brought together; a large day takes several tasks.

    The batches of a stateful stream run without adaptive execution, where Spark drops the hint and every
    task would write a file of every day. There the rows are dealt by range of the day and their hash,
    ``TASK_ROWS`` to a task where their number is known."""
    spark, day = df.sparkSession, day_column(time_col)
    dated = df.withColumn(day, F.to_date(time_col))
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        return dated.hint("rebalance", day)
    n = _tasks(spark, 1 << 31 if rows is None else -(-rows // TASK_ROWS))
    return dated.repartitionByRange(n, day, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


# ------------------------------------------------------------------------------------ batches
def committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return exists(spark, f"{root}/{BATCH_COL}={int(batch_id)}") or int(batch_id) <= manifest(spark, root)[1]


def write_batch(df: DataFrame, root: str, batch_id: int, time_col: str | None = None) -> bool:
    """Publishes a batch, in day partitions of ``time_col`` if given, unless it is committed. A frame
    that has the day column already (:func:`with_day`) is written as it lies."""
    root = root.rstrip("/")
    if committed(df.sparkSession, root, batch_id):
        return False
    target = f"{root}/{BATCH_COL}={int(batch_id)}"
    if not time_col:
        return publish(df, target)
    day = day_column(time_col)
    return publish(df if day in df.columns else with_day(df, time_col), target, [day])


def manifest(spark: SparkSession, root: str) -> tuple[int, int, list[str]]:
    """Newest version, the last batch that it covers, and its folders; (0, -1, []) without one."""
    versions = numbered(spark, f"{root.rstrip('/')}_manifest", "version")
    if not versions:
        return 0, -1, []
    r = spark.read.schema("upto long, folders array<string>").parquet(f"{root.rstrip('/')}_manifest/version={versions[-1]}").first()
    return versions[-1], r.upto, list(r.folders)


def _stored_schema(schema: T.StructType, time_col: str) -> T.StructType:
    day = day_column(time_col)
    fields = [f for f in schema.fields if f.name not in (BATCH_COL, day)]
    return T.StructType([*fields, T.StructField(BATCH_COL, T.LongType()), T.StructField(day, T.DateType())])


def read_live(spark: SparkSession, root: str, schema: T.StructType, time_col: str) -> DataFrame:
    """The table as of now, compacted or not, with ``batch_id`` and the day column, both of which prune."""
    root = root.rstrip("/")
    stored = _stored_schema(schema, time_col)
    _, upto, folders = manifest(spark, root)
    parts = []
    if folders:
        parts.append(spark.read.option("basePath", f"{root}_days").schema(stored).parquet(*folders).select(*stored.names))
    if any(n > upto for n in numbered(spark, root, BATCH_COL)):
        parts.append(spark.read.schema(stored).parquet(root).where(F.col(BATCH_COL) > upto).select(*stored.names))
    if not parts:
        return spark.createDataFrame([], stored)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, root: str, schema: T.StructType, time_col: str, whole: bool = False) -> int:
    """Folds the batches behind the manifest (``whole``: all that is live) into day partitions and
    publishes a manifest. Returns its version; without new batches nothing is done."""
    root = root.rstrip("/")
    version, upto, folders = manifest(spark, root)
    new = [n for n in numbered(spark, root, BATCH_COL) if n > upto]
    if not new:
        return version
    stored = _stored_schema(schema, time_col)
    if whole:
        rows, folders = read_live(spark, root, schema, time_col), []
    else:
        rows = spark.read.schema(stored).parquet(root).where((F.col(BATCH_COL) > upto) & (F.col(BATCH_COL) <= new[-1]))
    day = day_column(time_col)
    # a run that ended between the two publications leaves a folder that no manifest names
    folder = f"{root}_days/version={version + 1}-{uuid.uuid4().hex[:8]}"
    publish(rows.select(*stored.names).hint("rebalance", day), folder, [day])
    row = spark.createDataFrame([(new[-1], [*folders, folder])], "upto long, folders array<string>").coalesce(1)
    if not publish(row, f"{root}_manifest/version={version + 1}"):
        raise RuntimeError("another compaction came first; its manifest holds")
    return version + 1


def covered_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders that the newest manifest makes needless for new readers."""
    root = root.rstrip("/")
    _, upto, folders = manifest(spark, root)
    batches = [f"{root}/{BATCH_COL}={n}" for n in numbered(spark, root, BATCH_COL) if n <= upto]
    fs, p = _fs(spark, f"{root}_days")
    days = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    held = {f.rsplit("/", 1)[1] for f in folders}
    return batches + [f"{root}_days/{d}" for d in days if d.startswith("version=") and d not in held]


# ------------------------------------------------------------------------------------ key index
def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key)


def _slots(n: int) -> int:
    """The power of two of filters for n keys."""
    return 1 << max(0, -(-n // SLOT_KEYS) - 1).bit_length()


def _add(keys: DataFrame, path: str, n: int) -> None:
    """Publishes keys (``key``) and their filters under ``path``."""
    slots = _slots(n)
    buckets = min(slots, BUCKETS)
    slot = F.pmod(_hash(F.col("key"), 0), F.lit(slots)).cast("int")
    # A bucket's keys go to one task, which writes them in one file and builds their filters from them; filters
    # made by every task of the batch would be as many times their size to shuffle and sort.
    placed = keys.select("key", slot.alias("slot")).withColumn("bucket", F.col("slot") % buckets).repartition(_tasks(keys.sparkSession, buckets), "bucket")
    publish(placed.select("key", "bucket"), f"{path}/keys", ["bucket"])
    bit = F.explode(F.array(*[F.pmod(_hash(F.col("key"), i), F.lit(BITS)) for i in range(1, PROBES + 1)]))
    filters = placed.select("slot", "bucket", bit.alias("bit")).groupBy("slot", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    publish(filters.select(F.lit(slots).alias("slots"), "slot", "bucket", "bits"), f"{path}/filters")


def index_keys(keys: DataFrame, root: str, batch_id: int) -> None:
    """Adds the keys of a batch (one column) to the index, unless they are in it."""
    spark = keys.sparkSession
    path = f"{root.rstrip('/')}/{BATCH_COL}={int(batch_id)}"
    if exists(spark, f"{path}/filters") or int(batch_id) <= manifest(spark, root)[1]:
        return
    named = keys.toDF("key")
    _add(named, path, named.count())


def _parts(spark: SparkSession, root: str, before: int) -> list[str]:
    """The folders of generations and of the batches behind them."""
    root = root.rstrip("/")
    _, upto, folders = manifest(spark, root)
    return folders + [f"{root}/{BATCH_COL}={n}" for n in numbered(spark, root, BATCH_COL) if upto < n < before and exists(spark, f"{root}/{BATCH_COL}={n}/filters")]


def may_hold(keys: DataFrame, root: str, before: int) -> list[str]:
    """The bucket folders, of batches before ``before``, whose filters may hold one of ``keys`` (``key``)."""
    spark = keys.sparkSession
    parts = _parts(spark, root, before)
    if not parts:
        return []
    cols = "slots int, slot int, bucket int, bits binary"
    filters = spark.read.schema(cols).parquet(*[f"{p}/filters" for p in parts]).select("*", F.col("_metadata.file_path").alias("path"))
    sizes = [r.slots for r in filters.select("slots").distinct().collect()]      # powers of two
    probes = keys.select(*[_hash(F.col("key"), i).alias(f"h{i}") for i in range(PROBES + 1)])
    probes = probes.select("*", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("slots")).withColumn(
        "slot", F.pmod(F.col("h0"), F.col("slots")).cast("int"))

    def is_set(i: int) -> Column:
        bit = F.pmod(F.col(f"h{i}"), F.lit(BITS)).cast("int")
        byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte.cast("long"), bit % 8) == 1

    met = probes.join(filters, ["slots", "slot"])
    for i in range(1, PROBES + 1):
        met = met.where(is_set(i))
    rows = met.select("path", "bucket").distinct().collect()     # follows the batch's keys
    return sorted({f"{r.path.rsplit('/filters/', 1)[0]}/keys/bucket={r.bucket}" for r in rows})


def _keys(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").schema("key string").parquet(*folders)


def known_keys(keys: DataFrame, root: str, before: int) -> DataFrame | None:
    """Stored keys of batches before ``before``, among them all of ``keys`` (one column) that are
    stored; None if no filter may hold one."""
    folders = may_hold(keys.toDF("key"), root, before)
    return _keys(keys.sparkSession, folders) if folders else None


def fold_index(spark: SparkSession, root: str) -> int:
    """Folds all batches but the last into one generation, so that filters stay few. Returns the manifest's version."""
    root = root.rstrip("/")
    version, upto, _ = manifest(spark, root)
    new = [n for n in numbered(spark, root, BATCH_COL) if n > upto][:-1]   # the last may still be replayed
    if not new:
        return version
    parts = _parts(spark, root, new[-1] + 1)
    keys = _keys(spark, [f"{p}/keys" for p in parts])
    folder = f"{root}_days/version={version + 1}-{uuid.uuid4().hex[:8]}"
    _add(keys, folder, keys.count())
    row = spark.createDataFrame([(new[-1], [folder])], "upto long, folders array<string>").coalesce(1)
    if not publish(row, f"{root}_manifest/version={version + 1}"):
        raise RuntimeError("another fold came first; its manifest holds")
    return version + 1
