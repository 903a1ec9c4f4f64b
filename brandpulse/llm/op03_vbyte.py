"""Token ids on disk: frequency-ranked, byte-aligned variable-length codes.

Ids are replaced by their rank in the corpus (most frequent: 0). A rank takes one to four
bytes; its length less one is two bits of a control byte, four ranks to a byte, and control
bytes stand apart from data bytes. The decoder looks the control bytes up in a 256 x 4 table of
lengths, gathers the data bytes by the running sum of lengths, and looks ranks up in the id
table. The files are Parquet folders ``part=N`` of blocks, ``part`` and ``first`` ascending with
the key, each block with the keys and counts of its rows, so Spark commits, lists and rereads
them on any file system.

Texts move once (a range shuffle on the key), the ids are kept once between counting and
coding, and the driver sees one row per vocabulary entry that occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import documents, shared_dir, written
from brandpulse.llm.ordering import ordered_path, with_prefix_sum
from brandpulse.llm.tokens import END, encoded, tokenizer_path

#: Ids in a block, but for single rows of more.
BLOCK = 1 << 18
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    r = np.ascontiguousarray(ranks, "<u4")
    code = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    four = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    four[:len(r)] = code
    control = four.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    keep = np.arange(4) <= code[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lens = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    at = np.cumsum(lens) - lens
    out = raw[at]
    for k in (1, 2, 3):
        out |= np.where(lens > k, raw[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenize(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, ids in encoded(b, path, end=end):
                part = b.slice(first, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype("<u4" if x.max(initial=0) > 0xFFFF else "<u2").tobytes() for x in ids], pa.binary()),
                     pa.array([int(x.max(initial=0)) > 0xFFFF for x in ids])], ["key", "ids", "wide"])
    return run


def _ids(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if wide else "<u2").astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per id that a task has seen."""
    total = np.zeros(0, np.int64)
    for b in batches:
        rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        n = np.bincount(np.concatenate([_ids(raw, wide) for raw, wide in rows]), minlength=len(total))
        n[:len(total)] += total
        total = n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])


def _blocks(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out():
            ids = np.concatenate([x[3] for x in held])
            control, data = encode_ranks(rank[ids])
            row = [held[0][1], held[0][2], [x[0] for x in held], [len(x[3]) for x in held], control, data]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], _NAMES)

        for b in batches:
            for key, pid, at, raw, wide in zip(*[c.to_pylist() for c in b.columns], strict=True):
                ids = _ids(raw, wide)
                if held and (size + len(ids) > BLOCK or pid != held[-1][1] or at != held[-1][2] + 1):
                    yield out()
                    held, size = [], 0
                held.append((key, pid, at, ids))
                size += len(ids)
        if held:
            yield out()
    return run


_NAMES = ["part", "first", "keys", "counts", "control", "data"]
_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
_BLOCK_DDL = "part int, first long, keys array<long>, counts array<long>, control binary, data binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END) -> np.ndarray:
    """Encodes the texts and writes them under ``path`` in ascending key; returns the id table.

    Null texts are empty and carry the end id alone; rows of equal key keep one order; null
    keys come first. An empty table writes no block.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kept = ordered_path(src, ["key"], shared_dir(spark, "vbyte-ids"), "zstd",
                        lambda d: d.mapInArrow(_tokenize(tokenizer, end), "key long, ids binary, wide boolean"))
    rows = kept.select("ids", "wide").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    table = np.array([r.id for r in rows.orderBy(F.desc("n"), "id").collect()], np.uint32)  # the vocabulary at most
    rank = np.zeros(int(table.max(initial=0)) + 1, np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    blocks = kept.select("key", "_pid", "_row", "ids", "wide").mapInArrow(_blocks(rank), _BLOCK_DDL)
    blocks.write.option("compression", "zstd").partitionBy("part").parquet(path)
    return table


def read_ids(spark, path: str, table: np.ndarray) -> DataFrame:
    """``key, part, row, ids`` (unsigned 32-bit little-endian bytes) from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                n = sum(row["counts"])
                ids = table[decode_ranks(row["control"], row["data"], n)].astype("<u4")
                ends = np.cumsum(row["counts"])
                k = len(row["keys"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["keys"], pa.int64()), pa.array([row["part"]] * k, pa.int32()),
                     pa.array(range(row["first"], row["first"] + k), pa.int64()),
                     pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary())], ["key", "part", "row", "ids"])

    return spark.read.schema(_BLOCK_DDL).parquet(path).mapInArrow(run, "key long, part int, row long, ids binary")


def op3_token_output(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    table = write_ids(documents(spark, sf_dir), path, tokenizer_path())
    back = read_ids(spark, path, table)
    rows = back.select(F.col("key").alias("doc_id"), F.col("part").alias("_pid"), F.col("row").alias("_row"),
                       F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return with_prefix_sum(written(rows, "op3-read"), "n_tokens", "start").select("doc_id", "start", "n_tokens", "ids_crc32")
