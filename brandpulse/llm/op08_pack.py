"""Packing token sequences by the configuration linear program.

The unknowns are how often each pattern (a multiset of piece lengths that fits a sequence) is
used; every length must be covered as often as it occurs. The program knows the corpus only
through its histogram of lengths, so its size is bounded by the sequence length. It is solved by
multiplicative weights: a length's price falls with the share of its demand that is covered, and
a knapsack dynamic program prices the best pattern. Multiplicities are rounded down, the largest
first, and the program is solved again for what is left, while that places much of it. The rest,
of which there are too few pieces for a fractional solution to say anything, is filled by the same
pricing with each length's remaining count as its bound, a pattern being used until a
length of it runs out.

The plan says, per length, which ranks go to which sequences and places. Ranks come from one
range sort of the narrow rows; tasks look their rows up in the plan. Texts and ids never move.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, boxed, documents, unboxed, workers_import, written
from brandpulse.llm.ordering import ordered, with_position
from brandpulse.llm.tokens import END, encoded, tokenizer_path

CAPACITY = 1024
#: Pricing rounds, how fast a covered length loses value, and the exponent of a length's first price
#: (over 1, so that long lengths, which are hard to place, go first).
ROUNDS, STEP, POWER = 256, 0.5, 1.2
#: The program is solved again while rounding places at least this share of what was open.
AGAIN = 0.1
_RANKS = 40


def best_pattern(value: np.ndarray, bound: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length 0..capacity stands in the pattern of most value; ``bound`` caps it."""
    lengths, takes = [], []
    for n in np.flatnonzero(bound > 0):
        left, k = min(int(bound[n]), capacity // int(n)), 1
        while left > 0:
            lengths.append(int(n) * min(k, left))
            takes.append((int(n), min(k, left)))
            left -= k
            k *= 2
    best = np.zeros(capacity + 1)
    better = np.zeros((len(lengths), capacity + 1), bool)
    for i, (size, (n, k)) in enumerate(zip(lengths, takes, strict=True)):
        new = best[:-size] + value[n] * k if size <= capacity else best[:0]
        better[i, size:] = new > best[size:] + 1e-12
        best[size:] = np.maximum(best[size:], new)
    pattern, room = np.zeros(capacity + 1, np.int64), capacity
    for i in range(len(lengths) - 1, -1, -1):
        if better[i, room]:
            pattern[takes[i][0]] += takes[i][1]
            room -= lengths[i]
    return pattern


def _bounded(left: np.ndarray, capacity: int) -> np.ndarray:
    return np.minimum(left, capacity // np.maximum(np.arange(capacity + 1), 1))


def patterns(histogram: np.ndarray, rounds: int = ROUNDS) -> list[tuple[int, np.ndarray]]:
    """(times, pattern) that together hold every piece of the histogram (by length) once."""
    capacity = len(histogram) - 1
    need = histogram.astype(np.int64).copy()
    out: list[tuple[int, np.ndarray]] = []
    if need[capacity]:  # a piece that fills a sequence stands alone
        full = np.zeros(capacity + 1, np.int64)
        full[capacity] = 1
        out.append((int(need[capacity]), full))
        need[capacity] = 0
    value = (np.arange(capacity + 1) / capacity) ** POWER
    open_ = int(need.sum())
    while need.any():
        for times, pattern in _solved(need, value, rounds):
            at = np.flatnonzero(pattern)
            whole = min(int(times), int((need[at] // pattern[at]).min()))
            if whole > 0:
                need -= whole * pattern
                out.append((whole, pattern))
        left = int(need.sum())
        if open_ - left < AGAIN * open_:
            break
        open_ = left
    while need.any():  # every turn uses up a length, or lowers its bound
        pattern = best_pattern(value, _bounded(need, capacity), capacity)
        at = np.flatnonzero(pattern)
        times = int((need[at] // pattern[at]).min())
        need -= times * pattern
        out.append((times, pattern))
    return out


def _solved(need: np.ndarray, value: np.ndarray, rounds: int) -> list[tuple[float, np.ndarray]]:
    """(times, pattern) of the program's fractional solution for ``need``, most used first."""
    capacity = len(need) - 1
    covered = np.zeros(capacity + 1)
    used: dict[bytes, list] = {}
    for _ in range(min(rounds, 2 * int((need > 0).sum()))):
        pattern = best_pattern(value * np.exp(-STEP * covered), _bounded(need, capacity), capacity)
        at = np.flatnonzero(pattern)
        share = (pattern[at] / need[at]).max()
        covered[at] += pattern[at] / need[at] / share
        used.setdefault(pattern.tobytes(), [0.0, pattern])[0] += 1 / share
    level = max(covered[need > 0].max(), 1.0)  # no length is covered more than once at this scale
    return sorted(((times / level, pattern) for times, pattern in used.values()), key=lambda x: -x[0])


def plan(histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per stretch of ranks of one length, sorted: (length << 40) + first rank, its first
    sequence, and its place there. Sequences of a stretch follow its ranks one by one."""
    rank = np.zeros(len(histogram), np.int64)
    rows, sequence = [], 0
    for times, pattern in patterns(histogram):
        offset = 0
        for n in np.flatnonzero(pattern)[::-1]:
            for _ in range(int(pattern[n])):
                rows.append((int(n) << _RANKS | int(rank[n]), sequence, offset))
                rank[n] += times
                offset += int(n)
        sequence += times
    rows.sort()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in range(3))


def pack(pieces: DataFrame, key: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Rows of equal key are pieces of their own. An empty table stays empty; a length outside the
    range is an error. The driver sees one row per length; the plan that tasks get has a few
    rows per pattern, and patterns are bounded by rounds and capacity.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).where(
        F.when(F.col("length").between(1, capacity), True).otherwise(F.raise_error(F.lit("length out of range"))))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counted.collect():  # capacity rows at most
        histogram[r.length] = r.n
    sent = spark.sparkContext.broadcast(plan(histogram))
    first = np.cumsum(histogram) - histogram
    keyed = boxed(pieces, F.col("length"), *[F.col(c).alias(f"_key{i}") for i, c in enumerate(key)])
    t = with_position(ordered(keyed, [F.col("length"), *[F.col(f"_key{i}") for i in range(len(key))]], "pack-order"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sequences, offsets = sent.value
        for b in batches:
            n = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("_pos")).to_numpy() - first[n]
            code = n.astype(np.int64) << _RANKS | rank
            at = np.searchsorted(starts, code, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sequences[at] + code - starts[at]), pa.array(offsets[at])],
                                             [ROW, "sequence_id", "offset"])

    schema = keyed.select(ROW).schema.add("sequence_id", "long").add("offset", "long")
    return unboxed(t.select(ROW, "length", "_pos").mapInArrow(place, schema), pieces.columns, "sequence_id", "offset")


def cut(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END,
        capacity: int = CAPACITY) -> DataFrame:
    """The token pieces of every text: ``key, piece, start, length, ids_crc32, ids``.

    Texts over ``capacity`` tokens are cut; the first piece takes the remainder. A null text is
    empty and has the end id alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            for first, ids in encoded(b, tokenizer, end=end):
                rows: list[tuple] = []
                for i, x in enumerate(ids):
                    x = x.astype("<u4")
                    at, n, k = 0, (len(x) - 1) % capacity + 1, 0
                    while at < len(x):
                        raw = x[at:at + n].tobytes()
                        rows.append((first + i, k, at, n, zlib.crc32(raw), raw))
                        at, n, k = at + n, capacity, k + 1
                col = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(col[0])), pa.array(col[1], pa.int32()), *[pa.array(c, pa.int64()) for c in col[2:5]],
                     pa.array(col[5], pa.binary())], ["key", "piece", "start", "length", "ids_crc32", "ids"])

    workers_import(docs.sparkSession)
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long, ids binary")


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Where every piece of ``docs`` goes, without the ids; one row per piece."""
    pieces = written(cut(docs, tokenizer).drop("ids").withColumnRenamed("key", "doc_id"), "pack-pieces")
    return pack(pieces, ["doc_id", "piece"])


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
