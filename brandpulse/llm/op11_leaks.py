r"""Benchmark decontamination by a prefix-filtered set join.

Words are maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window is
``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. A
document word inside any occurrence of a window is hit.

1. Items give their windows, equal ones as one, and each window its shingles of ``SHINGLE`` words
   (the window itself if it is shorter).
2. One pass over the documents finds where the items' shingles stand. The tasks know them by a bitmap
   of fixed size, filled over Spark; what it lets through wrongly is dropped by later joins. What a
   task returns are runs: the words that such shingles cover, and the shingles.
3. Shingles are ordered by how often the documents hold them. A document that contains a window holds
   its rarest shingle, so that one alone is the necessary prefix: windows are joined with runs on it.
   A window with a shingle that no document holds is dropped at once.
4. The window must fit into the run (length) at the place where its rarest shingle puts it (position).
5. What fits is compared word by word over the window's whole length.

Equal texts are looked up as one. Everything that later steps read is written to the shared folder,
and joins are left to the planner.

A null, empty or wordless text has no words, no hits and the hash of the empty list; it is not
contaminated. Rows that repeat are rows of their own. Items of one item_id are one item, items
without item_id are one whose name is the empty text; null and wordless items match nothing. With an
empty benchmark no document is contaminated. Columns of any name may stand in the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brandpulse.llm.common import ROW, boxed, documents, unboxed, workers_import, written
from brandpulse.llm.words import Runs, chunks, runs, span_hashes, trim

WINDOW = 10
SHINGLE = 5
#: Bits of the bitmap that tells a task which shingles items have: 4 MB, whatever the items.
BITS = 25
#: Bytes of text that a task works on at once.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BLANK = np.ones(256, bool)
_BLANK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _split(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The lower-cased bytes, where words start and end, and the words before each text."""
    buf = _LOWER[buf]
    return buf, *runs(buf, at, _BLANK)


def _item_windows(size: int, width: int):
    """``item, body, shingles`` of every window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, raw, at in chunks(b.column(1), CHUNK):
                buf, starts, ends, before = _split(raw, at)
                every, text = Runs(span_hashes(buf, starts, ends)), buf.tobytes()
                words = [text[x:y].decode() for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                item, body, shingles = [], [], []
                for i in range(n):
                    a, z = int(before[i]), int(before[i + 1])
                    long = min(size, z - a)
                    for s in range(a, z - long + 1 if long else a):
                        w = min(width, long)
                        item.append(first + i)
                        body.append(" ".join(words[s:s + long]))
                        shingles.append(every.of(np.arange(s, s + long - w + 1), w).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(item, pa.int64())), pa.array(body, pa.string()),
                                                  pa.array(shingles, pa.list_(pa.int64()))], ["item", "body", "shingles"])
        trim()
    return run


_RUNS = "array<struct<at:int,words:array<string>,shingles:array<struct<i:int,g:bigint>>>>"


def _marks(bitmap: bytes, widths: list[int], carried: list[str]):
    """What is carried, ``k, size, n_words, runs`` of each text."""
    bits = np.frombuffer(bitmap, np.uint8)
    kind = pa.list_(pa.struct([("at", pa.int32()), ("words", pa.list_(pa.string())),
                               ("shingles", pa.list_(pa.struct([("i", pa.int32()), ("g", pa.int64())])))]))

    def found(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> list[tuple]:
        """(word, width, shingle) of all that the bitmap lets through, by word."""
        every = Runs(span_hashes(buf, starts, ends))
        left = np.repeat(before[1:], np.diff(before)) - np.arange(len(starts))
        out = []
        for w in widths:
            p = np.flatnonzero(left >= w)
            g = every.of(p, w)
            bit = (g & np.uint64((1 << BITS) - 1)).astype(np.int64)
            hit = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            out += zip(p[hit].tolist(), [w] * int(hit.sum()), g[hit].view(np.int64).tolist(), strict=True)
        return sorted(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, raw, at in chunks(b.column(b.num_columns - 1), CHUNK):
                buf, starts, ends, before = _split(raw, at)
                of: list[list[dict]] = [[] for _ in range(n)]
                text, end, doc = buf.tobytes(), -1, -1
                for p, w, g in found(buf, starts, ends, before):
                    d = int(np.searchsorted(before, p, "right")) - 1
                    if d != doc or p > end:  # else it overlaps the run before, or follows at once
                        of[d].append({"at": p - int(before[d]), "words": [], "shingles": []})
                        doc, end = d, p
                    last = of[d][-1]
                    last["words"] += [text[starts[x]:ends[x]].decode() for x in range(end, p + w)]
                    last["shingles"].append({"i": p - int(before[d]) - last["at"], "g": g})
                    end = max(end, p + w)
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(first, n) for i in range(b.num_columns - 1)],
                                                  pa.array(np.diff(before), pa.int64()), pa.array(of, kind)],
                                                 [*carried, "n_words", "runs"])
        trim()
    return run


def _bitmap(grams: DataFrame) -> bytes:
    """Bits of all shingles, in pieces of 4 KB that Spark fills; bounded by ``BITS``."""
    bit = F.col("g").bitwiseAND((1 << BITS) - 1)
    rows = grams.groupBy(F.bitmap_bucket_number(bit + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("bits")).collect()  # 1,024 rows at most
    out = bytearray(1 << (BITS - 3))
    for r in rows:
        out[(r.bucket - 1) * len(r.bits):r.bucket * len(r.bits)] = r.bits
    return bytes(out)


def _covered(spans: Column) -> Column:
    """Words that spans (sorted) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["start"] + x["size"] - F.greatest(s["end"], x["start"]), F.lit(0))).alias("n"),
        F.greatest(s["end"], x["start"] + x["size"]).alias("end")), lambda s: s["n"])


def screened(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` (all) of ``docs``, with ``n_words``, ``n_hit``, ``spans`` (``start, size``
    in words of each occurrence of a window, by place) and ``items`` (their item_ids as sorted
    strings) of each row; input columns of those names are replaced."""
    spark = docs.sparkSession
    workers_import(spark)
    keep = docs.columns if keep is None else keep
    src = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    windows = written(src.mapInArrow(_item_windows(window, shingle), "item string, body string, shingles array<long>"), "leaks-windows")
    bodies = written(windows.groupBy("body").agg(F.first("shingles").alias("shingles")), "leaks-bodies")
    size = F.size(F.split("body", " "))
    grams = written(bodies.select("body", size.alias("size"), F.size("shingles").alias("of"), F.posexplode("shingles").alias("i", "g")), "leaks-grams")
    widths = sorted(r[0] for r in grams.select(F.least("size", F.lit(shingle))).distinct().collect())  # at most as many as a shingle has words
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias(ROW), text.alias("text"))
    keyed = keyed.select(ROW, F.xxhash64("text").alias("k"), F.octet_length("text").cast("long").alias("size"), "text")
    carried = keyed.drop("text")
    schema = T.StructType(list(carried.schema.fields)).add("n_words", "long").add("runs", T.DataType.fromDDL(_RUNS))
    marks = written(keyed.mapInArrow(_marks(_bitmap(grams), widths, carried.columns), schema), "leaks-marks")
    found = marks.where(F.size("runs") > 0).select("k", "size", "runs").dropDuplicates(["k", "size"])
    pieces = written(found.select("k", "size", F.posexplode("runs").alias("r", "run")).select("k", "size", "r", "run.*"), "leaks-runs")
    places = pieces.select("k", "size", "r", F.size("words").alias("n"), F.explode("shingles").alias("x")).select(
        "k", "size", "r", "n", F.col("x.i").alias("p"), F.col("x.g").alias("g"))
    often = written(places.join(grams.select("g").distinct(), "g", "left_semi").groupBy("g").agg(F.count("*").alias("d")), "leaks-often")
    prefix = grams.withColumnRenamed("size", "long").join(often, "g").groupBy("body", "long", "of").agg(
        F.count("*").alias("held"), F.min_by(F.struct("g", "i"), F.struct("d", "g", "i")).alias("p")).where("held = of").select(
        "body", "long", F.col("p.g").alias("g"), F.col("p.i").alias("i"))
    fits = places.join(written(prefix, "leaks-prefix"), "g").withColumn("start", F.col("p") - F.col("i")).where("start >= 0 and start + long <= n")
    maybe = fits.groupBy("k", "size", "r").agg(F.collect_set(F.struct("start", "long", "body")).alias("maybe"))
    same = F.filter("maybe", lambda x: F.array_join(F.slice("words", x["start"] + 1, x["long"]), " ") == x["body"])
    hits = written(pieces.join(maybe, ["k", "size", "r"]).select("k", "size", "at", F.explode(same).alias("x")).select(
        "k", "size", (F.col("at") + F.col("x.start")).alias("start"), F.col("x.long").alias("long"), F.col("x.body").alias("body")), "leaks-hits")
    spans = hits.groupBy("k", "size").agg(F.sort_array(F.collect_set(F.struct("start", F.col("long").alias("size")))).alias("spans"))
    names = hits.select("k", "size", "body").distinct().join(windows.select("body", "item").distinct(), "body").groupBy("k", "size").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    known = written(spans.join(names, ["k", "size"]), "leaks-found")
    none = F.array().cast("array<struct<start:int,size:int>>")
    out = marks.select(ROW, "k", "size", "n_words").join(known, ["k", "size"], "left").select(
        ROW, "n_words", _covered(F.coalesce("spans", none)).alias("n_hit"), F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return unboxed(out, keep, "n_words", "n_hit", "spans", "items")


def kept_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that no window of an item occurs in."""
    t = screened(boxed(docs, "text"), benchmark, window=window).where("n_hit = 0")
    return t.select(*[F.col(ROW).getField(c).alias(c) for c in docs.columns])


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    t = screened(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    return t.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
il AS (SELECT *, least(len(ws), 10) AS l FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, l, body FROM (
  SELECT item_id, l, unnest(list_transform(range(1, len(ws) - l + 2), lambda k: array_to_string(ws[k:k + l - 1], ' '))) AS body FROM il)),
ls AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT doc_id, l, unnest(range(1, len(ws) - l + 2)) AS p,
              unnest(list_transform(range(1, len(ws) - l + 2), lambda k: array_to_string(ws[k:k + l - 1], ' '))) AS body
       FROM d, ls WHERE len(ws) >= l),
f AS (SELECT dw.doc_id, dw.p, dw.l, iw.item_id FROM dw JOIN iw ON dw.l = iw.l AND dw.body = iw.body),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM f) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM f) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(n.n, 0)::BIGINT AS n_items,
       sha256(coalesce(n.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
