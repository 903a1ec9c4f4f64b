"""N-gram Jaccard self-join by adaptive multi-match prefixes.

A document's set is its distinct five-word shingles (64-bit hashes); documents of equal sets are
one class. All sets are ordered by how many classes hold a shingle, rarest first. Two sets that
link share at least ``shared(n, m)`` shingles, so the first one they share stands early in both
(else too little is left behind it), and their prefixes of ``n - ceil(s * n) + l`` shingles share
``l`` or more.

1. One pass over the texts gives sizes and class keys.
2. A second pass emits every class's shingles (48 bits of the hash), packed per bucket of hashes,
   each class once per flush. A bucket's task counts the classes of each shingle and returns only
   what two classes share, with the count, packed per group of classes. Buckets hold a bounded number of shingles; a shingle
   that very many classes of one flush hold is dealt by class as well, counts as the most frequent
   of all, and leaves a mark in its own bucket, so that all its holders order it alike.
3. What a class shares comes together by class. Shingles that no other class has come first in its
   order, so most classes end here: their prefix holds nothing that is shared.
4. Each remaining class chooses its prefix by estimated cost: a longer one is more to move for
   every candidate, but asks for more shared shingles, and so spares whole sets of candidates that
   share only a passage.
5. For each shared shingle, the class that holds it earliest is the pivot and is paired with the
   others. What links joins a component. Then classes of different components are paired, wherever a
   shingle can be the first one of a link. So a group of near copies takes pairs in
   proportion to its size, and no link between different texts is lost.
6. A pair's prefixes must share as many shingles as their lengths ask for; those that do are verified
   on whole sets.

Pairs are never expanded within a class or a component. Everything that later steps read is written
to the shared folder. Joins are left to the planner, which knows the sizes of written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, boxed, documents, unboxed, workers_import, written
from brandpulse.llm.words import chunks, mix, runs, span_hashes, trim

SHINGLE = 5
PERCENT = 75
#: Shares of a set by which its prefix may be longer than for one match.
RATIOS = (0.0, 1 / 16, 1 / 8, 1 / 4)
#: Verifying one shingle of a whole set costs as much as moving so many of a prefix.
VERIFY_COST = 2.0
#: Shingles that a task packs at once, and that a bucket holds on average.
HELD = 1_000_000
BUCKET = 2_000_000
#: Shingles of all classes that are brought together by class in one task, on average.
GROUP = 5_000_000
#: A shingle of more than so many classes of one flush is dealt by class too.
HOT = 256
#: Bytes of text that a task works on at once.
CHUNK = 1 << 20
#: Bits of a shingle's hash that are kept; counts stand above them.
BITS = 48
_MOST = (1 << (64 - BITS)) - 1
_LOW = np.uint64((1 << BITS) - 1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_sets(col: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Chunks of texts: the first row, and each text's sorted distinct shingle hashes."""
    for first, n, buf, at in chunks(col, CHUNK):
        buf = _LOWER[buf]
        starts, ends, before = runs(buf, at)
        h = span_hashes(buf, starts, ends)
        m = len(h)
        acc, after = np.zeros(m, np.uint64), np.concatenate([h, np.zeros(width, np.uint64)])
        for j in range(width):  # past a text's end the values are not used
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + after[j:j + m])
        out = []
        for i in range(n):
            a, b = int(before[i]), int(before[i + 1])
            if b - a >= width:
                out.append(np.unique(acc[a:b - width + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for x in h[a:b]:
                    short = mix(np.array([short], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        yield first, out


def class_key(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that stand for a set."""
    with np.errstate(over="ignore"):
        n = np.uint64(len(s))
        a = mix(np.array([s.sum(dtype=np.uint64) + n], np.uint64)).view(np.int64)[0]
        b = mix(np.array([np.bitwise_xor.reduce(mix(s)) ^ n if len(s) else n], np.uint64)).view(np.int64)[0]
    return int(a), int(b)


def _meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, sets in shingle_sets(b.column(1)):
            keys = [class_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(first, len(sets)), b.column(2).slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
                ["doc_id", "t", "n", "c", "c2"])
    trim()


def overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def shared(n, m, percent: int):
    """Shingles that sets of n and m share at least if they link."""
    return -(-(n + m) * percent // (100 + percent))


def matches(n, m, rest_n, rest_m, percent: int):
    """Shared prefix shingles of two sets that link, at least. What they share lies in both
    prefixes, or behind the prefix that ends first."""
    return shared(n, m, percent) - np.maximum(rest_n, rest_m)


# ------------------------------------------------------------------------------ shared shingles
def _packed(x: np.ndarray) -> bytes:
    """An array's bytes, those of equal weight together, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return bytes([x.itemsize]) + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    size = raw[0]
    flat = np.frombuffer(pa.decompress(raw[1:], n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(f"<u{size}").ravel()


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _blocks(sets: list[np.ndarray], keys: np.ndarray, buckets: int) -> Iterator[tuple]:
    """``bucket, hot, n, tokens, own, classes, sizes`` of one flush. A class of size 0 marks the
    hot shingles in their own buckets."""
    sizes = np.array([len(s) for s in sets] + [0], np.uint32)
    keys = np.append(keys, np.int64(0))
    own = np.repeat(np.arange(len(sets), dtype=np.int64), sizes[:-1])
    tokens = np.concatenate(sets) >> np.uint64(64 - BITS)
    order = np.argsort(tokens, kind="stable")
    tokens, own = tokens[order], own[order]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    times = np.diff(np.append(first, len(tokens)))
    often = np.repeat(times > HOT, times)
    marks = tokens[first[times > HOT]]
    plain, of = np.append(tokens[~often], marks), np.append(own[~often], np.full(len(marks), len(sets)))
    order = np.argsort(plain, kind="stable")
    scale = np.uint64(buckets)

    def dealt(hot, tok, of, bucket):
        cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some, back = np.unique(of[a:b], return_inverse=True)
            yield (int(bucket[a]), hot, int(b - a), _packed(_narrow(np.diff(tok[a:b], prepend=np.uint64(0)))), _packed(_narrow(back.astype(np.uint64))),
                   keys[some].tobytes(), _packed(sizes[some]))

    plain, of = plain[order], of[order]
    yield from dealt(False, plain, of, (plain >> np.uint64(BITS - 32)) * scale >> np.uint64(32))
    tok, of = tokens[often], own[often]
    bucket = (mix(tok ^ keys[of].view(np.uint64)) >> np.uint64(32)) * scale >> np.uint64(32)
    order = np.lexsort((tok, bucket))
    yield from dealt(True, tok[order], of[order], bucket[order])


_BLOCK = "bucket int, hot boolean, n int, tokens binary, own binary, classes binary, sizes binary"


def _emit(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        keys: list[int] = []
        size = 0

        def out():
            col = list(zip(*_blocks(held, np.array(keys, np.int64), buckets), strict=True))
            types = [pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(col, types, strict=True)], [x.split()[0] for x in _BLOCK.split(", ")])

        for b in batches:
            for _, sets in shingle_sets(b.column(0)):
                for s in sets:
                    key = class_key(s)[0]
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    held.append(s)
                    keys.append(key)
                    size += len(s)
                    if size > HELD:
                        yield out()
                        held, keys, size = [], [], 0
        if held:
            yield out()
        trim()
    return run


_SHARED = "of int, c binary, n binary, m binary, x binary"


def _shared(groups: int):
    def run(t: pa.Table) -> pa.Table:
        return _by_group(*_counted(t), groups)
    return run


def _by_group(c: np.ndarray, n: np.ndarray, m: np.ndarray, x: np.ndarray, groups: int) -> pa.Table:
    """A row per group of classes: the classes, their sizes, how many shingles each has, and these."""
    of = (mix(c.view(np.uint64)) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
    ends = np.cumsum(m)
    rows = []
    for g in np.unique(of).tolist():
        some = np.flatnonzero(of == g)
        rows.append((g, c[some].tobytes(), n[some].astype(np.uint32).tobytes(), m[some].astype(np.uint32).tobytes(),
                     np.concatenate([x[a:b] for a, b in zip((ends - m)[some].tolist(), ends[some].tolist(), strict=True)]).tobytes()))
    col = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table([pa.array(v, k) for v, k in zip(col, [pa.int32(), *[pa.binary()] * 4], strict=True)], [y.split()[0] for y in _SHARED.split(", ")])


def _counted(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Of a bucket: the classes, their sizes, how many shingles each shares with another class, and
    these with the number of their classes above them."""
    rows = list(zip(*[t.column(c).to_pylist() for c in ("hot", "n", "tokens", "own", "classes", "sizes")], strict=True))
    of, n = [], []
    for _, _, _, _, k, z in rows:
        of.append(np.frombuffer(k, np.int64))
        n.append(_unpacked(z, len(of[-1])))
    sizes = np.concatenate(n)
    classes, first, back = np.unique(np.concatenate(of), return_index=True, return_inverse=True)
    sizes = sizes[first].astype(np.int64)
    upto = np.cumsum([len(x) for x in of])
    found_c, found_x = [], []
    for hot in (False, True):
        tok, cls = [], []
        for (is_hot, m, d, o, _, _), end, k in zip(rows, upto, of, strict=True):
            if is_hot == hot:
                tok.append(np.cumsum(_unpacked(d, m).astype(np.uint64), dtype=np.uint64))
                cls.append(back[end - len(k):end][_unpacked(o, m)].astype(np.int32))
        if not tok:
            continue
        tok, cls = np.concatenate(tok), np.concatenate(cls)
        order = np.argsort(tok, kind="stable")
        tok, cls = tok[order], cls[order]
        if not hot:
            same = tok[1:] == tok[:-1]
            keep = np.append(same, False) | np.append(False, same)
            tok, cls = tok[keep], cls[keep]
        order = np.lexsort((cls, tok))
        tok, cls = tok[order], cls[order]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
        tok, cls = tok[new], cls[new]
        first = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])) if len(tok) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(tok)))
        if hot:
            count = np.full(len(tok), _MOST)
        else:
            marked = np.logical_or.reduceat(sizes[cls] == 0, first) if len(tok) else np.zeros(0, bool)
            count = np.repeat(np.where(marked, _MOST, np.minimum(times, _MOST - 1)), times)
        keep = (count > 1) & (sizes[cls] > 0)
        found_c.append(cls[keep])
        found_x.append(tok[keep] | count[keep].astype(np.uint64) << np.uint64(BITS))
    cls, x = np.concatenate(found_c), np.concatenate(found_x)
    order = np.argsort(cls, kind="stable")
    cls, x = cls[order], x[order]
    cuts = np.flatnonzero(np.diff(cls, prepend=-1))
    trim()
    return classes[cls[cuts]], sizes[cls[cuts]], np.diff(np.append(cuts, len(cls))), x


# ------------------------------------------------------------------------------ prefixes
def extra(n: int, low: int, alone: int, counts: np.ndarray) -> int:
    """By how much the prefix of a set is longer than for one match, by estimated cost. ``counts``:
    how many classes have each shared shingle, in order; ``alone`` shingles come before these.

    A candidate is a class met at a prefix shingle. Of those, at most one in ``l`` shares ``l`` of
    them; for these the whole set is verified, for all the prefix is moved."""
    met = np.cumsum(counts.astype(np.float64) - 1)
    best, cost = 0, None
    near = met[max(n - low + 1 - alone, 1) - 1]  # candidates come from the prefix for one match
    for ratio in RATIOS:
        more = min(int(n * ratio), low - 1)
        length = n - low + 1 + more
        pairs = met[max(length - alone, 1) - 1]
        c = near * length + VERIFY_COST * n * min(near, pairs / (1 + more))
        if cost is None or c < cost:
            best, cost = more, c
    return best


_ALIVE = "c long, n long, rest long, alone long, head binary, first array<long>, whole binary"


def _prefixes(percent: int):
    """:data:`_ALIVE` of the classes of a group whose prefix holds something shared: ``rest`` shingles
    stand behind the prefix ``head``, ``alone`` before all that is shared, ``first`` are those that
    can be the first shingle of a link, ``whole`` all that is shared."""
    def run(t: pa.Table) -> pa.Table:
        c, n, m, x = [np.frombuffer(b"".join(t.column(i).to_pylist()), k) for i, k in ((1, np.int64), (2, np.uint32), (3, np.uint32), (4, np.uint64))]
        names, first, back = np.unique(c, return_index=True, return_inverse=True)
        sizes, cls = n[first].astype(np.int64), np.repeat(back, m)
        # a set must share what any link of it asks for
        may = np.bincount(cls, minlength=len(names)) * 100 >= sizes * percent
        cls, x = cls[may[cls]], x[may[cls]]
        order = np.lexsort((x, cls))
        cls, x = cls[order], x[order]
        cuts = np.flatnonzero(np.diff(cls, prepend=-1, append=-1)) if len(cls) else np.zeros(1, np.int64)
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            size, own = int(sizes[cls[a]]), np.unique(x[a:b])  # copies of a class in several flushes
            low, alone = overlap(size, percent), size - len(own)
            if alone > size - low:
                continue
            more = extra(size, low, alone, own >> np.uint64(BITS))
            rows.append((int(names[cls[a]]), size, low - 1 - more, alone, own[:size - low + 1 + more - alone].tobytes(),
                         own[:size - low + 1 - alone].view(np.int64), own.tobytes()))
        col = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
        out = pa.table([pa.array(v, k) for v, k in zip(col, types, strict=True)], [y.split()[0] for y in _ALIVE.split(", ")])
        trim()
        return out
    return run


def _sets(col: pa.Array) -> list[np.ndarray]:
    """Views of the sets in a binary column."""
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)
    return [data[a:b].view(np.uint64) if a % 8 == 0 else np.frombuffer(data[a:b].tobytes(), np.uint64) for a, b in zip(at[:-1], at[1:], strict=True)]


def _both(p: np.ndarray, q: np.ndarray) -> int:
    small, large = (p, q) if len(p) <= len(q) else (q, p)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _enough(percent: int, whole: bool):
    """Keeps pairs whose prefixes share what their lengths ask for, or whose whole sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = [b.column(i).to_pylist() for i in range(2, 6)]
            keep = []
            for p, q, n, m, rn, rm in zip(_sets(b.column(6)), _sets(b.column(7)), *facts, strict=True):
                both = _both(p, q)
                keep.append(100 * both >= percent * (n + m - both) if whole else both >= matches(n, m, rn, rm, percent))
            k = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(k), b.column(1).filter(k)], ["a", "b"])
        trim()
    return run


def verified(pairs: DataFrame, alive: DataFrame, percent: int, name: str) -> DataFrame:
    """The (a, b) of ``pairs`` that link."""
    def step(rows: DataFrame, what: str) -> DataFrame:
        def of(c: str) -> DataFrame:
            return alive.select(F.col("c").alias(c), F.col("n").alias(f"n{c}"), F.col("rest").alias(f"r{c}"), F.col(what).alias(f"x{c}"))
        both = rows.select("a", "b").join(of("b"), "b").join(of("a"), "a").select("a", "b", "na", "nb", "ra", "rb", "xa", "xb")
        return written(both.mapInArrow(_enough(percent, what == "whole"), "a long, b long"), name)

    return step(step(pairs, "head"), "whole")


def components(edges: DataFrame, name: str) -> DataFrame:
    """``c, k``: the smallest node that each node of an edge is connected to. Labels spread along edges and
    along labels (pointer jumping), so rounds grow with the logarithm of a component's width."""
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct(), name)
    labels = written(both.select(F.col("u").alias("c"), F.col("u").alias("k")).distinct(), name)
    while True:
        near = both.join(labels.select(F.col("c").alias("v"), "k"), "v").groupBy("u").agg(F.min("k").alias("m"))
        low = labels.join(near.withColumnRenamed("u", "c"), "c", "left").select(
            "c", F.col("k").alias("was"), F.least("k", "m").alias("k"))
        jump = labels.select(F.col("c").alias("k"), F.col("k").alias("m"))
        new = written(low.join(jump, "k").select("c", "was", F.least("k", "m").alias("k")), name)
        done = new.where("k <> was").isEmpty()
        labels = new.select("c", "k")
        if done:
            return labels


def _can_link(percent: int) -> Column:
    """Whether a shingle at places i and j of sets of n and m can be the first they share."""
    least = F.expr(f"((n + m) * {percent} + {99 + percent}) div {100 + percent}")
    return (F.col("n") - F.col("i") >= least) & (F.col("m") - F.col("j") >= least)


def pivot_pairs(firsts: DataFrame, percent: int) -> DataFrame:
    """Of each shingle, the class that holds it earliest with each other class."""
    pivot = firsts.groupBy("token").agg(F.min_by(F.struct("c", "n", "i"), F.struct(F.col("i") / F.col("n"), F.col("c"))).alias("p"),
                                        F.count("*").alias("d")).where("d > 1")
    met = firsts.join(pivot, "token").where("c <> p.c").withColumns({"m": F.col("p.n"), "j": F.col("p.i")})
    return met.where(_can_link(percent)).select(F.col("p.c").alias("a"), F.col("c").alias("b")).distinct()


def crossing_pairs(firsts: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components (``label``: of classes that have others) that
    share a shingle where it can be the first of a link. One of the two is no larger than the
    other, and holds it as early as a link with a set of its own size asks for."""
    named = firsts.join(label, "c", "left").withColumn("k", F.coalesce("k", "c"))
    named = written(named, "jaccard-named")
    open_ = named.groupBy("token").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("token")
    rows = written(named.join(open_, "token"), "jaccard-open")
    early = F.col("n") - F.col("i") >= F.expr(f"(2 * n * {percent} + {99 + percent}) div {100 + percent}")
    x = rows.where(early).select("token", F.col("c").alias("a"), F.col("k").alias("ka"), "n", "i")
    y = rows.select("token", F.col("c").alias("b"), F.col("k").alias("kb"), F.col("n").alias("m"), F.col("i").alias("j"))
    return x.join(y, "token").where((F.col("ka") != F.col("kb")) & ((F.col("n") < F.col("m")) | (F.col("n") == F.col("m")) & (F.col("a") < F.col("b")))
                                    & _can_link(percent)).select("a", "b").distinct()


def text_key() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def classes(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, t, n, c, c2`` per document, ``c, c2, n, first, k`` per class): ``t`` is
    :func:`text_key`, ``first`` the smallest doc_id of a class; classes of one component have one
    ``k``."""
    workers_import(docs.sparkSession)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key().alias("t"))
    meta = written(src.mapInArrow(_meta, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, t long, n long, c long, c2 long"), "jaccard-meta")
    kinds = written(meta.groupBy("c", "c2", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "jaccard-classes")
    total = kinds.agg(F.sum("n")).first()[0] or 0
    blocks = src.select("text").mapInArrow(_emit(total // BUCKET + 1), _BLOCK)
    parts = blocks.groupBy("bucket").applyInArrow(_shared(total // GROUP + 1), _SHARED)
    alive = written(parts.groupBy("of").applyInArrow(_prefixes(percent), _ALIVE), "jaccard-alive")
    firsts = written(alive.select("c", "n", "alone", F.posexplode("first").alias("at", "token")).select(
        "token", "c", "n", (F.col("alone") + F.col("at")).alias("i")), "jaccard-firsts")
    links = verified(written(pivot_pairs(firsts, percent), "jaccard-pivots"), alive, percent, "jaccard-links")
    label = components(links, "jaccard-components")
    more = verified(written(crossing_pairs(firsts, label, percent), "jaccard-crossing"), alive, percent, "jaccard-links")
    label = components(links.union(more), "jaccard-components")
    kinds = kinds.join(label, "c", "left").withColumn("k", F.coalesce("k", "c"))
    return meta, written(kinds, "jaccard-labelled")


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, copies`` for each row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest doc_id reachable by links, its own included; ``copies`` the
    rows of equal set. A null or blank text has the empty set, links with nothing and is its own
    component, also if other texts are empty. Fewer than five words are one shingle. Rows of one
    doc_id are rows of their own. A row without doc_id takes the component of its set; a set that
    only such rows have links with nothing, and its component is null.
    """
    meta, kinds = classes(docs, percent)
    least = written(kinds.where("n > 0").groupBy("k").agg(F.min("first").alias("component_id")), "jaccard-least")
    of = written(kinds.where("n > 0").join(least, "k").select("c", "c2", "n", "component_id", "copies"), "jaccard-of")
    full = meta.where("n > 0").join(of, ["c", "c2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "copies")
    empty = meta.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("copies"))
    return full.union(empty)


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    return joined(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def kept_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of every component: the one of smallest doc_id, with the columns of ``docs``.

    Texts without a word are components of their own and stay, every row of them. Rows that repeat
    a doc_id are told apart by their texts: each goes with its own component, and of those in one
    component the one of the smallest text stays. Rows without doc_id stay.
    """
    named = docs.where("doc_id is not null")
    meta, kinds = classes(named.select("doc_id", "text"), percent)
    full = kinds.where("n > 0").select("c", "c2", "n", "k", F.col("first").alias("doc_id"))
    least = written(full.groupBy("k").agg(F.min("doc_id").alias("doc_id")), "jaccard-least")
    # a class that has the component's smallest doc_id has it as its own smallest
    best = full.join(least, ["k", "doc_id"])
    found = meta.where("n > 0").join(best, ["doc_id", "c", "c2", "n"]).groupBy("doc_id", "t", "k").agg(F.count("*").alias("_rows"))
    found = found.withColumn("_rows", F.sum("_rows").over(Window.partitionBy("k")))
    blank = meta.where("n = 0").select("doc_id", "t", F.lit(None).cast("long").alias("k"), F.lit(1).cast("long").alias("_rows")).distinct()
    keep = written(found.unionByName(blank), "jaccard-keep")
    rows = boxed(named, F.col("doc_id"), text_key().alias("t")).join(keep, ["doc_id", "t"])
    once = unboxed(rows.where("_rows = 1"), docs.columns)
    several = rows.where("_rows > 1").groupBy("k").agg(F.min_by(F.col(ROW), F.struct(F.col(ROW)["text"], F.to_json(ROW))).alias(ROW))
    return once.unionByName(unboxed(several, docs.columns)).unionByName(docs.where("doc_id is null"))
