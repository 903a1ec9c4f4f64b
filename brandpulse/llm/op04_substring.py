r"""Substring dedup with suffix automata of reference shards.

A word is removed if it is covered by a window of ``length`` words whose sequence starts anywhere
else in the corpus too, in the same text or another. The reference is the corpus itself, so its
automata must not grow with it; only what can repeat is put into them:

1. In each window the 8-word gram of least hash is its seed. Windows of one seed position in a
   row make a region. Equal windows have equal seeds, so windows only repeat among the regions of
   one seed. Regions are counted by seed and content, combined before the shuffle.
2. Seeds that occur once settle nothing. Where all regions of a seed are equal, all of them
   repeat. The regions of the other seeds, each different one once with its number of
   occurrences, are the reference: it is dealt by seed into shards of bounded size, and the
   regions that can match a shard go where it is. (An automaton per shard, shipped to all documents,
   would make every document pass every shard.)
3. A shard's task builds the suffix automaton of its regions, with the occurrences of every
   state, and streams the regions through it. The matching statistics tell at each word whether
   the last ``length`` words occur twice; such windows unite to maximal spans.
4. A seed with more than ``VARIANTS`` different regions (the edge of a passage that very many
   documents hold) doesn't go to one shard: its windows are told apart by their own hashes,
   counted by shuffle.
5. Spans go back to the texts by a key of the whole text, equal texts once.

A null or blank text has no words. Texts shorter than a window keep all words. Rows of one
doc_id are rows of their own. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, boxed, documents, unboxed, workers_import, written
from brandpulse.llm.words import Runs, chunks, runs, span_hashes, trim

LENGTH = 35
SEED = 8
VARIANTS = 2_000
SHARD_WORDS = 60_000
#: Bytes of text that a task works on at once.
CHUNK = 1 << 20
_POS = np.uint64((1 << 31) - 1)


def regions(h: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The regions of texts whose word hashes stand in a row: seed, content hash, text, first
    word in the text, and number of windows."""
    every = Runs(h)
    n = np.maximum(np.diff(before) - length + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    starts = np.arange(int(n.sum())) + np.repeat(before[:-1] - (np.cumsum(n) - n), n)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    gram = every.every(SEED)
    least = (gram & ~_POS) | np.arange(len(gram), dtype=np.uint64)
    have, want = 1, length - SEED + 1
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    seed = (least[starts] & _POS).astype(np.int64)
    new = np.ones(len(seed), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    m = np.diff(np.append(first, len(seed)))
    a = starts[first]
    content = every.of(a, m + length - 1)
    return gram[seed[first]], content, text[first], a - before[text[first]], m


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def _seeds(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, buf, at in chunks(b.column(0), CHUNK):
                starts, ends, before = runs(buf, at)
                g, r, *_ = regions(span_hashes(buf, starts, ends), before, length)
                yield pa.RecordBatch.from_arrays([_long(g), _long(r)], ["g", "r"])
        trim()
    return run


def _places(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, _, buf, at in chunks(b.column(2), CHUNK):
                starts, ends, before = runs(buf, at)
                g, r, text, a, m = regions(span_hashes(buf, starts, ends), before, length)
                of = pa.array(first + text)
                yield pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), _long(g), _long(r), pa.array(a, pa.int32()), pa.array(m, pa.int32())],
                                                 ["k", "size", "g", "r", "a", "m"])
        trim()
    return run


def _contents(length: int):
    """The words of wanted regions, each text once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for first, n, buf, at in chunks(b.column(2), CHUNK):
                starts, ends, before = runs(buf, at)
                h = span_hashes(buf, starts, ends)
                rows = []
                for i in range(n):
                    if keys[first + i] in seen:
                        continue
                    seen.add(keys[first + i])
                    for x in b.column(3)[first + i].as_py():
                        s = int(before[i]) + x["a"]
                        rows.append((x["shard"], x["g"], x["r"], x["n"], x["hot"], h[s:s + x["m"] + length - 1].tobytes()))
                if rows:
                    col = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(col, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()], strict=True)],
                                                     ["shard", "g", "r", "n", "hot", "words"])
        trim()
    return run


class Automaton:
    """Suffix automaton of many sequences; every state knows how often its strings occur."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link = self.next, self.link
        new = len(nxt)
        nxt.append(nxt[q].copy())
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def add(self, sequence: list[int], times: int) -> None:
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, c)
            else:
                new = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                count.append(0)
                link.append(0)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
                last = new
            count[last] += times

    def close(self) -> None:
        """After the last sequence: adds up occurrences along suffix links."""
        count, link = self.count, self.link
        for v in sorted(range(1, len(count)), key=self.length.__getitem__, reverse=True):
            count[link[v]] += count[v]

    def repeats(self, sequence: list[int], span: int) -> Iterator[int]:
        """Where ``span`` words start that occur twice or more, by the matching statistics."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        v, match = 0, 0
        for i, c in enumerate(sequence):
            while v and c not in nxt[v]:
                v = link[v]
                match = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                match += 1
            if match >= span:
                match = span  # the state of the last span words
                while length[link[v]] >= span:
                    v = link[v]
                if count[v] > 1:
                    yield i - span + 1


def _joined(starts: list[int], span: int) -> list[tuple[int, int]]:
    """Ascending window starts as maximal spans."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = s + span
        else:
            out.append([s, s + span])
    return [(a, b) for a, b in out]


def _shard(length: int):
    def run(t: pa.Table) -> pa.Table:
        one = {}
        for g, r, n, hot, words in zip(*[t.column(c).to_pylist() for c in ("g", "r", "n", "hot", "words")], strict=True):
            one[g, r] = (n, hot, np.frombuffer(words, np.uint64))
        rows: list[tuple] = []
        plain = {k: x for k, x in one.items() if not x[1]}
        if plain:
            _, ids = np.unique(np.concatenate([x[2] for x in plain.values()]), return_inverse=True)
            cuts = np.cumsum([len(x[2]) for x in plain.values()])[:-1]
            machine = Automaton()
            named = {k: s.tolist() for k, s in zip(plain, np.split(ids, cuts), strict=True)}
            for k, s in named.items():
                machine.add(s, plain[k][0])
            machine.close()
            for (g, r), s in named.items():
                rows += [(g, r, a, b, None, None) for a, b in _joined(list(machine.repeats(s, length)), length)]
        for (g, r), (n, hot, words) in one.items():
            if hot:
                w = Runs(words).every(length).view(np.int64)
                rows += [(g, r, s, s + length, int(x), n) for s, x in enumerate(w)]
        col = list(zip(*rows, strict=True)) or [()] * 6
        out = pa.table({k: pa.array(c, v) for c, (k, v) in zip(col, _DETAIL.items(), strict=True)})
        trim()
        return out
    return run


_DETAIL = {"g": pa.int64(), "r": pa.int64(), "start": pa.int32(), "end": pa.int32(), "w": pa.int64(), "n": pa.int64()}


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k, size, spans`` (words, from and to) of every text that repeats something; ``texts`` has
    ``k, size, text``, k and size standing for the text."""
    grams = written(texts.select("text").mapInArrow(_seeds(length), "g long, r long").groupBy("g").agg(
        F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).where("n > 1").select(
        "g", (F.col("lo") != F.col("hi")).alias("multi")), "substring-seeds")
    places = texts.select("k", "size", "text").mapInArrow(_places(length), "k long, size long, g long, r long, a int, m int")
    hits = written(places.join(grams, "g"), "substring-places")
    kinds = written(hits.where("multi").groupBy("g", "r").agg(F.count("*").alias("n"), F.min(F.struct("k", "size", "a", "m")).alias("at")), "substring-kinds")
    variants = written(kinds.groupBy("g").agg((F.count("*") > VARIANTS).alias("hot")), "substring-variants")
    shards = (kinds.agg(F.sum(F.col("at.m") + length)).first()[0] or 0) // SHARD_WORDS + 1
    told = kinds.join(variants, "g")
    shard = F.pmod(F.when(F.col("hot"), F.xxhash64("g", "r")).otherwise(F.xxhash64("g")), F.lit(shards)).cast("int")
    wanted = written(told.groupBy(F.col("at.k").alias("k"), F.col("at.size").alias("size")).agg(F.collect_list(
        F.struct(shard.alias("shard"), "g", "r", F.col("at.a").alias("a"), F.col("at.m").alias("m"), "n", "hot")).alias("want")), "substring-wanted")
    rows = texts.select("k", "size", "text").join(wanted, ["k", "size"]).select("k", "size", "text", "want")
    parts = rows.mapInArrow(_contents(length), "shard int, g long, r long, n long, hot boolean, words binary")
    detail = written(parts.groupBy("shard").applyInArrow(_shard(length), "g long, r long, start int, end int, w long, n long"), "substring-detail")
    hot = detail.where("w is not null")
    often = written(hot.groupBy("g", "w").agg(F.sum("n").alias("n")).where("n > 1").select("g", "w"), "substring-windows")
    found = detail.where("w is null").select("g", "r", "start", "end").union(hot.join(often, ["g", "w"]).select("g", "r", "start", "end"))
    found = written(found, "substring-found")
    some = hits.where("multi").select("k", "size", "g", "r", "a").join(found, ["g", "r"]).select(
        "k", "size", (F.col("a") + F.col("start")).alias("start"), (F.col("a") + F.col("end")).alias("end"))
    every = hits.where("not multi").select("k", "size", F.col("a").alias("start"), (F.col("a") + F.col("m") + (length - 1)).alias("end"))
    spans = every.union(some).distinct()
    return written(spans.groupBy("k", "size").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "substring-spans")


def _text_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return boxed(docs, text.alias("text"), F.xxhash64(text).alias("k"), F.octet_length(text).cast("long").alias("size"))


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``spans``, the repeated word spans of each text (null: none); an input column
    of that name is replaced."""
    workers_import(docs.sparkSession)
    keyed = _text_key(docs)
    spans = repeated_spans(keyed.select("k", "size", "text"), length)
    joined = keyed.select(ROW, "k", "size").join(spans, ["k", "size"], "left")
    return unboxed(joined, docs.columns, "spans")


def _kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, spans in zip(b.column(1), b.column(2), strict=True):
            words = (text.as_py() or "").encode().split()
            kept, at = [], 0
            for x in spans.as_py() or ():
                kept += words[at:x["start"]]
                at = max(at, x["end"])
            kept += words[at:]
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        col = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(col[0], pa.int64()), pa.array(col[1], pa.int64()), pa.array(col[2])],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def kept_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text`` (what stands between them is
    unchanged) and ``n_chars`` its new length; other columns and untouched texts stay."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2), strict=True):
                raw, spans = text.as_py(), spans.as_py()
                if spans:
                    raw = raw.encode()
                    starts, _, _ = runs(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    parts, at = [], 0
                    for x in spans:
                        if x["start"] > at:
                            parts.append(raw[starts[at]:starts[x["start"]]])
                        at = max(at, x["end"])
                    parts.append(raw[starts[at]:] if at < len(starts) else b"")
                    raw = b"".join(parts).decode()
                out.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [ROW, "_cut"])

    t = removed(boxed(docs, "text"), length).select(ROW, "text", "spans")
    t = t.mapInArrow(cut, t.select(ROW).schema.add("_cut", "string"))
    new = {"text": F.col("_cut"), "n_chars": F.length("_cut").cast("long")}
    return t.select(*[new.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])


def op4_substring(spark, sf_dir: str) -> DataFrame:
    t = removed(documents(spark, sf_dir).select("doc_id", "text"))
    return t.select("doc_id", "text", "spans").mapInArrow(_kept_words, "doc_id long, n_words long, n_removed long, kept_sha256 string")


OP4_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i,
         unnest(list_transform(range(1, len(ws) - 33), lambda k: md5(array_to_string(ws[k:k + 34], ' ')))) AS h
  FROM w WHERE len(ws) >= 35),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS t, count(*) AS n
  FROM pos LEFT JOIN cov ON pos.doc_id = cov.doc_id AND pos.p = cov.p WHERE cov.p IS NULL GROUP BY pos.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
