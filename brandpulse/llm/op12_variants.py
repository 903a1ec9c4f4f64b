r"""Spelling variant grouping over an index of variable-length grams.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. One in
``NOISE`` runs of a document, chosen by the checksum of its id and the run, loses one letter. Words of
``SHORTEST`` letters or more that occur ``LEAST`` times or more are the vocabulary. Two words are near
if one inserted, deleted or replaced code point turns one into the other.

1. Tasks count words per stretch of text; Spark adds the counts up.
2. The gram dictionary holds the grams of 2 to ``LONGEST`` letters that are frequent in the
   vocabulary: more than ``LIST`` times, and often enough that there can be no more than
   ``DICTIONARY`` of a length. It is pruned by that bound, so it may be sent to every task.
3. A word has one gram at each place but the last: two letters, lengthened while it is in the
   dictionary. So frequent beginnings give long grams, rare ones short grams, and lists stay short.
4. What a gram depends on are the letters that were looked at to choose it (and the word's end, if
   it was met). An edit can only affect the grams that looked at its place, so with the most that
   any one place affects, ``affected``, near words share at least ``grams - affected`` grams. The
   rarest ``affected + 1`` of a word's grams are its entries in the index: near words meet in one.
   Grams that repeat in a word are numbered. Words of few letters use shorter grams, so that an edit
   never affects all: words are paired by the shorter one's length, each length with its longest gram.
5. Lists are joined with themselves; of what meets there, lengths and places must fit, and the edit
   distance is verified in the join.
6. A word's form is its near word of largest count, if that is at least twice its own; forms of forms are
   followed by doubling joins.

Null and empty texts have no words. A null doc_id counts as the empty text in the checksum. Rows
that repeat count each by itself. An empty table, or one without words, gives no rows. Everything
that later steps read is written to the shared folder, and joins are left to the planner.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import documents, workers_import, written
from brandpulse.llm.words import chunks, runs, span_hashes, trim

NOISE = 97
SHORTEST = 5
LEAST = 3
#: Longest gram, grams of a length that the dictionary holds at most, and words of a list that need no longer gram.
LONGEST = 6
DICTIONARY = 50_000
LIST = 32
#: Bytes of text that a task works on at once.
CHUNK = 4 << 20
#: Words of more bytes are checksummed one by one.
LONG = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True
_OUTSIDE = np.array([True, False] + [True] * 254)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def checksums(prefixes: list[bytes], buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The unsigned crc32 of each word behind the prefix of its document (``of``)."""
    before = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
    state = ~before[of]
    size = ends - starts
    long = np.flatnonzero(size > LONG)
    order = np.argsort(-size, kind="stable")[len(long):]
    left = size[order]
    for j in range(int(left[0]) if len(left) else 0):
        some = order[:np.searchsorted(-left, -j)]  # words of more than j bytes
        s = state[some]
        state[some] = _CRC[(s ^ buf[starts[some] + j]) & 0xFF] ^ (s >> np.uint32(8))
    out = ~state
    if len(long):
        raw = buf.tobytes()
        out[long] = [zlib.crc32(raw[a:b], int(before[d])) for a, b, d in zip(starts[long].tolist(), ends[long].tolist(), of[long].tolist(), strict=True)]
    return out


def _spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of bytes as strings."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])
    data = buf[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of each stretch of texts."""
    for b in batches:
        names = [(x or "").encode() + b":" for x in b.column(0).to_pylist()]
        for first, n, raw, at in chunks(b.column(1), CHUNK):
            letter = _LETTER[raw]
            letter[1:] |= raw[:-1] == 0xC3
            buf = _LOWER[raw]
            starts, ends, before = runs(letter.view(np.uint8), at, _OUTSIDE)
            if not len(starts):
                continue
            two = np.concatenate([[0], np.cumsum(buf == 0xC3)])
            size = ends - starts - (two[ends] - two[starts])  # code points
            h = checksums(names[first:first + n], buf, starts, ends, np.repeat(np.arange(n), np.diff(before)))
            noisy = h % NOISE == 0
            plain = np.flatnonzero(~noisy & (size >= SHORTEST))
            codes, _ = pd.factorize(span_hashes(buf, starts[plain], ends[plain]))
            seen = plain[np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))] if len(plain) else plain
            text, extra = buf.tobytes(), {}
            for i in np.flatnonzero(noisy & (size > SHORTEST)).tolist():
                w = text[starts[i]:ends[i]].decode()
                k = int(h[i]) % len(w)
                w = w[:k] + w[k + 1:]
                extra[w] = extra.get(w, 0) + 1
            words = pa.concat_arrays([_spans(buf, starts[seen], ends[seen]), pa.array(list(extra), pa.string())])
            yield pa.RecordBatch.from_arrays([words, pa.array(np.concatenate([np.bincount(codes, minlength=len(seen)), np.array(list(extra.values()), np.int64)]), pa.int64())],
                                             ["word", "n"])
    trim()


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``word, n`` of the words that occur at least ``least`` times in ``docs`` (``doc_id, text``)."""
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return src.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---------------------------------------------------------------------------------- the index
def _dictionary(vocab: DataFrame) -> dict[str, int]:
    """The frequent grams of the vocabulary and how often they stand in it."""
    places = vocab.agg(F.sum(F.length("word") - 1)).first()[0] or 0
    often = max(LIST, places // DICTIONARY)  # a length has as many grams as places at most
    grams = F.expr(f"flatten(transform(sequence(1, length(word) - 1), p -> transform(sequence(2, least({LONGEST}, length(word) - p + 1)), q -> substring(word, p, q))))")
    rows = vocab.select(F.explode(grams).alias("g")).groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > often)
    return {r.g: r.n for r in rows.collect()}  # bounded by DICTIONARY a length


def decomposed(word: str, known: dict[str, int], longest: int) -> tuple[list[str], int]:
    """The gram at each place, and how many an edit can affect at most."""
    n = len(word)
    grams, reach = [], [0] * (n + 2)
    for p in range(n - 1):
        q = 2
        while q < longest and p + q < n and word[p:p + q] in known:
            q += 1
        g = word[p:p + q]
        grams.append(g)
        looked = n if p + q == n and q < longest and g in known else p + q - 1  # n: the word's end was met
        reach[p] += 1
        reach[looked + 1] -= 1
    most = here = 0
    for x in reach:
        here += x
        most = max(most, here)
    return grams, most


def entries(word: str, known: dict[str, int]) -> Iterator[tuple[int, str, int, bool]]:
    """The word's entries in the index: class (the shorter length of a pair, as far as it matters),
    gram with its number, place, and whether the gram repeats."""
    n, last = len(word), LONGEST + 2
    for m in sorted({min(n, last), min(n - 1, last)}):
        if m < SHORTEST:
            continue
        grams, affected = decomposed(word, known, min(LONGEST, m - 2))
        times: dict[str, int] = {}
        rows = []
        for p, g in enumerate(grams):
            times[g] = times.get(g, 0) + 1
            rows.append((known.get(g, 0), g, times[g], p))
        for _, g, k, p in sorted(rows)[:affected + 1]:
            yield m, g if k == 1 else f"{g} {k}", p, times[g] > 1


def _index(known: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(m, g, p, r, w, n) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m, g, p, r in entries(w, known)]
            if rows:
                col = list(zip(*rows, strict=True))
                types = [pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(col, types, strict=True)], ["m", "g", "p", "r", "word", "n"])
        trim()
    return run


def near_words(vocab: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` of all near words of a vocabulary (``word, n``), both ways."""
    index = written(vocab.select("word", "n").mapInArrow(_index(_dictionary(vocab)), "m int, g string, p int, r boolean, word string, n long"), "variants-index")
    x = index.select("m", "g", *[F.col(c).alias(f"{c}_a") for c in ("p", "r", "word", "n")], F.length("word").alias("l_a"))
    y = index.select("m", "g", *[F.col(c).alias(f"{c}_b") for c in ("p", "r", "word", "n")], F.length("word").alias("l_b"))
    met = x.join(y, ["m", "g"]).where(
        (F.col("word_a") < F.col("word_b")) & (F.abs(F.col("l_a") - F.col("l_b")) <= 1) & (F.least("l_a", "l_b", F.lit(LONGEST + 2)) == F.col("m"))
        & (F.col("r_a") | F.col("r_b") | (F.abs(F.col("p_a") - F.col("p_b")) <= 1)) & (F.levenshtein("word_a", "word_b", 1) == 1))
    pairs = written(met.select("word_a", "n_a", "word_b", "n_b").distinct(), "variants-pairs")
    return pairs.toDF("word", "n", "other", "other_n").unionByName(pairs.toDF("other", "other_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` from each word ends."""
    steps = written(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        more = steps.select(F.col("word").alias("root"), F.col("root").alias("then"))
        new = written(steps.join(more, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "variants-roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        steps = new.select("word", "root")


def variants(docs: DataFrame, least: int = LEAST, ratio: float = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the vocabulary of ``docs`` (``doc_id, text``)."""
    workers_import(docs.sparkSession)
    vocab = written(vocabulary(docs, least), "variants-words")
    best = near_words(vocab).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
    near = written(best.select("word", "n_near", F.when(F.col("best.other_n") >= F.col("n") * ratio, F.col("best")).alias("best")), "variants-near")
    roots = _roots(near.where("best is not null").select("word", F.col("best.other").alias("form")))
    return (vocab.join(near, "word", "left").join(roots, "word", "left")
            .select("word", F.col("best.other").alias("form"), F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other_n").alias("form_n")))


def op12_variants(spark, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir).select("doc_id", "text"))
