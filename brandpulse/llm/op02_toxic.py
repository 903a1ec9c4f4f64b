"""Toxicity by weak supervision.

Voters are words and word beginnings: a plain lexicon, and patterns mined from labelled rows (a
bounded sample). A voter fires on a text that has its word. How often voters fire, alone and in
pairs, is counted over all documents; from these counts a generative label model estimates each
voter's firing rates for toxic and other texts, and which voters are correlated beyond what the
label explains:

* given the label, uncorrelated voters fire independently, so their covariance is the product of
  one number per voter; these numbers are fitted on the pairs that aren't correlated;
* pairs whose covariance exceeds that product are correlated; they are left out of the fit, which
  is repeated, and a voter's evidence is divided among its correlated partners;
* how often a voter's texts are those of others gives its precision, and with it both rates. A voter
  that meets no other keeps the precision that all were chosen by. Labelled rows choose the
  voters and give the class balance; their rates are kept beside the model's, but enter nothing.

The model's posterior labels a bounded sample of unlabelled texts, and a linear classifier is
trained on these posteriors with the words and beginnings most associated with them. Its score
is the result. Scores use the text alone.

A null text counts as empty; a text without a known feature gets the classifier's base score.
Without labels the lexicon alone votes. Rows of one id are scored each by itself; of several
labels for one id the largest counts. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import documents, workers_import, written
from brandpulse.llm.words import chunks, mix, runs, span_hashes, text_buffer

#: Bounds of what is sampled: labelled rows to mine voters from, and rows that train the classifier.
LABELLED, TRAINING = 12_000, 24_000
VOTERS, VOCABULARY = 240, 2_000
#: Bytes of text that a task works on at once.
CHUNK = 1 << 19
PREFIXES = (4, 5, 6)
#: Toxic rows among the labelled ones with a pattern, plus one more row that isn't, from which it votes.
MIN_PRECISION = 0.8
#: The share of rows that aren't toxic among those with a mined pattern, at most.
MAX_OTHER = 0.05
#: Covariance beyond the label's, as a correlation, from which two voters count as correlated.
CORRELATED = 0.2
#: Co-firings that a voter's precision is assumed before any are counted.
PRIOR_MET = 5.0
DEFAULT_PRIOR = 0.1
#: Insults of everyday English.
LEXICON = (
    "idiot", "idiots", "stupid", "moron", "morons", "loser", "losers", "pathetic", "worthless", "disgusting",
    "scum", "trash", "clown", "dumb", "imbecile", "fool", "jerk", "creep", "vermin", "filth", "garbage", "freak",
)

_SALT = {0: np.uint64(0x243F6A8885A308D3)} | {n: np.uint64(0x13198A2E03707344 + n) for n in PREFIXES}
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of texts: first row, rows, and the (row in the chunk, feature) pairs, with repeats."""
    for first, n, *_ in chunks(col, CHUNK):
        buf, at = text_buffer(pc.utf8_lower(col.slice(first, n)))
        starts, ends, before = runs(buf, at, _NOT_LETTER)
        row = np.repeat(np.arange(n), np.diff(before))
        rows, feats = [row], [mix(span_hashes(buf, starts, ends) ^ _SALT[0])]
        for k in PREFIXES:
            long = np.flatnonzero(ends - starts > k)
            rows.append(row[long])
            feats.append(mix(span_hashes(buf, starts[long], starts[long] + k) ^ _SALT[k]))
        yield first, n, np.concatenate(rows), np.concatenate(feats)


def lexicon_features(words=LEXICON) -> np.ndarray:
    return np.unique(np.concatenate([f[:1] for w in words for _, _, _, f in features(pa.array([w]))]))


def _hits(known: np.ndarray, rows: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
    """Rows by known features (sorted): 1 where a row has the feature."""
    at = np.minimum(np.searchsorted(known, feats), len(known) - 1)
    same = known[at] == feats
    out = np.zeros((n, len(known)), np.float32)
    out[rows[same], at[same]] = 1
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _associations(weighted: DataFrame) -> DataFrame:
    """``feature, n, w``: in how many texts a feature is, and the sum of these texts' ``weight``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = b.column(1).to_numpy()
            for first, n, rows, feats in features(b.column(0)):
                order = np.lexsort((rows, feats))
                r, f = rows[order], feats[order]
                new = np.ones(len(f), bool)
                new[1:] = (f[1:] != f[:-1]) | (r[1:] != r[:-1])
                r, f = r[new], f[new]
                seen, at, count = np.unique(f, return_index=True, return_counts=True)
                if len(seen):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(seen), pa.array(count, pa.int64()), pa.array(np.add.reduceat(weight[first + r], at))], ["feature", "n", "w"])

    return (weighted.select("text", "weight").mapInArrow(run, "feature long, n long, w double")
            .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("w").alias("w")))


def mine(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Voters (sorted), their (toxic, other) firing counts among ``labelled`` (text, weight 0 or
    1), the share of toxic rows, and the number of rows."""
    total = labelled.agg(F.count("*").alias("n"), F.sum("weight").alias("w")).first()
    prior = (total.w + 1) / (total.n + 2) if total.n and total.w else DEFAULT_PRIOR
    found = _associations(labelled)
    sure = (F.col("w") >= (F.col("n") + 1) * MIN_PRECISION) & (F.col("w") >= F.col("n") * (1 - MAX_OTHER))
    rows = found.where(sure).orderBy(F.desc("w"), "feature").limit(VOTERS).collect()
    have = {np.uint64(r.feature & (2**64 - 1)): (r.w, r.n - r.w) for r in rows}
    voters = np.unique(np.concatenate([np.array(list(have), np.uint64), lexicon_features()]))
    counts = np.array([have.get(v, (0.0, 0.0)) for v in voters])
    seen = np.array([v in have for v in voters])
    counts[~seen] = np.nan
    return voters, counts, prior, total.n


def firing(docs: DataFrame, voters: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each pair of voters fires on one text, over all ``docs``, and the number of texts."""
    m = len(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((m, m))
        texts = 0
        for b in batches:
            for _, n, rows, feats in features(b.column(0)):
                some = _hits(voters, rows, feats, n)
                some = some[some.any(1)]
                both += some.T @ some
                texts += n
        i, j = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()), pa.array([*both[i, j], texts], pa.float64())],
                                         ["i", "j", "n"])

    rows = docs.select("text").mapInArrow(run, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out, texts = np.zeros((m, m)), 0
    for r in rows:  # voters squared at most
        if r.i < 0:
            texts = int(r.n)
        else:
            out[r.i, r.j] = r.n
    return out, texts


class LabelModel:
    """Firing rates given the label, correlations, and posteriors."""

    def __init__(self, both: np.ndarray, texts: int, counts: np.ndarray, prior: float, labelled: int, rounds: int = 4):
        n = max(texts, 1)
        rate = np.diag(both) / n
        cov = both / n - np.outer(rate, rate)
        scale = np.sqrt(np.maximum(rate * (1 - rate), 1e-12))
        corr = cov / np.outer(scale, scale)
        own = np.eye(len(rate), dtype=bool)
        load = self._first(np.where(own, 0, corr))
        for _ in range(rounds):
            self.linked = (corr - np.outer(load, load) > CORRELATED) & ~own
            use = ~self.linked & ~own
            for _ in range(40):
                top = (use * corr) @ load
                load = np.clip(top / np.maximum(use @ (load ** 2), 1e-9), 0, 1) * 0.5 + load * 0.5
        # Of n texts on which a voter fires, a part is toxic, its precision; the others that are free of it
        # fire on these at their toxic rates, on the rest at their other rates. So the co-firings counted
        # over the corpus tell the precision. All voters start from the one that they were chosen by.
        # Voters that meet more seldom than by chance (those of two languages) are correlated too, the other way.
        free = ~self.linked & ~own & (cov > 0)
        met = (free * both).sum(1)
        fired = np.diag(both)
        sure = np.clip(MIN_PRECISION + 0 * load, 0, 1)
        for _ in range(50):
            toxic, other = np.minimum(sure * rate / prior, 0.98), (1 - sure) * rate / (1 - prior)
            each = free @ np.maximum(toxic - other, 0)
            new = (met - fired * (free @ other) + PRIOR_MET * MIN_PRECISION) / (fired * np.maximum(each, 0) + PRIOR_MET)
            sure = 0.5 * sure + 0.5 * np.clip(new, 0.01, 0.995)
        toxic, other = sure * rate / prior, (1 - sure) * rate / (1 - prior)
        #: Rates that the labelled rows show, for comparison: they enter nothing (nan: not mined).
        rows = np.array([labelled * prior, labelled * (1 - prior)])
        self.seen = counts / np.maximum(rows, 1)
        self.toxic = np.clip(toxic, 2 / (n + 4), 0.98)
        self.other = np.clip(other, 0.5 / (n + 4), 0.98)
        # a voter that doesn't fire abstains; that none fires is one more piece of evidence, its
        # rates those of independent groups of correlated voters
        share = 1 / (1 + self.linked.sum(1))
        self.none = float((np.log1p(-self.toxic) * share).sum() - (np.log1p(-self.other) * share).sum())
        self.lone = np.log(self.toxic / self.other)
        self.base = np.log(prior / (1 - prior))

    @staticmethod
    def _first(corr: np.ndarray) -> np.ndarray:
        """Loads from triplets: of three uncorrelated voters each load is the root of a quotient of
        covariances; the median over all triplets of a voter isn't moved by a few correlated pairs."""
        out = np.full(len(corr), 0.1)
        for j, row in enumerate(corr):
            k = np.flatnonzero(row > 1e-3)
            of = corr[np.ix_(k, k)]
            ok = np.triu(of > 1e-3, 1)
            if ok.any():
                out[j] = np.sqrt(np.median(np.outer(row[k], row[k])[ok] / of[ok]))
        return np.clip(out, 0, 1)

    def posterior(self, hits: np.ndarray) -> np.ndarray:
        together = 1 + hits @ self.linked  # partners that fire together share one vote
        z = self.base + np.where(hits.any(1), (hits * self.lone / together).sum(1), self.none)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def posteriors(docs: DataFrame, voters: np.ndarray, model: LabelModel) -> DataFrame:
    """``text, weight``: the label model's posterior of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, rows, feats in features(b.column(0)):
                q = model.posterior(_hits(voters, rows, feats, n))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, n), pa.array(q, pa.float64())], ["text", "weight"])

    return docs.select("text").mapInArrow(run, "text string, weight double")


def fit(soft: DataFrame, vocabulary: np.ndarray, l2: float = 2.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels; ``soft`` is a bounded sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = b.column(1).to_numpy()
            for first, n, rows, feats in features(b.column(0)):
                i, j = np.nonzero(_hits(vocabulary, rows, feats, n))
                lists = np.split(j.astype(np.int32), np.cumsum(np.bincount(i, minlength=n))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), pa.array(weight[first:first + n])], ["x", "q"])

    rows = (soft.mapInArrow(run, "x array<int>, q double").groupBy("x").agg(F.sum("q").alias("q"), F.count("*").alias("n"))
            .orderBy("x").collect())
    w, b = np.zeros(len(vocabulary)), 0.0
    if not rows:
        return w, -2.0
    at = np.repeat(np.arange(len(rows)), [len(r.x) for r in rows])
    col = np.array([j for r in rows for j in r.x], np.int64)
    q, n = np.array([r.q for r in rows]), np.array([float(r.n) for r in rows])
    b = float(np.log((q.sum() + 0.5) / (n.sum() - q.sum() + 0.5)))
    curve = np.bincount(col, n[at] / 4, len(w)) * 8 + l2  # a bound of the curvature, for steady steps
    for _ in range(rounds):
        z = b + np.bincount(at, w[col], len(rows))
        miss = q - n / (1 + np.exp(-np.clip(z, -30, 30)))
        w += (np.bincount(col, miss[at], len(w)) - l2 * 0.05 * w) / curve
        b += miss.sum() / (n.sum() / 4 + 1) * 0.5
    return w, b


def sample(rows: DataFrame, key: Column, bound: int, seed: int = 7) -> DataFrame:
    """``bound`` rows at most, by a hash of the key."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(bound)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 5 == 0, F.lit(True))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, score`` for each row of ``docs`` (``key, text``); ``labels`` has ``key, toxic`` of
    rows to learn from."""
    workers_import(docs.sparkSession)
    docs = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    known = labels.where("toxic is not null").groupBy(key).agg(F.max("toxic").cast("double").alias("weight"))
    some = sample(known, F.col(key), LABELLED)
    labelled = written(docs.join(F.broadcast(some), key).groupBy("text").agg(F.max("weight").alias("weight")), "toxic-labelled")
    voters, counts, prior, n = mine(labelled)
    both, texts = firing(docs, voters)
    model = LabelModel(both, texts, counts, prior, n)
    ids = sample(docs.select(key).where(~held_out(F.col(key))), F.col(key), TRAINING)
    train = docs.join(F.broadcast(ids.distinct()), key).select("text").distinct()
    soft = written(posteriors(train, voters, model), "toxic-soft")
    q = soft.agg(F.avg("weight")).first()[0] or prior
    z = (F.col("w") - F.col("n") * q) / F.sqrt(F.col("n") * (q * (1 - q) + 1e-9))
    picked = _associations(soft).where("n > 1").orderBy(F.desc(F.abs(z)), "feature").limit(VOCABULARY).collect()
    vocabulary = np.unique(np.concatenate([np.array([r.feature for r in picked], np.int64).view(np.uint64), voters]))
    w, bias = fit(soft, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, rows_n, rows, feats in features(b.column(1)):
                at = np.minimum(np.searchsorted(vocabulary, feats), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[at] == feats)
                one = np.unique(rows[hit] * len(vocabulary) + at[hit])
                z = bias + np.bincount(one // len(vocabulary), w[one % len(vocabulary)], rows_n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, rows_n), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                                 [key, "score"])

    return docs.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, score double")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    return score(docs, labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
