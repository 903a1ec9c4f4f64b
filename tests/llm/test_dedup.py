"""Substring dedup, the n-gram join, toxicity and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from brandpulse.llm import op02_toxic as T
from brandpulse.llm import op04_substring as S
from brandpulse.llm import op10_jaccard as J
from brandpulse.llm.common import documents, written
from pyspark.sql import functions as F

SPACE = re.compile(r"[\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(t):
    return [w for w in SPACE.split(t or "") if w]


# -------------------------------------------------------------------------------- substrings
def _brute_removed(texts, n):
    seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    return [{p for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for p in range(i, i + n)} for w in texts]


def test_automaton_counts_by_brute_force():
    rnd = random.Random(2)
    for _ in range(30):
        seqs = [[rnd.randint(0, 2) for _ in range(rnd.randint(1, 25))] for _ in range(rnd.randint(1, 5))]
        times = [rnd.randint(1, 2) for _ in seqs]
        machine = S.Automaton()
        for s, k in zip(seqs, times, strict=True):
            machine.add(s, k)
        machine.close()
        for span in (1, 3, 6):
            seen = Counter()
            for s, k in zip(seqs, times, strict=True):
                for i in range(len(s) - span + 1):
                    seen[tuple(s[i:i + span])] += k
            for s in seqs:
                assert list(machine.repeats(s, span)) == [i for i in range(len(s) - span + 1) if seen[tuple(s[i:i + span])] > 1]


def _planted(seed):
    rnd = random.Random(seed)
    passages = [[f"p{k}_{i}" for i in range(rnd.choice([34, 35, 36, 60]))] for k in range(4)]
    texts = []
    for d in range(40):
        w = [f"u{d}_{i}" for i in range(rnd.randint(0, 60))]
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            cut = p if rnd.random() < 0.6 else p[rnd.randint(0, 5):]
            w[at:at] = cut
        texts.append(w)
    texts += [texts[3], texts[3], ["z"] * 80, ["a", "b"] * 40, [], ["one"]]
    return texts


@pytest.mark.parametrize("variants", [S.VARIANTS, 1])
def test_removed_words_by_brute_force(spark, monkeypatch, variants):
    monkeypatch.setattr(S, "VARIANTS", variants)  # 1: every seed with several regions is told apart by windows
    monkeypatch.setattr(S, "SHARD_WORDS", 500)
    texts = _planted(11)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: {p for x in (r.spans or []) for p in range(x.start, x.end)} for r in S.removed(df).collect()}
    assert [got[i] for i in range(len(texts))] == _brute_removed(texts, S.LENGTH)


def test_large_sides_are_shuffled_alike(spark, no_broadcast):
    texts = _planted(5)
    df = spark.createDataFrame([(i, "\n ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: {p for x in (r.spans or []) for p in range(x.start, x.end)} for r in S.removed(df).collect()}
    assert [got[i] for i in range(len(texts))] == _brute_removed(texts, S.LENGTH)


def test_substring_query_matches_sql(spark, sf):
    from oracle_check import duck, rows_of
    df = S.op4_substring(spark, sf)
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 9)
    r = duck(sf).execute(S.OP4_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 9)
    assert a == b


def test_substring_edges(spark, edge, empty):
    out = S.kept_documents(edge)
    assert out.columns == edge.columns
    rows = out.select("doc_id", "text", "n_chars").collect()
    assert len(rows) == 11
    text = {r.doc_id: r.text for r in rows}
    assert text[5] == "" and text[6] == "" and text[7].strip() == "more." and text[8] == "lone words here."
    assert (text[1] or "") == "" and text[3] == " \t\n "
    assert S.kept_documents(empty).count() == 0 and S.removed(empty).count() == 0


# -------------------------------------------------------------------------------- n-gram join
def _shingles(t):
    w = _words((t or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _components(texts):
    sets = {i: _shingles(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def _near_copies(seed):
    rnd = random.Random(seed)
    texts = []
    for c in range(8):
        base = [f"c{c}_{i}" for i in range(rnd.choice([6, 20, 60, 200]))]
        for _ in range(rnd.randint(1, 12)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 12))):
                w[rnd.randrange(len(w))] = f"e{rnd.random()}"
            texts.append(" ".join(w))
    line = " ".join(f"line{i}" for i in range(30))
    texts += [line + " " + " ".join(f"x{k}_{i}" for i in range(rnd.randint(3, 60))) for k in range(25)]
    texts += ["a", "A", "a b", "", None, "  ", "same WORDS here two", "same words here two"]
    rnd.shuffle(texts)
    return dict(enumerate(texts, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_brute_force(spark, seed):
    texts = _near_copies(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.joined(df).collect()}
    assert got == _components(texts)


def test_components_with_many_buckets_and_shuffled_sides(spark, monkeypatch, no_broadcast):
    texts = _near_copies(3)
    monkeypatch.setattr(J, "BUCKET", 300)
    monkeypatch.setattr(J, "GROUP", 700)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.joined(df).collect()}
    assert got == _components(texts)


@pytest.mark.parametrize("hot", [2, 5, 10**6])
def test_shared_shingles_by_brute_force(monkeypatch, hot):
    rnd = random.Random(hot)
    monkeypatch.setattr(J, "HOT", hot)
    pool = [rnd.getrandbits(64) for _ in range(300)]
    sets = [np.unique(np.array(rnd.sample(pool, rnd.randint(1, 40)) + pool[:rnd.randint(0, 4)] + [rnd.getrandbits(64)], np.uint64)) for _ in range(60)]
    flushes = [sets[:25], sets[20:45], sets[45:]]  # some classes come twice
    rows = [r for f in flushes for r in J._blocks(f, np.array([J.class_key(s)[0] for s in f], np.int64), 7)]
    names = ["bucket", "hot", "n", "tokens", "own", "classes", "sizes"]
    got = defaultdict(set)
    for k in range(7):
        some = [r for r in rows if r[0] == k]
        if some:
            out = J._by_group(*J._counted(pa.table([list(c) for c in zip(*some, strict=True)], names)), 3)
            for c, n, m, x in zip(*[out.column(i).to_pylist() for i in range(1, 5)], strict=True):
                c, n, m, x = [np.frombuffer(v, k).tolist() for v, k in ((c, np.int64), (n, np.uint32), (m, np.uint32), (x, np.uint64))]
                for c, n, m in zip(c, n, m, strict=True):
                    got[c, n] |= set(x[:m])
                    x = x[m:]
    often = Counter(int(t) >> 16 for s in sets for t in s)
    most = Counter(t for f in flushes for t, d in Counter(int(t) >> 16 for s in f for t in s).items() if d > hot)
    want = {}
    for s in sets:
        v = {(J._MOST if t in most else often[t]) << 48 | t for t in (int(x) >> 16 for x in s) if often[t] > 1}
        if v:
            want[J.class_key(s)[0], len(s)] = v
    assert {k: v for k, v in got.items() if v} == want


def test_linked_sets_share_what_their_prefixes_ask_for():
    rnd = random.Random(4)
    seen = 0
    for _ in range(400):
        n = rnd.randint(1, 300)
        a = set(rnd.sample(range(10**6), n))
        keep = set(rnd.sample(sorted(a), rnd.randint(int(0.75 * n), n)))
        b = keep | set(rnd.sample(range(10**6, 2 * 10**6), rnd.randint(0, n // 4)))
        if not b or 100 * len(a & b) < 75 * len(a | b):
            continue
        seen += 1
        count = {x: rnd.randint(2, 50) for x in a | b}
        left, right = [sorted(s, key=lambda x: (count[x], x)) for s in (a, b)]
        rests = []
        for s in (left, right):
            low = J.overlap(len(s), 75)
            rests.append(low - 1 - J.extra(len(s), low, 0, np.array([count[x] for x in s])))
            assert 0 <= rests[-1] < low
        both = set(left[:len(left) - rests[0]]) & set(right[:len(right) - rests[1]])
        assert len(both) >= J.matches(len(a), len(b), *rests, 75) >= 1
        first = min(a & b, key=lambda x: (count[x], x))
        assert min(len(a) - left.index(first), len(b) - right.index(first)) >= J.shared(len(a), len(b), 75)
    assert seen > 100


def test_prefixes_grow_where_candidates_are_many():
    n = 400
    low = J.overlap(n, 75)
    few, many = np.full(n, 2), np.append(np.full(80, 2), np.full(n - 80, 5000))
    assert J.extra(n, low, 0, many) > J.extra(n, low, 90, few[90:]) == 0


# words that a polynomial hash modulo a power of two can't tell apart
def _doubling(n):
    x, y = "a", "b"
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_doubling_patterns_are_different(spark, n):
    x, y = _doubling(n)
    tail = " ".join(f"w{i}" for i in range(S.LENGTH - 1))
    df = spark.createDataFrame([(1, x), (2, y), (3, f"{x} {tail}"), (4, f"{y} {tail}")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.joined(df).collect()}
    assert got[1] == (1, 1) and got[2] == (1, 2)
    assert all(r.spans is None for r in S.removed(df).collect())


def test_join_edges(spark, edge, empty):
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in J.joined(edge.select("doc_id", "text")).collect()}
    assert rows[1] == (0, 1) and rows[2] == (0, 2) and rows[5] == rows[6] and rows[7] == (77, 5)
    assert rows[8] == (1, 8)
    kept = J.kept_documents(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 2, 3, 4, 5, 8, 9, 10]
    assert J.joined(empty.select("doc_id", "text")).count() == 0 and J.kept_documents(empty).count() == 0
    odd = spark.createDataFrame([(None, "x y z a b c"), (None, "q"), (4, "x y z a b c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in J.joined(odd).collect()) == [(0, 0), (0, 4), (4, 4)]
    assert J.kept_documents(odd).count() == 3


def test_rows_of_one_doc_id_go_with_their_own_components(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base), (2, base + " more"), (2, "another text that links with nothing"),
            (5, "one clean text that stands by itself"), (5, "some other text with words of its own"), (5, None), (5, " "),
            (6, base.replace("w0 ", "v0 ")), (7, "z y x w v u t"), (7, "z y x w v u t"), (8, "Z y x w v u t"), (9, "lone"), (9, "Lone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [rows[i] for i in (0, 2, 3, 4, 5, 6, 8, 12)]
    assert Counter((r.doc_id, r.text) for r in J.kept_documents(df).collect()) == Counter(want)


def test_join_query(spark, sf):
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op10_ngram_join(spark, sf).collect()}
    assert got == _components(texts)


# -------------------------------------------------------------------------------- toxicity
def _toxic_docs(spark, n=1500, seed=3):
    """Texts of a made-up language whose insults begin with two stems, and their labels."""
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('lmnpr')}{rnd.choice('aeiou')}{rnd.randint(0, 30)}" for _ in range(60)]
        bad = rnd.random() < 0.15
        for _ in range(rnd.randint(1, 4) if bad else 0):
            w[rnd.randrange(60)] = rnd.choice(["grzbo", "Xulkwa"]) + rnd.choice(["t", "men", "ar", "isk"])
        docs.append((i, " ".join(w)))
        if rnd.random() < 0.5:
            labels.append((i, int(bad)))
    return docs, labels, {i: any(s in t for s in ("grzbo", "Xulkwa")) for i, t in docs}


def test_held_out_accuracy(spark):
    docs, labels, truth = _toxic_docs(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = T.score(d, known.where(~T.held_out(F.col("doc_id")))).join(d.select("doc_id", T.held_out(F.col("doc_id")).alias("out")), "doc_id").collect()
    assert len(rows) == len(docs)
    test = [(truth[r.doc_id], r.score >= 0.5) for r in rows if r.out]
    assert sum(a == b for a, b in test) >= 0.97 * len(test)


def test_label_model_recovers_rates():
    rng = np.random.default_rng(1)
    n, prior = 60_000, 0.2
    y = rng.random(n) < prior
    toxic, other = np.array([0.5, 0.4, 0.3, 0.2, 0.6]), np.array([0.02, 0.01, 0.05, 0.01, 0.03])
    votes = (rng.random((n, 5)) < np.where(y[:, None], toxic, other)).astype(float)
    votes = np.c_[votes, votes[:, 0]]  # a voter that copies the first
    model = T.LabelModel(votes.T @ votes, n, np.full((6, 2), np.nan), prior, 0)
    assert np.abs(model.toxic[:5] - toxic).max() < 0.06 and np.abs(model.other[:5] - other).max() < 0.03
    assert model.linked[0, 5] and not model.linked[0, 1]
    # labelled rows that say the opposite change nothing but what is reported of them
    wrong = np.c_[np.full(6, 3.0), np.full(6, 900.0)]
    again = T.LabelModel(votes.T @ votes, n, wrong, prior, 1000)
    assert np.array_equal(again.toxic, model.toxic) and np.array_equal(again.other, model.other)
    assert np.allclose(again.seen, [3 / 200, 900 / 800])
    one = model.posterior(np.array([[1, 0, 0, 0, 0, 0], [1, 0, 0, 0, 0, 1], [0, 0, 0, 0, 0, 0.0]]))
    assert one[1] < one[0] + 0.05 and one[2] < prior


def test_label_model_knows_nothing_of_independent_voters():
    rng = np.random.default_rng(4)
    n, prior = 80_000, 0.1
    rate = np.array([0.05, 0.1, 0.08, 0.06, 0.12, 0.09])
    votes = (rng.random((n, 6)) < rate).astype(float)
    labels = np.c_[rate * 120, rate * 20]  # as if nearly all that fires were toxic
    model = T.LabelModel(votes.T @ votes, n, labels, prior, 1200)
    sure = model.toxic * prior / (model.toxic * prior + model.other * (1 - prior))
    assert (sure < 0.3).all() and (model.posterior(np.eye(6)) < 0.5).all()


def test_label_model_with_two_languages():
    rng = np.random.default_rng(5)
    n, prior = 80_000, 0.1
    y, second = rng.random(n) < prior, rng.random(n) < 0.2
    toxic = np.where(second[:, None], [0, 0, 0, 0, 0.3, 0.4, 0.2, 0.3], [0.3, 0.25, 0.4, 0.2, 0, 0, 0, 0])
    votes = (rng.random((n, 8)) < np.where(y[:, None], toxic, 0.002)).astype(float)
    model = T.LabelModel(votes.T @ votes, n, np.full((8, 2), np.nan), prior, 0)
    sure = model.toxic * prior / (model.toxic * prior + model.other * (1 - prior))
    assert (sure > 0.75).all()
    q = model.posterior(votes)
    assert ((q > 0.5) == y)[votes.any(1)].mean() > 0.8


def test_toxicity_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = T.score(edge, none).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert T.score(empty, none).count() == 0
    twice = spark.createDataFrame([(5, 0), (5, 1), (6, None)], "doc_id long, toxic int")
    assert T.score(edge, twice).count() == 11


def test_features_are_words_and_beginnings():
    (_, n, rows, feats), = T.features(pa.array(["Idiot!", "idiots", None]))
    by = defaultdict(set)
    for r, f in zip(rows, feats, strict=True):
        by[int(r)].add(int(f))
    assert n == 3 and len(by[0]) == 2 and len(by[1]) == 3 and len(by[0] & by[1]) == 1


# -------------------------------------------------------------------------------- pipeline
def test_stages(spark, sf):
    docs = documents(spark, sf)
    cols = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = written(stage(spark, docs, sf), "test-stage")
        rows = after.collect()
        if name != "packing":
            assert after.columns == cols
            assert {r.doc_id for r in rows} <= set(before)
        if name == "near_duplicates":
            assert {r.doc_id for r in rows} == {i for i, (_, c) in _components(before).items() if i == c}
        if name == "repeated_passages":
            ids = sorted(before)
            gone = _brute_removed([_words(before[i]) for i in ids], S.LENGTH)
            for i, out in zip(ids, gone, strict=True):
                w = _words(before[i])
                assert _words(next(r.text for r in rows if r.doc_id == i)) == [x for p, x in enumerate(w) if p not in out]
        if name == "mixing":
            assert max(Counter(r.doc_id for r in rows).values()) <= 2
        if name == "packing":
            assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
        docs = after


def test_pipeline_edges(spark, edge, empty):
    for source in (edge, empty):
        docs = source
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, ""), "test-edge")
        assert docs.count() >= 0
