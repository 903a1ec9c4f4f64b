"""Winnowing, interleaving, quality rules and mixing."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from brandpulse.llm import op01_winnow as W
from brandpulse.llm import op06_interleave as I
from brandpulse.llm import op07_quality as Q
from brandpulse.llm import op09_mix as M
from pyspark.sql import functions as F

SPACE = re.compile(r"[\x20\x09-\x0d]+")


def _words(t):
    return [w for w in SPACE.split(t or "") if w]


def _hash(*xs):
    seed = 42
    for x in xs:
        seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else x.to_bytes(8, "little", signed=True), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _winnow(text, k=W.K, w=W.W):
    """Brute force: every gram from its words, every window's least gram."""
    g = [_hash(x) for x in _words(text)]
    n = max(len(g) - k + 1, 1) if g else 0
    have = 1
    while have < k:
        step = min(have, k - have)
        g = [_hash(*g[i:i + step + 1:step]) for i in range(len(g))]
        have += step
    g = g[:n]
    best = {min(range(s, min(s + w, n)), key=lambda i: (g[i] >> 31, -i)) for s in range(max(n - w + 1, min(n, 1)))}
    return [g[i] for i in sorted(best)], sorted(best)


def test_fingerprint_equals_brute_force(spark, edge):
    rows = W.fingerprint(edge.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "f").collect()
    assert len(rows) == 11
    for r in rows:
        if len(r.text) < 100_000:
            assert (r.f_hashes, r.f_positions) == _winnow(r.text), r.doc_id


def test_a_shared_run_is_always_matched(spark):
    import random
    rnd = random.Random(3)
    run = [f"s{i}" for i in range(W.K + W.W - 1)]
    texts = [" ".join([f"a{rnd.random()}" for _ in range(rnd.randint(0, 30))] + run + [f"b{rnd.random()}" for _ in range(rnd.randint(0, 30))])
             for _ in range(20)]
    prints = [set(r.f_hashes) for r in W.fingerprint(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "f").collect()]
    assert all(a & b for a in prints for b in prints)


def test_fingerprint_query(spark, sf):
    rows = W.op1_fingerprints(spark, sf).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    order = sorted(docs, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    for r in rows:
        text, add = docs[r.doc_id], docs[after[r.doc_id]]
        half = len(text) // 2
        assert r.edited_sha256 == hashlib.sha256((text[:len(text) - half] + add[:half]).encode()).hexdigest()
        if len(text) < 20_000:
            own, new, near = _winnow(text), _winnow(text[:len(text) - half] + add[:half]), _winnow(add)
            assert (r.hashes, r.positions) == own
            for got, other in ((r.near_edited, new), (r.near_next, near)):
                both = set(own[0]) | set(other[0])
                assert got == (len(set(own[0]) & set(other[0])) / len(both) if both else 1.0)
    same = defaultdict(set)
    for r in rows:
        same[docs[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values()) and len({r.fingerprint for r in rows}) > 0.9 * len(same)


def test_texts_are_shuffled_once(spark, sf, no_broadcast):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = W.op1_fingerprints(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert plan.count("ReusedExchange") == 1 and "_input_row" not in plan


def test_winnow_keeps_null_texts_and_other_columns(spark):
    d = W.edited(spark.createDataFrame([(1, None, "x"), (2, "abcd", "y"), (2, "ab", "z")], "doc_id long, text string, note string"))
    assert d.columns[:3] == ["doc_id", "text", "note"]
    assert sorted((r.doc_id, r.text, r.note, r.edited) for r in d.collect() if r.text) == [(2, "ab", "z", "a"), (2, "abcd", "y", "ab")]
    assert [(r.doc_id, r.note, r.n_chars, r.edited) for r in d.collect() if r.text is None] == [(1, "x", 0, "")]


def test_winnow_edges(spark, edge, empty):
    odd = edge
    for c in ("half", "_start", "_to", "_id", "_n", "_grams", "_window", "to", "at", "id", "begin", "edited", "next_id", "own_hashes"):
        odd = odd.withColumn(c, F.lit("mine"))
    d = W.edited(odd)
    assert set(odd.columns) <= set(d.columns) and len(d.columns) == len(set(d.columns))
    rows = d.collect()
    assert len(rows) == 11
    assert all(r.half == r._n == r._grams == r.id == r.begin == "mine" and r.edited != "mine" for r in rows)
    assert W.fingerprint(odd, "text", "f").select("_n", "_grams", "_window").distinct().count() == 1
    none = spark.createDataFrame([(None, "a b c"), (None, None), (3, "d e f g"), (3, "d e f g"), (None, "a b c")], "doc_id long, text string")
    assert W.edited(none).count() == 5
    assert W.edited(empty.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.edited for r in W.edited(one).collect()] == ["a a"]  # the only document is its own next
    assert W.edited(one).select(W.likeness(F.col("own_hashes"), F.col("next_hashes"))).first()[0] == 1.0


def test_interleave_shares_and_slots(spark, sf):
    rows = I.op6_sharding(spark, sf).collect()
    n = Counter(r.shard for r in rows)
    assert set(n) == set(range(8)) and max(n.values()) - min(n.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))
    per = Counter((r.source, r.shard) for r in rows)
    size = Counter(r.source for r in rows)
    for (source, _), k in per.items():
        assert abs(k - size[source] / 8) <= 2
    # the rank of a row is its place among its source's hashes
    again = {r.doc_id: (r.shard, r.slot) for r in I.op6_sharding(spark, sf).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_interleave_edges(spark, edge, empty):
    out = I.interleave(edge, F.col("source"), F.col("doc_id"), shards=3)
    rows = out.collect()
    assert len(rows) == 11 and sorted(Counter(r.shard for r in rows).values()) == [3, 4, 4]
    assert set(out.columns) == set(edge.columns) | {"slot"}
    assert I.interleave(empty, F.col("source"), F.col("doc_id")).count() == 0
    with pytest.raises(ValueError):
        I.interleave(edge, F.col("source"), F.col("doc_id"), shards=0)


def _places(rows, shards, seed=I.SEED):
    """Brute force of ranks within sources, fractional ranks and cuts: doc_id to (shard, slot)."""
    def mixed(key):
        h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), seed=42)
        h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed=h)
        return h - (1 << 64) if h >> 63 else h

    by = defaultdict(list)
    for doc, source in rows:
        by["n" if source is None else "s" + source].append((mixed(doc), doc))
    line = sorted(((r + 0.5) / len(some), name, h, doc) for name, some in by.items() for r, (h, doc) in enumerate(sorted(some)))
    out, total = {}, len(line)
    for p, (_, _, _, doc) in enumerate(line):
        s = p * shards // total
        out[doc] = (s, p - (s * total + shards - 1) // shards)
    return out


def test_interleave_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()]
    assert {r.doc_id: (r.shard, r.slot) for r in I.op6_sharding(spark, sf).collect()} == _places(docs, 8)
    odd = [(i, [None, "", "a", "n"][i % 7 % 4]) for i in range(-40, 61)]
    df = spark.createDataFrame(odd, "doc_id long, source string")
    assert {r.doc_id: (r.shard, r.slot) for r in I.interleave(df, F.col("source"), F.col("doc_id"), 5).collect()} == _places(odd, 5)


def test_interleave_writes_whole_shards(spark, sf, edge):
    from brandpulse.llm.common import shared_dir
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = shared_dir(spark, "test-shards")
    I.write_shards(docs, "source", "doc_id", path, shards=4)
    got = spark.read.parquet(path)
    assert got.groupBy("shard").count().count() == 4 and got.drop("shard", "slot").exceptAll(docs).count() == 0 and got.count() == docs.count()
    assert {r.doc_id: (r.shard, r.slot) for r in got.collect()} == _places([(r.doc_id, r.source) for r in docs.collect()], 4)
    # repeated and null keys, equal rows
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (None, "a", "z"), (None, None, "z"), (None, None, None)]
    path = shared_dir(spark, "test-shards")
    I.write_shards(spark.createDataFrame(rows, "doc_id long, source string, text string"), "source", "doc_id", path, shards=2)
    got = spark.read.parquet(path).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == Counter(rows) and sorted((r.shard, r.slot) for r in got) == [(s, k) for s in (0, 1) for k in range(3)]
    path = shared_dir(spark, "test-shards")
    I.write_shards(edge, "source", "doc_id", path, shards=2)
    assert spark.read.parquet(path).count() == 11


def test_quality_matches_sql(spark, sf):
    from oracle_check import duck, rows_of
    df = Q.op7_quality(spark, sf)
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 9)
    r = duck(sf).execute(Q.OP7_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 9)
    assert a == b


def test_repeat_words_by_brute_force(spark):
    import random
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcd") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 40, 300)]
    texts += [" ".join(f"x{i % 50}" for i in range(400)), " ".join(f"x{i}" for i in range(400))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in Q.judge(df).collect():
        w = _words(texts[r.doc_id])
        g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(g)
        assert r.n_repeat_words == len({p for i, x in enumerate(g) if n[x] > 1 for p in (i, i + 1, i + 2)}), r.doc_id


def test_quality_lines(spark, edge, empty):
    good = " ".join(["Plain words stand here and say a thing."] + [f"Number{i} goes{i} next{i}." for i in range(20)])
    shout = " ".join(f"BUY{i}!!" for i in range(30))
    menu = " | ".join(f"item{i}" for i in range(30)) + " |"
    texts = [good, good + "\n" + "HOME!! NOW!!", shout + "\n" + good[:20], menu, good + "\nPrivacy Policy and Terms of Use apply."]
    rows = Q.judge(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, True, False, False, True]
    assert rows[1].cleaned == good and rows[4].cleaned == good
    out = Q.judge(edge).collect()
    assert len(out) == 11 and not any(r.kept for r in out if r.doc_id in (1, 2, 3, 4))
    kept = Q.kept_documents(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} == {5, 6, 7, 10}
    assert Q.judge(empty).count() == 0 and Q.kept_documents(empty).columns == empty.columns


def test_repeated_lines_are_taken_out(spark):
    lines = [" ".join(f"w{i}x{k}" for k in range(8)) + "." for i in range(12)]
    twice = [lines[0], "", lines[1], lines[0], "", *lines[2:], lines[1], lines[0], " "]
    texts = ["\n".join(lines), "\n".join(twice), "\n".join([lines[0]] * 3)]
    rows = Q.judge(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.cleaned for r in rows] == [texts[0], "\n".join([lines[0], "", lines[1], "", *lines[2:], " "]), lines[0]]
    assert [r.n_dup_lines for r in rows] == [0, 3, 2] and [r.kept for r in rows] == [True, True, False]
    assert rows[1].lost == 0  # the first place of each stays
    kept = Q.kept_documents(spark.createDataFrame([(1, texts[1])], "doc_id long, text string")).first()
    assert kept.text == rows[1].cleaned


def test_mixing_matches_sql(spark, sf):
    from oracle_check import duck, rows_of
    df = M.op9_mixing(spark, sf)
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 6)
    r = duck(sf).execute(M.OP9_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 6)
    assert a == b


def test_targets_are_reshared_until_none_is_above(spark):
    sizes = {"a": 10, "b": 500, "c": 30, "d": 1000, None: 5}
    rows = M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    weight = dict(zip(["a", "b", "c", "d", None], [5.0, 2.0, 1.0, 5.0, 2.0], strict=True))
    left, want, free = 1.5 * sum(sizes.values()), {}, dict(weight)
    while free:
        unit = left / sum(free.values())
        over = [s for s in free if unit * free[s] >= 2 * sizes[s]]
        if not over:
            want |= {s: unit * w for s, w in free.items()}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
            del free[s]
    assert {r.source: pytest.approx(r.target) for r in rows} == want


def test_mixing_edges(spark, edge, empty):
    rows = M.mix(edge.select("doc_id", "source", "text")).collect()
    assert len(rows) == 11 and all(0 <= r.copies <= 2 for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.copies * r["size"]
    for r in rows:
        assert abs(taken[r.source] - r.target) <= max(x["size"] for x in rows if x.source == r.source)
    assert M.mixed_documents(edge).columns == edge.columns
    assert M.mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
