"""Benchmark decontamination."""

import hashlib
import random
import re

import pytest
from brandpulse.llm import op11_leaks as L
from pyspark.sql import functions as F

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(t):
    return WORD.findall((t or "").translate(LOWER))


def _brute(docs, items, window=10):
    """(n_words, n_hit, item names) of each text."""
    wins = {}
    for name, t in items:
        w = _words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if name is None else str(name))
    sizes = {len(x) for x in wins}
    out = []
    for t in docs:
        w = _words(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


def _case(seed):
    rnd = random.Random(seed)
    pool = [f"w{i}" for i in range(30)] + ["été", "日本", "X9"]
    items = [(i, " ".join(rnd.choices(pool, k=rnd.choice([1, 2, 3, 4, 5, 9, 10, 11, 25, 60])))) for i in range(25)]
    items += [(3, "another text of item three, which is long enough for two windows!"), (None, "an item without name"), (77, None), (78, "!! --"), (79, "w1")]
    docs = []
    for _ in range(60):
        w = rnd.choices(pool, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            x = _words(rnd.choice(items)[1])
            a = rnd.randint(0, max(0, len(x) - 1))
            at = rnd.randint(0, len(w))
            w[at:at] = x[a:a + rnd.randint(1, 40)]
        docs.append(rnd.choice([" ", ", ", "\n"]).join(w).title())
    return docs + docs[:5] + [None, "", " ", "w1", items[6][1] * 3, " ".join(items[i][1] for i in range(25))], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hits_by_brute_force(spark, seed):
    docs, items = _case(seed)
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in L.screened(d, b).collect()}
    assert [got[i] for i in range(len(docs))] == _brute(docs, items)


def test_large_sides_are_shuffled_alike(spark, no_broadcast):
    docs, items = _case(9)
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in L.screened(d, b, ["doc_id"]).collect()}
    assert [got[i] for i in range(len(docs))] == _brute(docs, items)


def test_bitmap_has_the_bits_of_all_shingles(spark):
    rnd = random.Random(1)
    g = [rnd.getrandbits(63) - (1 << 62) for _ in range(500)]
    bits = L._bitmap(spark.createDataFrame([(x,) for x in g], "g long"))
    assert len(bits) == 1 << (L.BITS - 3)
    assert {i for i in range(len(bits) * 8) if bits[i >> 3] >> (i & 7) & 1} == {x & ((1 << L.BITS) - 1) for x in g}


def test_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, "lone words here"), (2, " ".join(f"w{i}" for i in range(40)))], "item_id int, text string")
    rows = L.screened(edge.withColumn("n_hit", F.lit("x")).withColumn("runs", F.lit(1)), bench).collect()
    assert len(rows) == 11
    hit = sorted((r.doc_id, r.n_hit) for r in rows if r.n_hit)
    assert hit == [(5, 40), (6, 40), (7, 40), (8, 3), (8, 3)]
    kept = L.kept_documents(edge, bench)
    assert kept.columns == edge.columns and kept.count() == 6
    assert L.screened(empty, bench).count() == 0
    none = bench.limit(0)
    assert L.screened(edge, none).where("n_hit > 0").count() == 0 and L.kept_documents(edge, none).count() == 11


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in L.op11_decontamination(spark, sf).collect()}
    want = {d.doc_id: (n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0)
            for d, (n, h, f) in zip(docs, _brute([d.text for d in docs], items), strict=True)}
    assert got == want and any(x[4] for x in want.values())


def test_query_matches_sql(spark, sf):
    from oracle_check import duck, rows_of
    df = L.op11_decontamination(spark, sf)
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 9)
    r = duck(sf).execute(L.OP11_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 9)
    assert a == b
