"""Spelling variant grouping."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brandpulse.llm import op12_variants as V
from brandpulse.llm.words import chunks, runs
import pyarrow as pa

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _vocabulary(rows, least=3):
    seen = Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 5:
                seen[w] += 1
    return {w: n for w, n in seen.items() if n >= least}


def _near(words):
    """Near words by what one deletion leaves."""
    by = {}
    for w in words:
        for k in range(len(w)):
            by.setdefault((w[:k] + w[k + 1:], k), set()).add(w)  # same place deleted: one replaced
    out = {w: set() for w in words}
    for some in by.values():
        for a in some:
            out[a] |= some - {a}
    for w in words:
        for k in range(len(w)):
            x = w[:k] + w[k + 1:]
            if x in out:
                out[w].add(x)
                out[x].add(w)
    return out


def _brute(rows):
    n = _vocabulary(rows)
    near = _near(n)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def _texts(seed, docs=120):
    rnd = random.Random(seed)
    letters = "abcdeé" if seed % 2 else "abcdefghijklmnopqrstuvwxyzéÀß×"
    stems = ["".join(rnd.choices(letters, k=rnd.randint(3, 12))) for _ in range(60)] + ["aaaaa", "aaaaaa", "ababab", "bababab", "abababa", "aaaaaaaaaaaa"]
    words = list(stems)
    for w in stems:
        for _ in range(4):
            k = rnd.randrange(len(w))
            words.append(rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1:], w + w[-1], w[1:]]))
    rows = [(i, rnd.choice([" ", "-", " 1", "日"]).join(x.title() if rnd.random() < 0.2 else x for x in rnd.choices(words, k=rnd.randint(0, 80)))) for i in range(docs)]
    return rows + rows[:3] + [(None, "lonely lonely lonely lonel"), (7, None), (8, ""), (9, "x" * 5000 + " " + "y" * 70 + " " + "y" * 70 + " " + "y" * 71)] + [(10, "y" * 70)] * 3


def _got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_by_brute_force(spark, monkeypatch, seed):
    rows = _texts(seed)
    monkeypatch.setattr(V, "LIST", {1: 2, 2: 32, 3: 0}[seed])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(V.variants(df)) == _brute(rows)


def test_large_sides_are_shuffled_alike(spark, no_broadcast):
    rows = _texts(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert _got(V.variants(df)) == _brute(rows)


def test_checksums_are_those_of_the_library():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abcÀÿ xyz ", k=rnd.randint(0, 200))) for _ in range(50)] + ["q" * 500, ""]
    names = [f"{i * 7919}:".encode() for i in range(len(texts))]
    for _, n, buf, at in chunks(pa.array(texts), 1 << 20):
        starts, ends, before = runs(buf, at)
        of = np.repeat(np.arange(n), np.diff(before))
        raw = buf.tobytes()
        want = [zlib.crc32(names[d] + raw[a:b]) for d, a, b in zip(of, starts, ends, strict=True)]
        assert V.checksums(names, buf, starts, ends, of).tolist() == want


def test_near_words_share_an_entry():
    rnd = random.Random(8)
    for _ in range(3000):
        letters = "ab" if rnd.random() < 0.5 else "abcdefgh"
        w = "".join(rnd.choices(letters, k=rnd.randint(5, 14)))
        known = {"".join(rnd.choices(letters, k=rnd.randint(2, 6))): rnd.randint(1, 99) for _ in range(rnd.randint(0, 200))}
        k = rnd.randrange(len(w) + 1)
        x = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1:]])
        if len(x) < 5 or x == w:
            continue
        m = min(len(w), len(x), V.LONGEST + 2)
        a, b = [{(e[1]): (e[2], e[3]) for e in V.entries(s, known) if e[0] == m} for s in (w, x)]
        assert any(a[g][1] or b[g][1] or abs(a[g][0] - b[g][0]) <= 1 for g in a.keys() & b.keys()), (w, x)
        for s in (w, x):
            grams, affected = V.decomposed(s, known, min(V.LONGEST, m - 2))
            assert len(grams) - affected >= 1


def test_edges(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert _got(V.variants(edge)) == _brute(rows)
    assert V.variants(empty).count() == 0
    assert V.variants(spark.createDataFrame([(1, "1 2 3 ab")], "doc_id long, text string")).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = _brute(rows)
    got = _got(V.op12_variants(spark, sf))
    assert got == want and any(x[0] for x in want.values())
