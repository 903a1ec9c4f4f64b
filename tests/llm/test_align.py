"""Cross-tokenizer alignment."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brandpulse.llm import op13_align as A
from brandpulse.llm.tokens import TOKENIZER, tokenizer_path
from brandpulse.llm.words import chunks
from tokenizers import Tokenizer

ODD = ["a <|endoftext|> b", "x\t\n ab", "  lead", "trail ", "a  b", "\nq", "\n\n", "\xa0 z", "a\x1c b", "", None, " ", "</s> <s> <unk> <0x41>",
       "é  b", "日本 語 x", "x" * 3000, "ab " * 3000, "👍🏽 ok then", "a▁b ok", "é ́z", "ﬁ ½ Å ´ 　 x", "\x00 z", "\r\n a​b",
       "don't stop 12,345.67  \n\n ok\r\n x"]


@pytest.fixture(scope="module")
def encoders():
    return A.tokenizers(tokenizer_path(TOKENIZER), tokenizer_path(A.PIECES))


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(A.PIECES))


def _tokens(libraries, text):
    """(id, bytes) of both, by the libraries alone."""
    t, m = libraries
    of = A._byte_of()
    a = [(i, bytes(of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()) for i in m.encode(text)]
    return a, b


def _brute(libraries, texts):
    docs = []
    for text in texts:
        a, b = _tokens(libraries, text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            docs.append(None)
            continue
        ends = []
        for side in (a, b):
            e, at = [], 0
            for _, x in side:
                at += len(x)
                e.append(at)
            ends.append(e)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in cuts:
            i2, j2 = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            groups.append(([x for x, _ in a[i:i2]], [x for x, _ in b[j:j2]]))
            i, j = i2, j2
        docs.append((len(a), len(b), groups))
    held = Counter(p for d in docs if d for p in {(x, y) for ga, gb in d[2] for x in ga for y in gb})
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for ga, gb in d[2] for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in d[2])
        out.append((d[0], d[1], len(d[2]), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def _got(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("work", [1, 2, 7, 1000])
def test_pieces_of_a_merge_by_brute_force(work):
    rnd = random.Random(work)
    for _ in range(60):
        top = rnd.randint(1, 80)
        a = np.array(sorted(rnd.sample(range(1, top + 1), rnd.randint(0, top))) + [top + 1], np.int64)
        b = np.array(sorted(rnd.sample(range(1, top + 1), rnd.randint(0, top))) + [top + 1], np.int64)
        i, j = A.diagonals(a, b, work)
        assert (np.diff(i) + np.diff(j) <= work).all() and (i[-1], j[-1]) == (len(a), len(b))
        for x, y in zip(i, j, strict=True):  # all before the diagonal come before all behind it, a first
            assert not x or y == len(b) or a[x - 1] <= b[y]
            assert not y or x == len(a) or b[y - 1] < a[x]
        x, y = A.common_ends(a, b, work)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_tokens_are_the_libraries(encoders, libraries, spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [t for t in texts if t and "▁" not in t]
    for _ in range(2):
        for first, n, buf, at in chunks(pa.array([" " + t for t in texts]), 20_000):
            both = [e.encode(buf, at) for e in encoders]
            assert all(s.all() for s in (A._same(e, x, buf, at) for e, x in zip(encoders, both, strict=True)))
            for k in range(n):
                want = _tokens(libraries, texts[first + k])
                assert [x[k].tolist() for x in both] == [[i for i, _ in w] for w in want], texts[first + k]


@pytest.mark.parametrize("work", [3, 1 << 16])
def test_groups_of_odd_texts(encoders, libraries, work):
    texts = [t or "" for t in ODD]
    want = _brute(libraries, texts)
    (_, _, buf, at), = chunks(pa.array([" " + t for t in texts]), 1 << 30)
    x = A.aligned(*encoders, buf, at, work)
    got = list(zip(x["n_a"].tolist(), x["n_b"].tolist(), x["n_groups"].tolist(), x["n_links"].tolist(), x["sha"], strict=True))
    assert got == [(w[0], w[1], w[2], w[3], w[6]) for w in want]


def test_links_of_wide_groups(monkeypatch):
    rng = np.random.default_rng(5)
    size_a, size_b = rng.integers(1, 9, 30), rng.integers(1, 9, 30)
    a, b, doc = rng.integers(0, 4, size_a.sum()), rng.integers(0, 4, size_b.sum()), np.sort(rng.integers(0, 5, 30))

    def counted(wide):
        monkeypatch.setattr(A, "WIDE", wide)
        out = Counter()
        for d, p, n in zip(*[x.tolist() for x in A._links(a, b, size_a, size_b, doc)], strict=True):
            out[d, p] += n
        return out

    assert counted(10**6) == counted(0) == counted(12)


def test_alignment_by_brute_force(spark, libraries):
    rnd = random.Random(6)
    words = ["the", "alignment", "étude", "of", "tokenizers", "Zürich", "naïveté", "x1", "\n", "日本語"]
    texts = ODD + [" ".join(rnd.choices(words, k=rnd.randint(0, 30))) for _ in range(60)] + ["the same text"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows, pairs = A.alignment(df, tokenizer_path(TOKENIZER), tokenizer_path(A.PIECES), chunk=400)
    got = _got(rows)
    assert [got[i] for i in range(len(texts))] == _brute(libraries, texts)
    table = pairs.collect()
    assert len({(r.a, r.b) for r in table}) == len(table) and {r.a for r in table if r.best} == {r.a for r in table}


def test_edges(spark, edge, empty, libraries):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    want = sorted(zip([i for i, _ in rows], _brute(libraries, [t for _, t in rows]), strict=True))
    paths = tokenizer_path(TOKENIZER), tokenizer_path(A.PIECES)
    assert sorted((r.doc_id, tuple(r)[1:]) for r in A.alignment(edge, *paths)[0].collect()) == want
    assert A.alignment(empty, *paths)[0].count() == 0
    none = spark.createDataFrame([("k", None), (None, "a b")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.n_links) for r in A.alignment(none, *paths)[0].collect()) == [("", 2), ("k", 0)]


def test_query(spark, sf, libraries):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = _got(A.op13_alignment(spark, sf))
    assert [got[r.doc_id] for r in rows] == _brute(libraries, [r.text for r in rows])
