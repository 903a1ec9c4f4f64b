"""Token files, packing, and chat formatting."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brandpulse.llm import op03_vbyte as V
from brandpulse.llm import op05_chat as C
from brandpulse.llm import op08_pack as P
from brandpulse.llm.common import shared_dir
from brandpulse.llm.tokens import Encoder, tokenizer_path
from brandpulse.llm.words import chunks
from tokenizers import Tokenizer

ODD = ["a <|endoftext|> b", "x\t\n ab", "  lead", "trail ", "a  b", "\nq", "\xa0 z", "a\x1c b", "", " ", None, "don't stop 12,3  \n\n ok\r\n x",
       "é  b", "<|endoftext|>", "a\tb", "\tb c", " x", "日本 語 x", "x" * 3000, "ab " * 5000, "👍🏽 ok then"]


def _doubling(n):
    x, y = "a", "b"
    while len(x) < n:
        x, y = x + y, y + x
    return [x, y]


ODD += [t for n in (1024, 2048, 4096) for t in _doubling(n)] + ["so " + t + " it is" for t in _doubling(1024)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_units_give_the_library_ids(tokenizer, spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    enc = Encoder(tokenizer_path())
    for _ in range(2):  # the second time units are known
        for first, n, buf, at in chunks(pa.array(texts), 20_000):
            for t, x in zip(texts[first:first + n], enc.encode(buf, at), strict=True):
                assert x.tolist() == _ids(tokenizer, t)[:-1], t


def test_a_hit_counts_only_if_its_bytes_are_equal(monkeypatch):
    from brandpulse.llm import tokens as K
    real = K.span_hashes
    monkeypatch.setattr(K, "span_hashes", lambda *a: real(*a) % np.uint64(5))
    enc = Encoder(tokenizer_path())
    texts = [f"w{i} z{i % 7} a long word {'y' * (i % 40)}" for i in range(100)] + ODD
    for _ in range(2):
        for first, n, buf, at in chunks(pa.array(texts), 2_000):
            for t, x in zip(texts[first:first + n], enc.encode(buf, at), strict=True):
                assert x.tolist() == _ids(enc.tokenizer, t)[:-1], t


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    r = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
    control, data = V.encode_ranks(r)
    assert len(control) == -(-n // 4)
    assert (V.decode_ranks(control, data, n) == r).all()


def test_files_hold_every_document(spark, sf, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = V.op3_token_output(spark, sf).orderBy("doc_id").collect()
    start = 0
    for r, i in zip(rows, sorted(docs), strict=True):
        x = np.array(_ids(tokenizer, docs[i]), "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)


def test_file_edges(spark, edge, empty, tokenizer):
    path = shared_dir(spark, "test-ids")
    table = V.write_ids(edge, path, tokenizer_path())
    got = sorted((r.key, r.part, r.row, r.ids) for r in V.read_ids(spark, path, table).collect())
    want = sorted((r.doc_id, np.array(_ids(tokenizer, r.text), "<u4").tobytes()) for r in edge.select("doc_id", "text").collect())
    assert [(k, bytes(x)) for k, _, _, x in got] == want
    assert [k for _, _, k in sorted((p, at, k) for k, p, at, _ in got)] == [k for k, _ in want]
    path = shared_dir(spark, "test-none")
    table = V.write_ids(empty, path, tokenizer_path())
    assert V.read_ids(spark, path, table).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 300, 20_000])
def test_patterns_hold_every_piece_once(n):
    rng = np.random.default_rng(n)
    h = np.bincount(rng.integers(1, 257, n), minlength=257)
    found = P.patterns(h)
    size = np.arange(257)
    assert all((p * size).sum() <= 256 and t > 0 for t, p in found)
    assert (sum((t * p for t, p in found), np.zeros(257, np.int64)) == h).all()
    # no two pieces of over half a sequence fit together
    used, least = sum(t for t, _ in found), max(-(-int((h * size).sum()) // 256), int(h[129:].sum()))
    assert used <= least * 1.01 + 4


def _fewest(sizes, capacity):
    """The least number of sequences, by trying all."""
    best = [len(sizes)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                put(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1:])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best[0]


def test_packing_against_brute_force():
    rnd = random.Random(12)
    more = 0
    for _ in range(60):
        capacity = rnd.choice([10, 17, 30])
        sizes = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(1, 10))), reverse=True)
        used = sum(t for t, _ in P.patterns(np.bincount(sizes, minlength=capacity + 1)))
        least = _fewest(sizes, capacity)
        assert least <= used <= least + 1
        more += used - least
    assert more <= 3


def test_the_program_places_what_rounding_can_say(monkeypatch):
    rng = np.random.default_rng(3)
    h = np.bincount(np.clip(rng.lognormal(5.5, 0.8, 60_000).astype(int), 1, 1024), minlength=1025)
    used = sum(t for t, _ in P.patterns(h))
    assert used <= -(-int((h * np.arange(1025)).sum()) // 1024) * 1.0005 + 1


def test_pricing_finds_the_best_pattern():
    rnd = random.Random(1)
    value = np.array([0.0] + [rnd.random() for _ in range(12)])
    bound = np.array([0] + [rnd.randint(0, 2) for _ in range(12)])
    p = P.best_pattern(value, bound, 12)
    assert (p <= bound).all() and (p * np.arange(13)).sum() <= 12

    def best(n, room):
        if n > 12:
            return 0.0
        return max(k * value[n] + best(n + 1, room - k * n) for k in range(bound[n] + 1) if k * n <= room)

    assert (p * value).sum() == pytest.approx(best(1, 12))


def _check_packing(rows, want, capacity=1024):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    for i, ids in want.items():
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == capacity or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_query(spark, sf, tokenizer):
    docs = {r.doc_id: _ids(tokenizer, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = P.op8_packing(spark, sf).collect()
    _check_packing(rows, docs)
    assert len({r.sequence_id for r in rows}) <= 1.02 * sum(map(len, docs.values())) / 1024 + 1


def test_packing_edges(spark, edge, empty, tokenizer):
    once = edge.dropDuplicates(["doc_id"])
    rows = P.packed(once, tokenizer_path()).collect()
    _check_packing(rows, {r.doc_id: _ids(tokenizer, r.text) for r in once.select("doc_id", "text").collect()})
    assert P.packed(edge, tokenizer_path()).count() == len(rows) + 1  # the repeated row is packed again
    assert P.packed(empty, tokenizer_path()).count() == 0
    odd = spark.createDataFrame([(1, 5, "x"), (2, 1024, "y")], "id long, length long, offset string")
    assert P.pack(odd, ["id"]).columns == ["id", "length", "sequence_id", "offset"]
    with pytest.raises(Exception, match="length out of range"):
        P.pack(spark.createDataFrame([(1, 1025)], "id long, length long"), ["id"]).collect()


# ------------------------------------------------------------------------------------------ chat
TREE = "tree long, id long, parent long, role string, text string, score double"


def _brute_paths(rows):
    """Root-to-leaf paths of each tree as lists of ids, best first."""
    out = {}
    for tree in {r[0] for r in rows}:
        first = {}
        for r in sorted((r for r in rows if r[0] == tree), key=lambda r: (r[2] is not None, r[2] or 0)):
            first.setdefault(r[1], r)
        kids = defaultdict(list)
        for r in first.values():
            kids[r[2] if r[2] in first else None].append(r[1])
        found, open_ = [], [[i] for i in kids[None]]
        while open_:
            p = open_.pop()
            if kids[p[-1]]:
                open_ += [[*p, i] for i in kids[p[-1]]]
            else:
                found.append(p)
        out[tree] = sorted(found, key=lambda p: (-sum(first[i][5] or 0.0 for i in p) / len(p), p[-1]))
    return out


def test_paths_equal_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for tree in range(6):
        for i in range(1, rnd.randint(2, 25)):
            rows.append((tree, i, rnd.choice([None, *range(1, i)]) if i > 1 else None, "user", "t", float(rnd.randint(0, 8))))
    rows += [(9, i, i - 1 if i > 1 else None, "user", "deep", 0.0) for i in range(1, 71)]
    got = defaultdict(dict)
    for r in C.paths(spark.createDataFrame(rows, TREE), branches=3).collect():
        got[r.tree].setdefault(r.branch, []).append((r.depth, r.id))
    want = _brute_paths(rows)
    for tree, best in want.items():
        assert [[i for _, i in sorted(got[tree][b])] for b in sorted(got[tree])] == best[:3], tree


def test_chat_edges(spark):
    rows = [(1, 1, None, "user", "hi \\ <s> [INST] <|end|>", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b<|turn|>\\", 2.0),
            (1, 4, 3, "user", None, 5.0), (1, 5, 9, None, "orphan", None), (2, 1, 2, "x", "cycle", 0.0), (2, 2, 1, "y", "cycle", 0.0),
            (3, 1, None, "us<|text|>er\n", "", 0.0), (3, 1, None, "us<|text|>er\n", "", 0.0)]
    out = {(r.tree, r.leaf): r for r in C.format_paths(spark.createDataFrame(rows, TREE), 5).collect()}
    assert set(out) == {(1, 4), (1, 2), (1, 5), (3, 1)}  # a cycle has no root
    r = out[1, 4]
    assert C.parse(r.formatted) == [("user", "hi \\ <s> [INST] <|end|>"), ("assistant", "b<|turn|>\\"), ("user", "")]
    assert [C.unescape(r.formatted[s.start:s.end]) for s in r.loss] == ["b<|turn|>\\"]
    assert C.parse(out[3, 1].formatted) == [("us<|text|>er\n", "")]
    assert r.branch == 1 and out[1, 2].branch == 2
    for x in out.values():
        body = x.formatted.replace(C.TURN, "\0").replace(C.TEXT, "\0").replace(C.END, "\0")
        assert not any(c in body for c in C.CONTROL)
    assert C.format_paths(spark.createDataFrame([], TREE)).count() == 0


def test_null_trees_and_ids(spark):
    rows = [(None, 1, None, "user", "q", 0.0), (None, 2, 1, "assistant", "a", 0.0), (None, 3, 2, "user", "b", 0.0),
            (1, 1, None, "user", "root", 0.0), (1, None, 1, "assistant", "x", 1.0), (1, None, 1, "assistant", "y", 2.0),
            (1, None, None, "user", "alone", 0.0)]
    out = sorted(([t for _, t in C.parse(r.formatted)], r.tree, r.leaf) for r in C.format_paths(spark.createDataFrame(rows, TREE), 9).collect())
    assert out == [(["alone"], 1, None), (["q", "a", "b"], None, 3), (["root", "x"], 1, None), (["root", "y"], 1, None)]
    assert C.paths(spark.createDataFrame(rows, TREE), 9).columns == ["tree", "leaf", "id", "depth", "branch"]


def test_chat_query_with_a_null_conversation(spark, tmp_path):
    import duckdb
    from oracle_check import rows_of
    big = (1 << 60) + 1
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "there"), (None, 2, "user", "bye"), (big, 0, "user", "q"), (big, 1, "assistant", "a")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    df = C.op5_chat(spark, str(tmp_path))
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 9)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    r = con.execute(C.OP5_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 9)
    assert len(a) == 3 and a == b


def test_chat_query_matches_sql(spark, sf):
    from oracle_check import duck, rows_of
    df = C.op5_chat(spark, sf)
    a, _ = rows_of(df.columns, [tuple(r) for r in df.collect()], 9)
    r = duck(sf).execute(C.OP5_SQL)
    b, _ = rows_of([d[0] for d in r.description], r.fetchall(), 9)
    assert a == b
    probe = df.where("conv_id = -7").first()
    assert probe.n_turns == 2 and probe.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
