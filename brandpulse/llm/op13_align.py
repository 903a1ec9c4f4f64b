r"""Cross-tokenizer alignment by merge-path partitioning.

Each text is encoded by two tokenizers, A (byte-level BPE, on a space and the text) and B (pieces, on
the text; it adds the space itself). Where a token of both ends, a group ends; every A token of a
group is linked with every B token of it.

1. The ends of both, as byte offsets, are two ascending sequences. A piece of their merge is what
   lies between two diagonals ``i + j = k * WORK``; binary search along each diagonal finds
   where the merge crosses it, so all pieces take the same work and none needs another. A piece emits
   its overlaps (ends that both have); an end that a diagonal cuts in two belongs to the piece behind
   it. What stands before the first and behind the last overlap of a piece is stitched to the
   neighbours' by putting the pieces' overlaps in a row. Texts of a stretch are merged as one sequence, as they end
   together.
2. A stretch of texts is a row: what is known of each document, the distinct id pairs of the stretch
   with the number of documents that hold them, and for each document which of these it has, how
   often. Tokens don't travel further.
3. Spark adds the pairs' documents up, takes the highest count of each A id (one row an id, so it
   may be sent everywhere), and brings every stretch its own pairs' counts back.

Tokenizers treat the strings of special tokens as plain text. A text that is null or empty, or which
the tokens don't spell byte for byte (B reads U+2581 as a space), has no tokens: zeros, and the empty
text as ``groups_sha256``. Rows that repeat are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import documents, workers_import, written
from brandpulse.llm.tokens import TOKENIZER, Encoder, tokenizer_path
from brandpulse.llm.words import chunks, trim

PIECES = "piece_bpe_32k.model"
#: Steps of a merge (ends of A and B) in one piece.
WORK = 1 << 16
#: Bytes of text in a stretch.
CHUNK = 1 << 20
#: Units that each of a worker's two encoders remembers.
MEMO = 900_000
#: Links of a group above which equal ids are put together before they are paired.
WIDE = 4096
_made: dict[tuple[str, str], tuple[Encoder, Encoder]] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens(Encoder):
    """Byte-level BPE that takes special tokens' strings as text."""

    memo = MEMO

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        of = _byte_of()
        table = {i: bytes(of.get(c, 0) for c in t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.bytes = [table.get(i, b"") for i in range(max(table) + 1)]


class PieceTokens(Encoder):
    """A sentencepiece model on texts that begin with the space it would add. None of its pieces goes
    on behind a space or beyond a line feed, so it encodes units like the other."""

    memo = MEMO

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.bytes = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) or m.is_unknown(i)
                      else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]
        self.width = np.array([len(x) for x in self.bytes], np.int64)
        self.special = ["▁"]
        self.blank = m.piece_to_id("▁")
        self.forget()

    def fast(self, texts: list[str]) -> list[np.ndarray]:
        found = self.model.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        return [np.array(x if t[:1] == " " else x[1:], np.uint32) for t, x in zip(texts, found, strict=True)]


def tokenizers(a: str, b: str) -> tuple[Encoder, Encoder]:
    if (a, b) not in _made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = ByteTokens(a), PieceTokens(b)
        for x in pair:
            at = np.concatenate([[0], np.cumsum([len(y) for y in x.bytes])])
            x.spelled = np.frombuffer(b"".join(x.bytes), np.uint8), at
        _made[a, b] = pair
    return _made[a, b]


def _ragged(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all runs that begin at ``starts``."""
    upto = np.cumsum(size)
    return np.repeat(starts - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)


def _same(enc: Encoder, ids: list[np.ndarray], buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text's tokens spell its bytes."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    data, where = enc.spelled
    size = np.diff(where)[flat]
    ends = np.concatenate([[0], np.cumsum(size)])
    before = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    good = np.diff(ends[before]) == np.diff(at)
    if good.all():  # as a rule
        other = data[_ragged(where[flat], size)] != buf
        good[np.searchsorted(at, np.flatnonzero(other), "right") - 1] = False
        return good
    for i in np.flatnonzero(good).tolist():
        good[i] = b"".join(enc.bytes[t] for t in ids[i].tolist()) == buf[at[i]:at[i + 1]].tobytes()
    return good


# ------------------------------------------------------------------------------------ merge path
def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending sequences (a first where they tie) crosses each diagonal:
    how many of a and of b come before."""
    d = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        open_ = np.flatnonzero(low < high)
        more = a[mid[open_]] <= b[d[open_] - mid[open_] - 1]
        low[open_[more]] = mid[open_[more]] + 1
        high[open_[~more]] = mid[open_[~more]]
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, i: int, i_end: int, j: int, j_end: int) -> tuple[np.ndarray, np.ndarray]:
    """The (i, j) of the ends that both have, of a piece of the merge."""
    i -= bool(i and j < j_end and a[i - 1] == b[j])  # the diagonal went between the two
    some = b[j:j_end]
    at = np.searchsorted(some, a[i:i_end])
    hit = np.flatnonzero(at < len(some))
    hit = hit[some[at[hit]] == a[i:i_end][hit]]
    return i + hit, j + at[hit]


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' overlaps in a row."""
    i, j = diagonals(a, b, work)
    parts = [overlaps(a, b, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist(), strict=True)]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *[x for x, _ in parts]]), np.concatenate([none, *[y for _, y in parts]])


# ------------------------------------------------------------------------------------ stretches
_DIGITS = [str(i).encode() for i in range(1 << 16)]
_DIGIT_AT = np.concatenate([[0], np.cumsum([len(x) for x in _DIGITS])])
_DIGIT_BYTES = np.frombuffer(b"".join(_DIGITS), np.uint8)


def _listed(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, last: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups spelled out, those of one text after another, and where each group's begin.
    ``last``: the groups that end a text."""
    at_a, at_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    ids = np.zeros(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a)) + np.repeat(at_b, size_a)] = a
    ids[np.arange(len(b)) + np.repeat(at_a + size_a, size_b)] = b
    begin = at_a + at_b
    mark[begin + size_a - 1] = ord("|")
    mark[begin + size_a + size_b - 1] = ord(";")
    size = np.diff(_DIGIT_AT)[ids] + 1
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    digits = np.ones(len(out), bool)
    digits[ends - 1] = False
    out[digits] = _DIGIT_BYTES[_ragged(_DIGIT_AT[ids], size - 1)]
    return out.tobytes(), np.append(ends - size, len(out))[np.append(begin, len(ids))]


def _links(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, id pair and number of the links; a pair may come several times."""
    wide = size_a * size_b > WIDE
    at_a, at_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    group = np.repeat(np.arange(len(size_a)), size_a)
    own = np.flatnonzero(~wide[group])
    g = group[own]
    times = size_b[g]
    pair = np.repeat(a[own].astype(np.uint64) << np.uint64(16), times) | b[_ragged(at_b[g], times)].astype(np.uint64)
    docs, pairs, n = [np.repeat(doc[g], times)], [pair], [np.ones(len(pair), np.int64)]
    for k in np.flatnonzero(wide).tolist():
        x, nx = np.unique(a[at_a[k]:at_a[k] + size_a[k]], return_counts=True)
        y, ny = np.unique(b[at_b[k]:at_b[k] + size_b[k]], return_counts=True)
        pairs.append((x.astype(np.uint64)[:, None] << np.uint64(16) | y.astype(np.uint64)).ravel())
        n.append(np.outer(nx, ny).ravel())
        docs.append(np.full(len(pairs[-1]), doc[k]))
    return np.concatenate(docs), np.concatenate(pairs), np.concatenate(n)


def _squeezed(x: np.ndarray) -> bytes:
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + len(x).to_bytes(8, "little") + pa.compress(x.astype(kind).tobytes(), "zstd", asbytes=True)


def _loosened(raw: bytes) -> np.ndarray:
    size, n = raw[0], int.from_bytes(raw[1:9], "little")
    return np.frombuffer(pa.decompress(raw[9:], n * size, "zstd", asbytes=True), f"<u{size}").astype(np.int64)


def aligned(enc_a: Encoder, enc_b: Encoder, buf: np.ndarray, at: np.ndarray, work: int = WORK) -> dict:
    """What is known of each text of a stretch (each begins with a space), and its links."""
    n = len(at) - 1
    ids_a, ids_b = enc_a.encode(buf, at), enc_b.encode(buf, at)
    good = _same(enc_a, ids_a, buf, at) & _same(enc_b, ids_b, buf, at)
    some = np.flatnonzero(good & (np.diff(at) > 1))  # a space alone stands for an empty text
    a = np.concatenate([np.zeros(0, np.uint32), *[ids_a[i] for i in some]]).astype(np.int64)
    b = np.concatenate([np.zeros(0, np.uint32), *[ids_b[i] for i in some]]).astype(np.int64)
    n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
    n_a[some], n_b[some] = [len(ids_a[i]) for i in some], [len(ids_b[i]) for i in some]
    end_a, end_b = np.cumsum(enc_a.width[a]), np.cumsum(enc_b.width[b])
    i, j = common_ends(end_a, end_b, work)
    size_a, size_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    text_end = np.cumsum(np.diff(at)[some])
    doc = some[np.searchsorted(text_end, end_a[i] if len(i) else i)]
    np.add.at(n_groups, doc, 1)
    np.add.at(n_links, doc, size_a * size_b)
    raw, begin = _listed(a, b, size_a, size_b, doc)
    shas, g = [""] * n, 0
    for d in some.tolist():
        shas[d] = hashlib.sha256(raw[begin[g]:begin[g + n_groups[d]] - 1]).hexdigest()
        g += int(n_groups[d])
    d, pair, times = _links(a, b, size_a, size_b, doc)
    key, back = np.unique(d.astype(np.uint64) << np.uint64(32) | pair, return_inverse=True)
    times = np.bincount(back, times, len(key)).astype(np.int64)
    pairs, place, docs = np.unique(key & np.uint64(0xFFFFFFFF), return_inverse=True, return_counts=True)
    held = np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=n)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "sha": shas, "held": held,
            "place": place, "times": times, "pairs": pairs.astype(np.int64), "docs": docs}


def _stretches(a: str, b: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc_a, enc_b = tokenizers(a, b)
        for batch in batches:
            for first, n, buf, at in chunks(batch.column(1), size):
                x = aligned(enc_a, enc_b, buf, at)
                one = {"stretch": pa.array([uuid.uuid4().int >> 65], pa.int64()),
                       "ids": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0).slice(first, n))}
                for k in ("n_a", "n_b", "n_groups", "n_links", "held", "pairs", "docs"):
                    one[k] = pa.array([x[k]], pa.list_(pa.int64()))
                one["sha"] = pa.array([x["sha"]], pa.list_(pa.string()))
                for k in ("place", "times"):
                    one[k] = pa.array([_squeezed(x[k])], pa.binary())
                yield pa.RecordBatch.from_arrays([one[k] for k in _COLUMNS], _COLUMNS)
            trim()
    return run


_COLUMNS = ["stretch", "ids", "n_a", "n_b", "n_groups", "n_links", "sha", "held", "place", "times", "pairs", "docs"]


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each stretch, with its pairs' counts."""
    for batch in batches:
        col = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
        for r in range(batch.num_rows):
            def of(k, r=r):
                return np.asarray(col[k][r].values.to_numpy(zero_copy_only=False))
            look = col["look"][r].values
            n_best, total = np.zeros(len(of("n_a")), np.int64), np.zeros(len(of("n_a")), np.int64)
            if look is not None and len(look):
                pair, count, best = [pc.struct_field(look, i).to_numpy(zero_copy_only=False) for i in range(3)]
                order = np.argsort(pair)
                count, best = count[order], best[order]
                place, times = _loosened(col["place"][r].as_py()), _loosened(col["times"][r].as_py())
                doc = np.repeat(np.arange(len(total)), of("held"))
                np.add.at(total, doc, count[place] * times)
                np.add.at(n_best, doc, best[place] * times)
            yield pa.RecordBatch.from_arrays([col["ids"][r].values, *[pa.array(of(k), pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")],
                                              pa.array(n_best), pa.array(total), col["sha"][r].values],
                                             ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    trim()


def alignment(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (``doc_id, text``) ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``; and ``a, b, n, best`` per pair of ids: the documents that hold it linked, and
    whether that is the most of its A id."""
    workers_import(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.concat(F.lit(" "), F.coalesce("text", F.lit(""))).alias("text"))
    lists = ", ".join(f"{k} array<long>" for k in ("n_a", "n_b", "n_groups", "n_links"))
    rows = written(src.mapInArrow(_stretches(path_a, path_b, chunk), f"stretch long, ids array<{kind}>, {lists}, sha array<string>, held array<long>, "
                                  "place binary, times binary, pairs array<long>, docs array<long>"), "align-stretches", "zstd")
    pairs = rows.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
    pairs = written(pairs.withColumn("a", F.shiftright("pair", 16)), "align-pairs")
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))  # a row per id of the vocabulary
    counts = written(pairs.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "align-counts")
    look = rows.select("stretch", F.explode("pairs").alias("pair")).join(counts, "pair").groupBy("stretch").agg(
        F.collect_list(F.struct("pair", "n", "best")).alias("look"))
    found = rows.drop("pairs", "docs").join(look, "stretch", "left")
    result = found.mapInArrow(_results, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return result, counts.select(F.shiftright("pair", 16).alias("a"), F.col("pair").bitwiseAND(0xFFFF).alias("b"), "n", (F.col("best") == 1).alias("best"))


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path(TOKENIZER), tokenizer_path(PIECES))[0]
