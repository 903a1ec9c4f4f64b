"""Whole texts to token ids with the tokenizers library, inside tasks.

Byte-level BPE never joins a word with the white space after it, so a text without runs of
white space falls into units (a blank or line feed, if any, and what follows up to the next)
whose ids don't depend on their neighbours. The library encodes every unit once per worker;
its ids are then found by the unit's 64-bit hash, and count only if its bytes are those that were encoded. Texts with runs of white space, ending in one,
or with white space beyond ASCII are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from brandpulse.llm.words import chunks, lanes, runs, span_hashes, trim

TOKENIZER = "byte_bpe_50k.json"
END = 2
#: Units that an encoder of a worker remembers, unless it says otherwise.
MEMO = 1_500_000
_SPLIT = np.zeros(256, bool)
_SPLIT[[0x20, 0x0A]] = True
_RUN = re.compile(rb"[\t-\r\x1c-\x20](?:[\t-\r\x1c-\x20]|\Z)|\xc2[\x85\xa0]|\xe1\x9a\x80"
                  rb"|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: 1: ASCII white space; 2: the first byte of any white space beyond.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = 1
_KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = 2
_made: dict[str, Encoder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the vocabulary file is on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    #: Units that this encoder remembers.
    memo = MEMO

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Bytes that an id stands for: the vocabulary spells each byte as one character.
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        #: Length, first and last eight bytes of each unit: all of one up to 16 bytes. Longer ones whole.
        self.looks = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.whole: dict[int, bytes] = {}

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all units, and where each unit's begin and how many they are. Units that begin
        with a blank are encoded in a row, and the bytes that ids stand for tell where each ends."""
        lens = np.zeros(len(units), np.int64)
        special = [x.encode() for x in self.special]
        row = [i for i, u in enumerate(units) if u[0] in b" \n" and not any(x in u for x in special)]
        rest = sorted(set(range(len(units))).difference(row))
        found = []
        for k in range(0, len(row), 4096):
            some = row[k:k + 4096]
            ids = self.fast([b"".join([units[i] for i in some]).decode()])[0]
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(units[i]) for i in some])) + 1
            lens[some] = np.diff(ends, prepend=0)
            found.append(ids)
        alone = self.fast([units[i].decode() for i in rest])
        lens[rest] = [len(x) for x in alone]
        order = np.array(row + rest, np.int64)
        starts = np.zeros(len(units), np.int64)
        starts[order] = np.cumsum(lens[order]) - lens[order]
        return np.concatenate(found + alone), starts, lens

    def fast(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, units: list[bytes], looks: list[np.ndarray]) -> None:
        """Adds units; ``hashes`` ascend and are new."""
        flat, starts, lens = self._units(units)
        at = np.searchsorted(self.hashes, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + starts)
        self.lens = np.insert(self.lens, at, lens)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.looks = [np.insert(a, at, b) for a, b in zip(self.looks, looks, strict=True)]
        self.whole.update((h, u) for h, u in zip(hashes.tolist(), units, strict=True) if len(u) > 16)
        self.ids = np.concatenate([self.ids, flat])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return at, (self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool))

    def split(self, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of texts in which units don't touch, and which texts hold a unit that
        shares its hash with another unit (their ids are not right)."""
        starts, ends, before = runs(buf, at, _SPLIT)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64), np.zeros(0, np.int64)
        inner = np.ones(len(starts), bool)  # the run doesn't begin its text: the blank before belongs to it
        inner[before[:-1][before[:-1] < len(starts)]] = False
        lead = np.zeros(len(starts), bool)
        first = np.flatnonzero(~inner)
        lead[first] = ~np.isin(starts[first], at)
        starts = starts - (inner | lead)
        hashes = span_hashes(buf, starts, ends)
        looks = _looks(buf, starts, ends)
        raw = buf.tobytes()
        back, seen = pd.factorize(hashes)
        place, known = self._find(seen)
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.hashes) + len(new) > self.memo:
                self.forget()
                new = np.arange(len(seen))
            new = new[np.argsort(seen[new])]
            where = np.flatnonzero(np.diff(np.maximum.accumulate(back), prepend=-1))[new]  # where each is seen first
            self._learn(seen[new], [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], [x[where] for x in looks])
            place, _ = self._find(seen)
        place = place[back]
        other = (looks[0] != self.looks[0][place]) | (looks[1] != self.looks[1][place])
        some = np.flatnonzero(looks[0] > 8)
        other[some] |= looks[2][some] != self.looks[2][place[some]]
        long = some[looks[0][some] > 16]
        other[long] |= np.array([raw[a:b] != self.whole.get(h) for a, b, h in zip(starts[long].tolist(), ends[long].tolist(), hashes[long].tolist(), strict=True)], bool)
        lens = self.lens[place]
        upto = np.cumsum(lens)
        flat = self.ids[np.repeat(self.starts[place] - (upto - lens), lens) + np.arange(int(upto[-1]))]
        wrong = np.unique(np.searchsorted(before, np.flatnonzero(other), "right") - 1)
        return flat, np.diff(np.concatenate([[0], upto])[before]), wrong

    def encode(self, buf: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a buffer."""
        n = len(at) - 1
        raw = buf.tobytes()
        kind = _KIND[buf]
        odd = kind == 2
        odd[:-1] |= (kind[:-1] == 1) & (kind[1:] == 1)
        odd[at[1:][at[1:] > at[:-1]] - 1] |= kind[at[1:][at[1:] > at[:-1]] - 1] == 1
        some = np.unique(np.searchsorted(at, np.flatnonzero(odd), "right") - 1)
        alone = [i for i in some.tolist() if _RUN.search(raw, at[i], at[i + 1])]
        out: list = [None] * n
        if alone:
            keep = np.setdiff1d(np.arange(n), alone)
            buf = np.concatenate([buf[at[i]:at[i + 1]] for i in keep] or [buf[:0]])
            flat, lens, wrong = self.split(buf, np.concatenate([[0], np.cumsum((at[1:] - at[:-1])[keep])]))
        else:
            keep = np.arange(n)
            flat, lens, wrong = self.split(buf, at)
        upto = np.cumsum(lens)
        for i, a, b in zip(keep, upto - lens, upto, strict=True):
            out[i] = flat[a:b]
        for i in alone + keep[wrong].tolist():
            out[i] = self.fast([raw[at[i]:at[i + 1]].decode()])[0]
        return out


def _looks(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Length, first eight bytes (or all of them) and, of longer spans, last eight bytes of each span."""
    size = ends - starts
    lane = lanes(buf)
    head, tail = lane[starts], np.zeros(len(size), np.uint64)
    cut, more = np.flatnonzero(size < 8), np.flatnonzero(size > 8)
    head[cut] &= (np.uint64(1) << (size[cut].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
    tail[more] = lane[ends[more] - 8]
    return [size, head, tail]


def encoder(path: str) -> Encoder:
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def encoded(batch: pa.RecordBatch, path: str, text: str = "text", end: int | None = END) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Chunks of a batch of rows: the chunk's first row and the ids of each text (null: empty)
    with the end id appended."""
    enc = encoder(path)
    tail = np.array([] if end is None else [end], np.uint32)
    for first, _, buf, at in chunks(batch.column(batch.schema.get_field_index(text))):
        yield first, [np.concatenate([x, tail]) for x in enc.encode(buf, at)]
    trim()
