"""Token ids of whole texts by the tokenizers library, encoding each distinct pre-token once per worker.

A byte-level BPE merges only inside pre-tokens, so a text's ids are those of its pre-tokens in a row. The cut into
pre-tokens follows the tokenizer's published pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
and is made on bytes, for texts of ASCII and Latin letters up to U+024F. Any other text goes to the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from stratalake.llm.textbytes import segment_hashes

#: Pre-tokens kept per worker; beyond that the store starts afresh.
KEPT = 600_000

_L, _N, _S, _O, _CONT, _ODD = 0, 1, 2, 3, 4, 5


def _classes() -> np.ndarray:
    table = np.full(256, _ODD, np.uint8)
    for b in range(33, 127):
        c = chr(b)
        table[b] = _L if c.isalpha() else _N if c.isdigit() else _O
    table[[0x20, 0x09, 0x0A, 0x0D]] = _S
    table[0xC3:0xCA] = _L  # leads of U+00C0 to U+024F: letters, but for the two signs below
    table[0x80:0xC0] = _CONT
    return table


_CLASS = _classes()
_SHORT = {b"s", b"t", b"m", b"d"}
_LONG = {b"re", b"ve", b"ll"}


def plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document holds only bytes that `pretokens` knows."""
    kind = _CLASS[data]
    odd = kind == _ODD
    if len(data) > 1:
        follows = kind[1:] == _CONT
        lead = data[:-1] >= 0xC0
        odd[1:] |= follows != lead
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    if len(data):
        odd[0] |= kind[0] == _CONT
    bad = np.concatenate([[0], np.cumsum(odd)])
    return bad[offsets[1:]] == bad[offsets[:-1]]


def pretokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of plain documents; they cover all bytes."""
    n = len(data)
    kind = _CLASS[data]
    lead = np.flatnonzero(kind == _CONT)
    kind[lead] = _L
    starts = np.zeros(n + 1, bool)
    starts[1:n] = kind[1:] != kind[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    starts[begins] = True
    run = np.flatnonzero(starts[:n])
    end = np.append(run[1:], n)
    first = np.zeros(n + 1, bool)
    first[begins] = True
    what = kind[run]
    closes = first[end] | (end == n)  # the document ends with this run
    white = what == _S
    # White space before anything else gives up its last character: a space joins what follows, another stands alone.
    gives = white & ~closes
    last = end[gives] - 1
    joins = data[last] == 0x20
    starts[end[gives][joins]] = False
    starts[last] = True
    # An apostrophe that stands alone, without a space before it, takes a short ending from the letters after it.
    alone = np.flatnonzero((what == _O) & (end - run == 1) & (data[run] == 0x27) & ~closes)
    for i in alone:
        at = run[i]
        if starts[at] and i + 1 < len(run) and what[i + 1] == _L:
            letters = data[at + 1 : min(at + 3, end[i + 1])].tobytes()
            took = 1 if letters[:1] in _SHORT else 2 if letters in _LONG else 0
            if took:
                starts[at + 1] = False
                if at + 1 + took < n:
                    starts[at + 1 + took] = True
    return np.flatnonzero(starts[:n])


class Encoder:
    """Ids of many texts, flat. One per worker and vocabulary file."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a worker for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        step = model.get("pre_tokenizer") or {}
        #: Whether texts may be cut: byte-level BPE, nothing before it.
        self.cuts = (
            step.get("type") == "ByteLevel"
            and not step.get("add_prefix_space")
            and step.get("use_regex", True)
            and model["model"]["type"] == "BPE"
            and not model.get("normalizer")
        )
        self._clear()

    def _clear(self):
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.at = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]):
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        used = self.at[-1]
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(flat)] = flat
        self.place.update(zip(hashes.tolist(), range(len(self.at) - 1, len(self.at) - 1 + len(found))))
        self.at = np.concatenate([self.at, used + np.cumsum(sizes)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of UTF-8 documents data[offsets[i]:offsets[i+1]]."""
        n = len(offsets) - 1
        easy = plain(data, offsets) if self.cuts else np.zeros(n, bool)
        raw = data.tobytes()
        for mark in self.special:  # the library cuts these out of a text first
            at = raw.find(mark.encode())
            while at >= 0:
                easy[np.searchsorted(offsets, at, "right") - 1] = False
                at = raw.find(mark.encode(), at + 1)
        if easy.all():
            return self._encode_plain(data, offsets)
        sizes = np.diff(offsets)
        part = data[np.repeat(easy, sizes)]
        ids, at = self._encode_plain(part, np.concatenate([[0], np.cumsum(sizes[easy])]))
        texts = [raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in np.flatnonzero(~easy)]
        other = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.zeros(n, np.int64)
        lengths[easy] = np.diff(at)
        lengths[~easy] = [len(x) for x in other]
        out = np.zeros(lengths.sum(), np.uint32)
        mine = np.repeat(easy, lengths)
        out[mine] = ids
        if other:
            out[~mine] = np.concatenate(other)
        return out, np.concatenate([[0], np.cumsum(lengths)])

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = pretokens(data, offsets)
        ends = np.append(starts[1:], len(data))
        code, distinct = pd.factorize(segment_hashes(data, starts, ends))
        if len(self.place) + len(distinct) > KEPT:
            self._clear()
        known = np.fromiter((self.place.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(known < 0)
        if len(new):
            sample = np.zeros(len(distinct), np.int64)
            sample[code[::-1]] = np.arange(len(code))[::-1]
            raw = data.tobytes()
            self._learn(distinct[new], [raw[starts[i] : ends[i]].decode() for i in sample[new]])
            known = np.fromiter((self.place[h] for h in distinct.tolist()), np.int64, len(distinct))
        where = known[code]
        begin = self.at[where]
        sizes = self.at[where + 1] - begin
        total = np.cumsum(sizes)
        out = self.ids[np.repeat(begin - (total - sizes), sizes) + np.arange(total[-1])]
        upto = np.concatenate([[0], total])[np.searchsorted(starts, offsets)]
        return out, upto
