"""Whole texts to token ids with the tokenizers library, units encoded once.

A tokenizer that first normalises, then splits texts by the letter / digit /
other pattern below and drops white space gives each such unit the same ids
wherever it stands.  For texts of Latin-1 characters, units are found and hashed
in numpy and only units not met before go to the library; any other text goes
through it whole, as do all texts of a tokenizer that splits differently.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa

from tidemark.llm.words import hashes, offsets_of, ragged

# Fixed value: the split pattern whose units are found here.
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Units remembered by a worker; further ones are encoded anew in each batch.
MAX_KNOWN = 2_000_000

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def _kind(c: str) -> int:
    return SPACE if c.isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)


_KIND = np.array([_kind(chr(i)) for i in range(256)], np.uint8)
_LOWER = np.array([ord(chr(i).lower()) for i in range(256)], np.uint8)
# Two-byte lead bytes of Latin-1; higher ones, control characters on which
# notions of white space differ, and "<|" send a text to the library.
_ODD_BYTE = np.zeros(256, bool)
_ODD_BYTE[0xC4:] = True
_ODD_BYTE[0x1C:0x20] = True


def resolve(tokenizer: str) -> str:
    """A path, or the name of a file of the installed public tokenizers."""
    if os.path.sep in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


class Encoder:
    """Encodes batches of texts; one per worker process."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        path = resolve(tokenizer)
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_unit = self._splits_into_units(spec)
        self.dtype = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        if self.by_unit:
            self.unit = Tokenizer(self.whole.model)
            self.unit.normalizer = normalizers.Sequence([])
            self.unit.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known = np.zeros(0, np.uint64)  # sorted hashes, and where their ids lie
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    @staticmethod
    def _splits_into_units(spec: dict) -> bool:
        norm = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (norm == ["NFC", "Replace", "Lowercase"] and len(pre) == 2
                and pre[0].get("pattern") == {"Regex": UNIT_PATTERN} and pre[0].get("invert") is True
                and pre[0].get("behavior") == "Removed"
                and pre[1].get("type") == "ByteLevel" and not pre[1].get("use_regex"))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and the count of each (null: empty)."""
        off = offsets_of(texts)
        size = np.diff(off)
        off0 = off - off[0]
        counts = np.zeros(len(size), np.int64)
        if not off0[-1]:
            return np.zeros(0, self.dtype), counts
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]
        odd = self._odd(raw, off0) if self.by_unit else size > 0
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        plain = np.flatnonzero(~odd & (size > 0))
        if len(plain):
            ids, n = self._by_units(raw, off0, plain)
            counts[plain] = n
            parts.append((plain, ids))
        rest = np.flatnonzero(odd)
        if len(rest):
            got = [np.array(x.ids, self.dtype) for x in self.whole.encode_batch_fast(
                [texts[int(i)].as_py() for i in rest], add_special_tokens=False)]
            counts[rest] = [len(x) for x in got]
            parts.append((rest, np.concatenate(got)))
        if len(parts) == 1:
            return parts[0][1], counts
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), self.dtype)
        for rows, ids in parts:
            out[ragged(starts[rows], counts[rows])] = ids
        return out, counts

    @staticmethod
    def _odd(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        odd = _ODD_BYTE[raw]
        odd[:-1] |= (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
        odd[:-1] |= (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
        hits = np.searchsorted(off, np.flatnonzero(odd), side="right") - 1
        out = np.zeros(len(off) - 1, bool)
        out[hits] = True
        return out

    def _by_units(self, raw: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) < len(off) - 1:
            size = np.diff(off)[rows]
            raw = raw[ragged(off[:-1][rows], size)]
            off = np.concatenate([[0], np.cumsum(size)])
        # UTF-8 of Latin-1 characters to one byte each
        lead = (raw == 0xC2) | (raw == 0xC3)
        chars = raw.copy()
        chars[1:] += np.where(raw[:-1] == 0xC3, 0x40, 0).astype(np.uint8)
        at = np.flatnonzero(~lead)
        off = np.searchsorted(at, off)
        chars = _LOWER[chars[at]]
        start, end = self._units(chars, off)
        h, first, inverse = np.unique(hashes(chars, start, end), return_index=True, return_inverse=True)
        where, n = self._ids_of(h, chars, start[first], end[first])
        where, n = where[inverse], n[inverse]
        ids = self.ids_now[ragged(where, n)]
        per_text = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(start, off)]
        return ids, np.diff(per_text)

    @staticmethod
    def _units(chars: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _KIND[chars]
        border = np.zeros(len(chars) + 1, bool)
        border[off] = True
        border[-1] = True
        begins = np.ones(len(chars), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | border[1:-1]
        begins &= kind != SPACE
        # an apostrophe that begins a unit takes s, t, m, d, re, ve or ll with it
        p = np.flatnonzero(begins & (chars == 39))
        p = p[~border[p + 1]]
        if len(p):
            a = chars[p + 1]
            two = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            q = np.minimum(p + 2, len(chars) - 1)
            b = np.where(border[p + 2 - (p + 2 > len(chars))] | (p + 2 >= len(chars)), 0, chars[q])
            three = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
            for hit, k in ((p[two], 2), (p[three], 3)):
                begins[hit + 1] = False
                after = hit + k
                after = after[after < len(chars)]
                begins[after[kind[after] == LETTER]] = True
        stop = border.copy()
        stop[:-1] |= begins | (kind == SPACE)
        stops = np.flatnonzero(stop)
        start = np.flatnonzero(begins)
        return start, stops[np.searchsorted(stops, start, side="right")]

    def _ids_of(self, h: np.ndarray, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and count of each unit's ids within ``ids_now``."""
        k = np.searchsorted(self.known, h)
        k[k == len(self.known)] = 0
        there = self.known[k] == h if len(self.known) else np.zeros(len(h), bool)
        where, n = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        where[there], n[there] = self.at[k[there]], self.n[k[there]]
        new = np.flatnonzero(~there)
        self.ids_now = self.ids
        if len(new):
            got = self._encode([chars[i:j].tobytes().decode("latin-1") for i, j in zip(start[new].tolist(), end[new].tolist())])
            n[new] = [len(x) for x in got]
            where[new] = len(self.ids) + np.cumsum(n[new]) - n[new]
            self.ids_now = np.concatenate([self.ids, np.fromiter((i for x in got for i in x), self.dtype)])
            if len(self.known) + len(new) <= MAX_KNOWN:
                self.ids = self.ids_now
                put = np.searchsorted(self.known, h[new])
                self.known = np.insert(self.known, put, h[new])
                self.at = np.insert(self.at, put, where[new])
                self.n = np.insert(self.n, put, n[new])
        return where, n

    def _encode(self, units: list[str]) -> list[list[int]]:
        model, out = self.unit.model, []
        byte_level = []
        for i, u in enumerate(units):
            if u.isascii() and u.isprintable():
                out.append([t.id for t in model.tokenize(u)])
            else:
                byte_level.append(i)
                out.append([])
        if byte_level:
            for i, x in zip(byte_level, self.unit.encode_batch_fast([units[i] for i in byte_level], add_special_tokens=False)):
                out[i] = x.ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    """This process's encoder for the tokenizer."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]
