"""Token files: codes, bit streams, units and whole round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import key, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.common import scratch_table
from tidemark.llm.huffman import CHECKPOINT_IDS, MAX_BITS, Codec, canonical_codes, code_lengths
from tidemark.llm.token_files import END_ID, TOKENIZER, read_token_files, token_digest, write_token_files
from tidemark.llm.tokenize import Encoder


def best_cost(counts, limit):
    """Least total bits under the limit, by trying all length profiles."""
    counts = sorted(counts, reverse=True)
    best = None

    def go(i, last, room, cost):
        nonlocal best
        if i == len(counts):
            best = cost if best is None else min(best, cost)
            return
        for n in range(last, limit + 1):
            if room >= 2 ** (limit - n):
                go(i + 1, n, room - 2 ** (limit - n), cost + n * counts[i])

    go(0, 1, 2 ** limit, 0)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=2, max_size=6), st.integers(3, 5))
def test_lengths_are_optimal_under_the_limit(counts, limit):
    lengths = code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and (0.5 ** lengths.astype(float)).sum() <= 1
    assert int((lengths * np.array(counts)).sum()) == best_cost(counts, limit)


def test_codes_are_prefix_free_and_canonical():
    lengths = code_lengths(np.array([5, 9, 12, 13, 16, 45, 0, 1]))
    codes = canonical_codes(lengths)
    words = [format(int(c), f"0{n}b") for c, n in zip(codes, lengths) if n]
    assert not any(a != b and b.startswith(a) for a in words for b in words)
    by_length = sorted(zip(lengths.tolist(), range(len(lengths))))
    order = [codes[i] << (16 - n) for n, i in by_length if n]
    assert order == sorted(order)


@pytest.mark.parametrize("counts", [[0], [1], [CHECKPOINT_IDS], [3, 0, CHECKPOINT_IDS * 2 + 1, 1], [700, 256, 255, 257]])
def test_bit_streams_round_trip(counts):
    rng = np.random.default_rng(3)
    counts = np.array(counts)
    ids = (rng.zipf(1.2, int(counts.sum())) % 5000).astype(np.uint16)
    codec = Codec(code_lengths(np.bincount(ids, minlength=5001)))
    data, size, offsets, marks = codec.encode(ids, counts)
    assert len(data) == size.sum()
    base = np.repeat(8 * (np.cumsum(size) - size), marks)
    stretch = np.concatenate([np.minimum(CHECKPOINT_IDS, n - np.arange(0, n, CHECKPOINT_IDS)) for n in counts.tolist()])
    assert codec.decode(data, offsets + base, stretch.astype(np.int64)).tolist() == ids.tolist()


@pytest.mark.parametrize("used", [70_000, 131_073, 140_000, 1_000_000])
def test_codes_of_17_18_and_20_bits_round_trip(used):
    """More ids than 16 bits tell apart: long codes begin at every bit of a byte."""
    bits = max(MAX_BITS, (used - 1).bit_length())
    rng = np.random.default_rng(used)
    counts = np.array([3 * CHECKPOINT_IDS + 7, 0, 1, 60_000])
    often = np.ones(used, np.int64)
    often[:200] = 10_000
    codec = Codec(code_lengths(often, bits))
    assert codec.bits == bits or codec.bits > 16
    ids = np.where(rng.random(int(counts.sum())) < 0.2, rng.integers(0, 200, int(counts.sum())),
                   rng.integers(0, used, int(counts.sum()))).astype(np.uint32)
    data, size, offsets, marks = codec.encode(ids, counts)
    base = np.repeat(8 * (np.cumsum(size) - size), marks)
    stretch = np.concatenate([np.minimum(CHECKPOINT_IDS, n - np.arange(0, n, CHECKPOINT_IDS)) for n in counts.tolist()])
    assert (codec.decode(data, offsets + base, stretch.astype(np.int64)) == ids).all()


def test_units_equal_whole_texts():
    encode = Encoder(TOKENIZER)
    assert encode.by_unit
    rng = random.Random(5)
    signs = list("aabcderstvlm''''  \n\t.!?012½éÉÀ×ÿªº´ßµ") + ["\xa0", "\x85", "\x1d", "Œ", "İ", "Σ", "日", "<|endoftext|>", "'re", "'LL", "\x00", "🙂"]
    texts = ["".join(rng.choice(signs[:rng.choice([40, len(signs)])]) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    ids, counts = encode(pa.array([*texts, None]))
    ends = np.cumsum(counts)
    for t, n, e in zip(texts, counts.tolist(), ends.tolist()):
        assert ids[e - n:e].tolist() == encode.whole.encode(t, add_special_tokens=False).ids


def by_hand(rows):
    whole = Encoder(TOKENIZER).whole
    out = []
    for doc, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        out.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_files_of_odd_rows(odd):
    rows = token_digest(odd).orderBy("start").collect()
    want = by_hand([(r[0], r[1]) for r in odd_rows()])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


def test_ids_read_back(spark, odd):
    path = scratch_table(spark, "files")
    write_token_files(odd, path)
    got = {r.doc_id: r.ids for r in read_token_files(spark, path, with_ids=True).collect() if r.doc_id in (1, 9, 15)}
    whole = Encoder(TOKENIZER).whole
    for doc, text in ((r[0], r[1]) for r in odd_rows() if r[0] in got):
        assert got[doc] == [*whole.encode(text, add_special_tokens=False).ids, END_ID]


def test_many_copies_of_one_row_and_empty(spark, empty):
    docs = spark.createDataFrame([(7, "same text")] * 500 + [(9, "z")], "doc_id long, text string")
    rows = token_digest(docs).orderBy("start").collect()
    assert len(rows) == 501 and rows[-1].doc_id == 9 and len({r.start for r in rows}) == 501
    assert token_digest(empty).collect() == []
