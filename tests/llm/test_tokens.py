"""Byte BPE and packing."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import packing
from kindred.llm.bpe import ByteBpe, decode_ids, encode_ids, round_trip
from kindred.llm.packing import CAPACITY, best_fit, pack_documents

RANKS, JSON, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
PARTS = ["a", "aa", "the", " ", "  ", "\n", "\t", "'s", "'ll", "1", "é", "漢字", "!", "...", "\x85", "\u3000", "\x1c", "ing", "<|endoftext|>", "😀", ",", "x" * 70]
ODD = [(None, "lonely"), (1, None), (2, ""), (3, " "), (4, "a b, c."), (4, "a b, c."), (5, "é漢😀" * 2000), (6, "word " * 20_000)]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(4)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(2000)]


def test_ids_equal_the_other_library(reference):
    bpe = ByteBpe.from_ranks(RANKS, PATTERN)
    for text in texts():
        ids = np.frombuffer(bpe.encode(text), "<u4")
        assert ids.tolist() == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_json_ids_equal_the_whole_tokenizer():
    bpe, whole = ByteBpe.from_json(JSON, PATTERN), Tokenizer.from_file(JSON)
    whole.encode_special_tokens = True
    for text in texts():
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


LITERALS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a<|endoftext|", "<|<|endoftext|>|>", "\n\n<|endoftext|>  \n the"]


def test_added_tokens_equal_the_whole_tokenizer():
    bpe, whole = ByteBpe.from_json(JSON, PATTERN), Tokenizer.from_file(JSON)
    assert np.frombuffer(bpe.encode_with_added(LITERALS[0]), "<u4").tolist() == [64, 220, 50256, 275]
    for text in [*LITERALS, *texts()]:
        assert np.frombuffer(bpe.encode_with_added(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packed_ids_have_the_added_tokens(make_docs):
    whole = Tokenizer.from_file(JSON)
    docs = [*enumerate(LITERALS), (50, "word <|endoftext|>" * 1500)]
    got = defaultdict(list)
    for r in pack_documents(make_docs(docs), JSON, PATTERN).collect():
        got[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for i, text in docs:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert sum(n for _, n, _ in got[i]) == len(ids)
        assert all(crc == zlib.crc32(ids[a : a + n].tobytes()) for a, n, crc in got[i])


def test_offsets_point_at_the_characters():
    bpe = ByteBpe.from_ranks(RANKS, PATTERN)
    for text in texts()[:300]:
        ids = np.frombuffer(bpe.encode(text), "<u4")
        at = 0
        for (a, b), i in zip(bpe.offsets(text, ids).tolist(), ids.tolist()):
            token = bpe.tokens[i]
            # the characters that hold any byte of the token
            first, last = len(text.encode()[:at].decode("utf-8", "ignore")), len(text.encode()[: at + len(token)].decode("utf-8", "replace"))
            assert (a, b) == (first, last)
            at += len(token)


def test_round_trip_rows(make_docs, reference):
    got = round_trip(make_docs(ODD), RANKS, PATTERN).collect()
    assert len(got) == len(ODD)
    want = sorted(
        (-1 if i is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in ODD
        for ids in [reference.encode_ordinary(t or "")]
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want
    assert round_trip(make_docs(ODD).filter(F.lit(False)), RANKS, PATTERN).count() == 0


def test_decoding_rows(make_docs):
    rows = [r for r in ODD if r[0] is not None]
    back = decode_ids(encode_ids(make_docs(rows), RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t or "") for i, t in rows)


def test_best_fit_fills_bins():
    sizes = np.array([1000, 900, 800, 700, 600, 500, 148, 100, 48])
    bins, offsets, fills = best_fit(sizes)
    assert fills.sum() == sizes.sum() and fills.max() <= CAPACITY and len(fills) == 3
    for b in range(len(fills)):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offsets[own])]
        assert offsets[own].tolist() == np.concatenate([[0], np.cumsum(sizes[own])[:-1]]).tolist()


def check_packed(rows, docs):
    """Every piece once, cut as stated, gapless, and not more sequences than needed."""
    whole = Tokenizer.from_file(JSON)
    whole.encode_special_tokens = True
    want, n_tokens = [], 0
    for i, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        n_tokens += len(ids)
        first = (len(ids) - 1) % CAPACITY + 1
        starts = [0, *range(first, len(ids), CAPACITY)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((-1 if i is None else i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(bins), n_tokens / CAPACITY


def test_packing_rows(make_docs):
    rnd = random.Random(2)
    docs = [*ODD, *((100 + i, "some words here " * rnd.randint(1, 900)) for i in range(120))]
    n_bins, least = check_packed(pack_documents(make_docs(docs), JSON, PATTERN).collect(), docs)
    assert n_bins <= 1.05 * least + 2
    assert pack_documents(make_docs(docs).filter(F.lit(False)), JSON, PATTERN).count() == 0


def test_rounds_stay_bounded_and_end(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "MAX_GROUP_ITEMS", 7)
    docs = [(i, "some words here " * (350 if i % 2 else 330)) for i in range(60)]
    check_packed(pack_documents(make_docs(docs), JSON, PATTERN).collect(), docs)
