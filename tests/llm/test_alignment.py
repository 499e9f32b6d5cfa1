"""Token alignment against the tokenizer libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import alignment, queries
from kindred.llm.bpe import as_bytes

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[2])


def _tokens(libraries, text):
    """[(id, bytes)] of both sides, None where they have no tokens."""
    a, b = libraries
    if not text:
        return None
    left = a.encode(" " + text, add_special_tokens=False)
    left = [(i, as_bytes(t)) for i, t in zip(left.ids, left.tokens)]
    right = [(i, alignment.PieceModel._bytes(b.id_to_piece(i))) for i in b.encode(text)]
    data = (" " + text).encode()
    return (left, right) if all(b"".join(t for _, t in side) == data for side in (left, right)) else None


def _brute(libraries, rows):
    """Groups by walking both sides to the places where both end."""
    listed = []
    for doc_id, text in rows:
        tokens = _tokens(libraries, text)
        groups = []
        if tokens:
            left, right = tokens
            i = j = ends_left = ends_right = 0
            current = ([], [])
            while i < len(left) or j < len(right):
                if ends_left <= ends_right:
                    current[0].append(left[i][0])
                    ends_left += len(left[i][1])
                    i += 1
                else:
                    current[1].append(right[j][0])
                    ends_right += len(right[j][1])
                    j += 1
                if ends_left == ends_right:
                    groups.append(current)
                    current = ([], [])
        listed.append((doc_id, groups))
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for _, groups in listed]
    counts = Counter(pair for link in links for pair in link)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (doc_id, groups), link in zip(listed, links):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(link.values()),
                sum(n for pair, n in link.items() if counts[pair] == best[pair[0]]), sum(n * counts[pair] for pair, n in link.items()),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


ODD = [
    "", None, " ", "   ", "a", " a", "a ", "a  b   c ", "<|endoftext|> in text", "<s>x</s><unk>", "x▁y", "a\x00b", "tab\tand\r\nlines\n\n",
    "日本語のテキスト、 混在 text", "naïve café ﬁ é", "🎉🎉 👩‍👩‍👧 x🎉", "a" * 3_000, "ab" * 2_000 + " end", "=" * 777, " " * 500 + "x", "don't 3.14 won't",
    "\x1c x\x85 y z 　 w", "zażółć gęślą jaźń", "a", "a",
]


def test_odd_texts_equal_plain_loops(spark, libraries, make_docs):
    rows = list(enumerate(ODD)) + [(None, "no id here"), (3, "twice"), (3, "twice")]
    docs = make_docs(rows).withColumn("codes", F.lit("clash")).withColumn("times", F.lit("clash")).withColumn("n_docs", F.lit(1))
    assert _found(alignment.align_tokenizers(docs, *PATHS)) == _brute(libraries, rows)


def _random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = ["a", "e", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "東", "🎈", ".", ",", "1", "23", "'s", "_", " ", "<0x0A>", "X"]
    return [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_random_texts_equal_plain_loops(spark, libraries, make_docs, monkeypatch, small):
    """With small limits: texts in pieces, wide groups, portions of pairs, joins by shuffle."""
    if small:
        for name, value in (("CHUNK_CHARS", 30), ("ROW_PAIRS", 3), ("WIDE_GROUP", 2)):
            monkeypatch.setattr(alignment, name, value)
    rows = _random_texts(300, 11)
    docs = make_docs(rows, clash=False).coalesce(1)
    found = alignment.align_tokenizers(docs, *PATHS, shipped_pairs=0 if small else 10**6)
    assert _found(found) == _brute(libraries, rows)


def test_a_text_of_several_pieces(spark, libraries, make_docs):
    rng = random.Random(2)
    words = ["alpha", "東京", "x" * 9, "don't", "3.14", "naïve", "\n", "", "=" * 40, "zig"]
    long = " ".join(rng.choices(words, k=450_000))
    assert len(load_pieces_of(long)) > 1
    rows = [(1, long), (2, "alpha zig"), (3, "")]
    assert _found(alignment.align_tokenizers(make_docs(rows, clash=False), *PATHS)) == _brute(libraries, rows)


def load_pieces_of(text):
    return alignment.load_aligner(*PATHS).ids(text)


def test_portions_and_pieces_in_one_process(libraries, monkeypatch):
    """What the tasks do with small limits, in this process."""
    aligner = alignment.load_aligner(*PATHS)
    texts = [text for _, text in _random_texts(80, 5) if aligner.ids(text)]
    whole = alignment.Groups(aligner, [aligner.ids(text)[0] for text in texts])
    (expected,) = whole.pairs()
    monkeypatch.setattr(alignment, "ROW_PAIRS", 5)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 2)
    portions = list(whole.pairs())
    assert len(portions) > 1
    joined = np.concatenate([np.array(p).T for p in portions])
    assert sorted(map(tuple, joined.tolist())) == sorted(map(tuple, np.array(expected).T.tolist()))
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 20)
    for text in texts:
        pieces = aligner.ids(text)
        for side in (0, 1):
            monkeypatch.undo()
            assert np.concatenate([p[side] for p in pieces]).tolist() == aligner.ids(text)[0][side].tolist()
            monkeypatch.setattr(alignment, "CHUNK_CHARS", 20)


def test_pointers_reach_the_end_of_long_chains():
    """Boundaries that never meet but at the end: one group, found in few doublings."""
    n = 50_000
    of_a, of_b, groups = alignment.group_labels(np.full(n, 2), np.array([1, *[2] * (n - 1), 1]))
    assert groups == 1 and not of_a.any() and not of_b.any()
    of_a, of_b, groups = alignment.group_labels(np.array([1, 2, 3]), np.array([3, 1, 2]))
    assert (of_a.tolist(), of_b.tolist(), groups) == ([0, 0, 1], [0, 1, 1], 2)


def test_word_by_word_equals_the_model(libraries, spark, sf_dir):
    model = alignment.load_pieces(PATHS[2])
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in [*texts, *(t for t in ODD if t and "▁" not in t), *(t for _, t in _random_texts(2_000, 3) if t)]:
        assert np.frombuffer(model.encode(text), "<u4").tolist() == (libraries[1].encode(text) if text else model.model.encode(text) or [model.model.piece_to_id("▁")])


def test_empty_table(make_docs):
    assert alignment.align_tokenizers(make_docs([]), *PATHS).count() == 0


def test_query_equals_plain_loops(spark, libraries, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert _found(queries.op12_tokenizer_alignment(spark, sf_dir)) == _brute(libraries, rows)
