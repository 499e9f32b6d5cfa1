import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kindred.llm import repeats
from kindred.llm.collection_bwt import BYTES, LENGTH, repeated_starts, word_strings
from kindred.llm.repeats import remove_repeats


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - LENGTH + 1):
            if seen[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def check(make_docs, rows):
    got = sorted(tuple(r) for r in remove_repeats(make_docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    want = sorted((i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for (i, _), (n, gone, spans, kept) in zip(rows, brute([t for _, t in rows])))
    assert got == want


def test_passages_copies_and_odd_rows(make_docs):
    rnd = random.Random(5)
    passage, other = words(rnd, 160), words(rnd, 120)
    rows = [(0, None), (1, ""), (2, words(rnd, 30)), (3, "a" * 1500), (4, "ab" * 900 + words(rnd, 20))]
    rows += [(10 + i, f"{words(rnd, rnd.randint(0, 90))} {passage} {words(rnd, rnd.randint(0, 90))}") for i in range(12)]
    rows += [(30, other), (31, other), (32, f"x{other}"), (33, passage[:399]), (34, passage[:400]), (35, words(rnd, 20) + passage * 2)]
    rows += [(36, f"{words(rnd, 4000)} {passage[37:470]} {words(rnd, 1000)}")]
    check(make_docs, rows)


def test_hot_codes_are_dealt_out_and_buckets_split(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_RUNS", 3)
    rnd = random.Random(6)
    line = words(rnd, 25)
    rows = [(i, f"{words(rnd, 120)} {line} {words(rnd, 120)}") for i in range(25)]
    rows += [(100 + i, rows[i][1][50:700] + words(rnd, 80)) for i in range(6)]
    check(make_docs, rows)


def test_a_bucket_finds_what_counting_finds():
    rnd = random.Random(7)
    bodies = [bytes(rnd.choice(b"abc ") for _ in range(600)) for _ in range(20)]
    bodies += [bodies[3][100:] + b"z" * 20, bodies[17][:450]]
    bucket = repeats._Bucket()
    bucket.bodies = {(0, i): b for i, b in enumerate(bodies)}
    assert bucket.results() == [(0, 3, [100, 201]), (0, 17, [0, 51]), (0, 20, [0, 101]), (0, 21, [0, 51])]


def test_a_long_text_is_worked_on_in_pieces(make_docs, monkeypatch):
    """Repeats across the borders of pieces, and the same runs as from the whole."""
    rnd = random.Random(12)
    texts = [words(rnd, 3_000).encode(), words(rnd, 20).encode(), b"x" * 399, b"ab" * 3_000]
    frame = pd.DataFrame({"d": [b"0", b"1", b"2", b"3"], "text": [t.decode() for t in texts]})

    def starts(found):
        out = pd.concat(list(found))
        return sorted((d, c, s + i) for d, c, s, n in zip(out.d, out.code, out.start, out.n) for i in range(n))

    for kind in (BYTES, word_strings(50)):
        whole = starts(repeats._find_runs(iter([frame]), kind))
        monkeypatch.setattr(repeats, "CHUNK_UNITS", 700)
        assert starts(repeats._find_runs(iter([frame]), kind)) == whole
        assert max(len(u) for held in repeats._pieces([kind.units(t) for t in texts], kind) for _, _, u in held) < 700 + kind.length
        monkeypatch.undo()


def test_a_text_longer_than_a_piece(make_docs):
    rnd = random.Random(13)
    passage = words(rnd, 200)
    block = words(rnd, 2_000)
    long = " ".join(f"{block[: rnd.randint(200, 390)]} {i}" for i in range(5_000))
    rows = [(1, f"{long} {passage} {words(rnd, 30)}"), (2, f"{words(rnd, 30)} {passage}"), (3, long[1_048_000:1_049_500])]
    assert len(rows[0][1]) > repeats.CHUNK_UNITS
    check(make_docs, rows)


def brute_words(texts, more_than):
    """Kept text of each: words in runs of more than so many that also start elsewhere go, with the white space behind them."""
    n = more_than + 1
    split = [[(m.group(), m.start()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    seen = Counter(tuple(w for w, _ in s[i : i + n]) for s in split for i in range(len(s) - n + 1))
    out = []
    for text, s in zip(texts, split):
        gone = {i + k for i in range(len(s) - n + 1) if seen[tuple(w for w, _ in s[i : i + n])] > 1 for k in range(n)}
        data = (text or "").encode()
        edges = [start for _, start in s] + [len(data)]
        kept = data[: edges[0]] + b"".join(data[edges[i] : edges[i + 1]] for i in range(len(s)) if i not in gone)
        out.append(kept.decode())
    return out


@pytest.mark.parametrize("more_than", [50, 7])
def test_runs_of_words(make_docs, more_than):
    rnd = random.Random(20 + more_than)
    passage = [words(rnd, more_than + 1), words(rnd, more_than), words(rnd, 2 * more_than)]
    blanks = [" ", "\n", "  ", "\t\r\n", " "]
    rows = [(0, None), (1, ""), (2, words(rnd, 30)), (3, "a " * 1_500), (4, "ab cd " * 90 + words(rnd, 20)), (5, "\u00a0".join("xyz") * 200)]
    for i in range(24):
        inner = rnd.choice(passage).split(" ")
        mixed = "".join(w + rnd.choice(blanks) for w in inner)
        rows.append((10 + i, f"{words(rnd, rnd.randint(0, 90))} {mixed}{words(rnd, rnd.randint(0, 90))}"))
    rows += [(50, passage[2]), (51, passage[2]), (52, passage[1]), (53, passage[1]), (54, f" {passage[0]}\n{passage[0]}\n")]
    found = remove_repeats(make_docs(rows), word_strings(more_than), with_text=True).collect()
    got = {r.doc_id: r.kept_text for r in found}
    want = dict(zip([i for i, _ in rows], brute_words([t for _, t in rows], more_than)))
    # equal texts of enough words go as a whole, white space before the first word stays
    assert got == want
    assert all(r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest() for r in found)
    assert remove_repeats(make_docs([]), word_strings(more_than)).count() == 0


def test_word_suffix_order_against_counting():
    rnd = random.Random(30)
    for more_than in (50, 11, 2):
        kind = word_strings(more_than)
        for _ in range(12):
            pool = [np.array([rnd.getrandbits(3) for _ in range(rnd.randint(30, 200))], "<u8") for _ in range(3)]
            texts = [np.concatenate([rnd.choice(pool)[rnd.randint(0, 9) :] for _ in range(2)]) for _ in range(rnd.randint(1, 6))]
            n = kind.length
            seen = Counter(t[i : i + n].tobytes() for t in texts for i in range(len(t) - n + 1))
            for t, got in zip(texts, repeated_starts([t.tobytes() for t in texts], kind)):
                assert got.tolist() == [seen[t[i : i + n].tobytes()] > 1 for i in range(len(t) - n + 1)]


def test_no_key_collects_more_text_than_a_bucket(make_docs, monkeypatch):
    """Texts around one passage have all minimizers of the passage in common, and each another body."""
    monkeypatch.setattr(repeats, "HOT_RUNS", 3)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    plain = repeats._suffix_order

    def watched(batches):
        sizes, seen = Counter(), set()

        def passed():
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if (row.key, row.seg_hi, row.seg_lo) not in seen:
                        seen.add((row.key, row.seg_hi, row.seg_lo))
                        sizes[row.key] += len(row.body)
                assert max(sizes.values(), default=0) <= 20_000
                yield batch

        yield from plain(passed())

    monkeypatch.setattr(repeats, "_suffix_order", watched)
    rnd = random.Random(10)
    passage = words(rnd, 130)
    rows = [(i, f"{words(rnd, 40)} {passage} {words(rnd, 40)}") for i in range(120)]
    rows += [(200 + i, rows[i][1][20:600] + words(rnd, 60)) for i in range(5)] + [(300, passage * 2), (301, words(rnd, 200))]
    check(make_docs, rows)


def test_suffix_order_against_counting():
    rnd = random.Random(8)
    for _ in range(60):
        pool = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(300, 900))) for _ in range(3)]
        texts = []
        for _ in range(rnd.randint(1, 8)):
            t = b"".join(rnd.choice(pool)[rnd.randint(0, 200) :] for _ in range(2))
            texts.append(t if rnd.random() < 0.8 else (t[:9] or b"x") * 90)
        seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
        for t, got in zip(texts, repeated_starts(texts)):
            want = [seen[t[i : i + LENGTH]] > 1 for i in range(len(t) - LENGTH + 1)]
            assert np.array_equal(got, np.array(want, bool))


def test_texts_are_kept_with_all_columns(make_docs):
    rnd = random.Random(9)
    passage = "é" * 300
    rows = [(i, f"{words(rnd, 10)} {passage} {words(rnd, 10)}") for i in range(3)] + [(9, None)]
    docs = make_docs(rows)
    out = remove_repeats(docs, with_text=True)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, text in rows[:3]:
        assert passage not in got[i].kept_text and got[i].kept_text.split()[0] == text.split()[0]
        assert got[i].text == text and got[i].d == "clash"
    assert got[9].kept_text == ""


def test_empty_table(make_docs):
    assert remove_repeats(make_docs([(1, "x")]).filter(F.lit(False))).count() == 0
