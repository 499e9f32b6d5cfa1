"""SimHash groups, and the whole pipeline."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import simhash
from kindred.llm.components import connected_components
from kindred.llm.simhash import fingerprint, links, near_duplicates, position_sets, representatives


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest member each fingerprint reaches over links of at most three bits."""
    fps = sorted(set(fps))
    least = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(fps, 2):
            if (a ^ b).bit_count() <= 3 and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def test_every_five_positions_hold_a_set():
    sets = [set(s) for s in position_sets()]
    assert len(sets) == 14 and all(len(s) == 4 for s in sets)
    assert all(any(s <= set(five) for s in sets) for five in itertools.combinations(range(8), 5))


def test_fingerprints():
    for text in ("", " \n", "One", "one two", "a b c", "A B C d e f g", "é É x y z", "x " * 70_000):
        assert fingerprint(text) == brute_fingerprint(text)


def clustered(rnd, n):
    """Fingerprints, half of them few bits away from others."""
    out = [rnd.getrandbits(64) for _ in range(n // 2)]
    while len(out) < n:
        f = rnd.choice(out)
        for bit in rnd.sample(range(64), rnd.randint(1, 5)):
            f ^= 1 << bit
        out.append(f)
    return sorted(set(out))


@pytest.mark.parametrize("direct", [2, 4096])
def test_links_against_all_pairs(spark, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT_MEMBERS", direct)
    rnd = random.Random(11)
    fps = clustered(rnd, 400)
    base = rnd.getrandbits(64)
    fps = sorted({*fps, *(base ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(20), 2))})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    found = links(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()
    pairs = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in ((r.a, r.b) for r in found)]
    least = brute_components(fps)
    assert all(least[a] == least[b] for a, b in pairs)
    again = {f: f for f in fps}
    for _ in range(len(fps)):
        before = dict(again)
        for a, b in pairs:
            again[a] = again[b] = min(again[a], again[b])
        if again == before:
            break
    assert again == least


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {n: r for n, r in got.items() if n <= 40} == dict.fromkeys(range(41), 0)
    assert all(got[100 + i] == 100 for i in range(30)) and got[201] == 200
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_texts():
    rnd = random.Random(1)
    words = ["w%d" % i for i in range(400)]
    rows = [(None, "alone here again"), (1, None), (2, ""), (3, " \t"), (4, "Same text here"), (4, "Same text here"), (5, "same TEXT here")]
    for g in range(6):
        base = [rnd.choice(words) for _ in range(600)]
        for c in range(5):
            own = list(base)
            for _ in range(c):
                own[rnd.randrange(600)] = "changed"
            rows.append((100 * (g + 1) + c, " ".join(own)))
    return rows


def test_near_duplicates_against_all_pairs(make_docs):
    rows = near_texts()
    fps = [brute_fingerprint(t) for _, t in rows]
    least = brute_components(fps)
    first = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            first[least[f]] = min(first.get(least[f], i), i)
    want = sorted((-1 if i is None else i, f"{f:016x}", first.get(least[f], -1)) for (i, _), f in zip(rows, fps))
    got = sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in near_duplicates(make_docs(rows)).collect())
    assert got == want
    docs = make_docs(rows)
    kept = representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert near_duplicates(docs.filter(F.lit(False))).count() == 0 and representatives(docs.filter(F.lit(False))).count() == 0


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage against a plain statement of what it has to do with its input."""
    from test_near_texts import _brute
    from test_repeats import brute_words

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], sf_dir).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    rules, exact, near, cut, packed = ({r.doc_id: r for r in t.collect()} if t is not tables[-1] else t.collect() for t in tables[1:])
    assert all(t.columns == docs.columns for t in tables[1:5])

    base = {r.doc_id: r for r in docs.collect()}
    words = {i: (r.text or "").split() for i, r in base.items()}
    assert set(rules) <= {i for i, w in words.items() if len(w) >= 20} and all(rules[i] == base[i] for i in rules)
    bare = {}
    for i, r in rules.items():
        key = "".join((r.text or "").split())
        bare[key] = min(bare.get(key, (0, i)), (-len(r.text), i))
    assert set(exact) == {i for _, i in bare.values()}
    # five words and a similarity of 0.8, over all pairs
    assert sorted(near) == _brute([(i, r.text) for i, r in exact.items()])
    order = sorted(near)
    for i, kept in zip(order, brute_words([near[i].text for i in order], 50)):
        assert cut[i].text == kept and cut[i].n_chars == len(cut[i].text)
    assert {r.doc_id for r in packed} == set(near)
    # a run leaves results alone that others of the same application still read
    other = near_duplicates(docs)
    assert len(corpus_pipeline.run(spark, sf_dir).columns) == 7
    assert other.count() == len(base)


def test_stages_with_odd_rows(spark, make_docs, tmp_path):
    """Nulls in any column, empty texts, repeated rows and an empty table pass every stage."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    labels = pa.table({"doc_id": pa.array([1, None, 2], pa.int64()), "quality": pa.array([1, 0, None], pa.int32()), "toxic": pa.array([0, 0, 0], pa.int32())})
    pq.write_table(labels, f"{tmp_path}/labels.parquet")
    text = " ".join(f"word{i}" for i in range(70))
    rows = [(1, text), (1, text), (None, text + " more"), (2, None), (3, ""), (4, "few words"), (5, f"{text} tail of its own")]
    for n, rows in enumerate((rows, [])):
        docs = make_docs(rows, clash=False).withColumn("lang", F.lit(None).cast("string"))
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{n}-{name}")
            columns = docs.columns
            docs = spark.read.parquet(f"{tmp_path}/{n}-{name}")
            if name != "best_fit_packing":
                assert docs.columns == columns
            if name == "near_dedup":
                assert [r.doc_id for r in docs.collect()] == ([1] if rows else [])
        assert docs.count() == (1 if rows else 0)
