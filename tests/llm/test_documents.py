"""Quality rules, exact duplicates, line field."""

import os
import math
import subprocess
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kindred.llm import quality_rules
from kindred.llm.exact_dedup import DigestIndex, deduplicate, new_documents
from kindred.llm.line_crf import fit_field, score_documents
from kindred.llm.quality_rules import judge, kept_documents
from kindred.session import WorkScope

ODD = [(None, "lonely words"), (1, None), (2, ""), (3, " \t\n "), (4, "a b"), (4, "a b"), (5, "a  b"), (6, "x" * 200_000)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_exact_dedup_cases(spark, make_docs):
    out = deduplicate(make_docs(ODD), DigestIndex(spark, buckets=4))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.kept) for r in out.collect())
    # the longest original stays: five has two blanks between the same letters, three has blanks only
    assert got == [
        (-1, None, 1, True), (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 5, 3, False), (4, 5, 3, False), (5, 5, 3, True),
        (6, 6, 1, True),
    ]


def test_repeated_row_stays_once(spark, make_docs):
    out = deduplicate(make_docs([(7, "same"), (7, "same"), (8, "same")]), DigestIndex(spark, buckets=4)).collect()
    assert sorted((r.doc_id, r.kept) for r in out) == [(7, False), (7, True), (8, False)]


def test_index_outlives_a_batch(spark, make_docs):
    index = DigestIndex(spark, buckets=4)
    assert new_documents(make_docs([(1, "one"), (2, "two"), (3, "t wo")]), index).count() == 2
    second = make_docs([(4, "two"), (5, "five")])
    judged = {r.doc_id: r for r in deduplicate(second, index).collect()}
    assert (judged[4].keep_id, judged[4].kept, judged[4].group_size) == (3, False, 3)
    assert judged[5].kept
    assert new_documents(second, index).count() == 0
    plan = spark.table(index.name).select("text_sha256")._jdf.queryExecution().toString()
    assert "Bucketed: " in plan


OTHER_SESSION = """
import sys
from kindred import build_session
from kindred.llm.exact_dedup import DigestIndex, new_documents
spark = build_session("other", master="local[2]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false",
                      spark__sql__warehouse__dir=sys.argv[1] + "/warehouse")
docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "t wo")], "doc_id bigint, text string")
print("kept", new_documents(docs, DigestIndex(spark, "lasting_digests", path=sys.argv[1] + "/index", buckets=3)).count())
"""


def test_index_outlives_the_session(spark, make_docs, tmp_path):
    root = Path(__file__).resolve().parents[2]
    first = subprocess.run([sys.executable, "-c", OTHER_SESSION, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=120)
    assert "kept 2" in first.stdout, first.stderr[-2000:]
    index = DigestIndex(spark, "lasting_digests", path=f"{tmp_path}/index", buckets=4)
    judged = {r.doc_id: r for r in deduplicate(make_docs([(4, "two"), (5, "five")]), index).collect()}
    assert (judged[4].keep_id, judged[4].kept, judged[4].group_size) == (3, False, 3)
    assert judged[5].kept and index.buckets == 3
    assert sorted(r.keep_id for r in spark.read.parquet(f"{tmp_path}/index").collect()) == [1, 3, 5]
    with pytest.raises(ValueError, match="lies in"):
        DigestIndex(spark, "lasting_digests", path=f"{tmp_path}/elsewhere").rows()
    spark.range(1).write.parquet(f"{tmp_path}/foreign")
    with pytest.raises(ValueError, match="number of buckets"):
        DigestIndex(spark, path=f"{tmp_path}/foreign").rows()


def test_only_a_nameless_index_goes_with_its_scope(spark, make_docs, tmp_path):
    with WorkScope() as scope:
        own = DigestIndex(spark, buckets=4)
        lasting = DigestIndex(spark, "outlives_scopes", path=f"{tmp_path}/outlives", buckets=4)
        assert "Bucketed: " in own.rows()._jdf.queryExecution().toString()
        for index in (own, lasting):
            assert new_documents(make_docs([(1, "one")]), index).count() == 1
    scope.drop(spark)
    assert not spark.catalog.tableExists(own.name) and not os.path.exists(own.path)
    assert new_documents(make_docs([(2, "one"), (3, "three")]), lasting).count() == 1
    lasting.drop()
    assert not spark.catalog.tableExists(lasting.name) and not os.path.exists(lasting.path)


def test_new_documents_keeps_columns(spark, make_docs):
    docs = make_docs(ODD)
    out = new_documents(docs, DigestIndex(spark, buckets=4))
    assert out.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == [-1, 3, 5, 6]
    assert new_documents(docs.filter(F.lit(False)), DigestIndex(spark, buckets=4)).count() == 0


def repeat_words(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(covered)


def test_features_against_counting(spark, make_docs):
    text = "a b c d e f g h i\na b c d e f g h j\n\n \na b c d e f g h j\nx#*$%&|<>y é"
    rows = [*ODD, (9, text), (10, "w " * 50)]
    got = {r.doc_id: r for r in judge(make_docs(rows), labels(spark, [])).collect()}
    for i, t in rows:
        own = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        lines = [x for x in (t or "").split("\n") if x.strip(" \t")]
        r = got[i]
        assert r.n_words == len(own) and r.word_chars == sum(map(len, own))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == repeat_words(own)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.base_failed == (len(own) < 20 or 100 * r.n_repeat_words > 30 * len(own))


def test_cutoffs_hold_the_risk(spark):
    """Of 2,000 good documents one in fifty has many symbols: cutting them is
    allowed at a rate of 0.2, not at 0.02."""
    clean, marked = "word%d " * 30, "word%d# " * 30
    rows = [(i, (marked if i % 50 == 0 else clean) % tuple(range(30)), "en", "s", 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    good = labels(spark, [(i, 1, 0) for i in range(2000)])
    assert judge(docs, good, max_false_rejection=0.02).filter("not kept").count() == 0
    assert judge(docs, good, max_false_rejection=0.2).filter("not kept").count() == 40
    assert judge(docs, labels(spark, []), max_false_rejection=0.2).filter("not kept").count() == 0


def test_cutoffs_need_few_labels_and_prefer_what_rejects_junk(spark):
    """Three strata, fifteen ladders: 250 good documents show 3 % where none is lost, 40 show nothing."""
    clean, junk, repeated = "word%d " * 30, "word%d## " * 30, "line one two three four\nline one two three four\n" + "word%d " * 30
    rows, marks = [], []
    for lang, of in (("en", 250), ("de", 250), ("fr", 40)):
        for n in range(of + 20):
            bad = n >= of
            text = (junk if bad else repeated if lang == "de" and n % 10 == 0 else clean) % tuple(range(30))
            marks.append((len(rows), 0 if bad else 1, 0))
            rows.append((len(rows), text, lang, "s", 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    judged = judge(docs, labels(spark, marks), max_false_rejection=0.03).filter("not kept").collect()
    # de's repeated lines do not stop its other ladder; fr has too few labels
    assert sorted(r.stratum for r in judged) == ["de"] * 20 + ["en"] * 20
    assert all(r.n_symbols for r in judged)


def test_ladders_tighten():
    for ladder in quality_rules.ladders(quality_rules.RULES):
        for loose, strict in zip(ladder, ladder[1:]):
            assert loose.keys() == strict.keys() and all(strict[name] <= loose[name] for name in loose) and strict != loose


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 100, 0.05), (7, 400, 0.02), (1, 3, 0.9)])
def test_binomial_tail(spark, k, n, p):
    df = spark.createDataFrame([(k, n)], "_k bigint, _n bigint")
    got = df.select(quality_rules.binomial_tail(F.col("_k"), F.col("_n"), p)).first()[0]
    assert math.isclose(got, sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel_tol=1e-9)


def test_kept_documents_keep_columns(spark, make_docs):
    docs = make_docs([(1, " ".join(f"w{i}" for i in range(40))), (2, "short"), (3, None)])
    out = kept_documents(docs, labels(spark, [(1, 1, 0)]))
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [1]
    assert kept_documents(docs.filter(F.lit(False)), labels(spark, [])).count() == 0


def test_line_field_on_held_out_rows(spark, sf_dir, make_docs):
    docs, marks = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = fit_field(docs, marks)
    rows = score_documents(docs, field).join(marks, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    odd = {r.doc_id: r for r in score_documents(make_docs([*ODD, (8, "line\n" * 3000)]), field).collect()}
    assert len(odd) == 8 and all(0 <= r.score <= 1 for r in odd.values())
    assert odd[1].score == odd[2].score == odd[3].score
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in odd.items())
    unlearned = fit_field(docs, labels(spark, []))
    assert {r.score for r in score_documents(make_docs(ODD), unlearned).collect()} == {0.5}
    assert score_documents(docs.filter(F.lit(False)), field).count() == 0


def test_chain_against_enumeration():
    import itertools

    import numpy as np

    from kindred.llm.line_crf import _chain

    rng = np.random.default_rng(3)
    counts = np.array([3, 0, 1, 4])
    score, steps = rng.normal(size=8), rng.normal(size=(2, 2))
    marginal, expected = _chain(score, counts, steps)
    want, pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        own = score[at : at + n]
        at += n
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(s * y for s, y in zip(own, p)) + sum(steps[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        want += [sum(w for w, p in zip(weight, paths) if p[t]) for t in range(n)]
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w
    assert np.allclose(marginal, want) and np.allclose(expected, pairs)


def test_training_windows_are_no_prefixes(spark):
    """Of long texts a window placed by a hash, with the features of the whole text."""
    from kindred.llm import line_crf

    n = line_crf.TRAINING_LINES
    starts = {line_crf._window(f"text {i}", 10 * n).start for i in range(50)}
    assert len(starts) > 40 and all(0 <= s <= 9 * n for s in starts)
    assert line_crf._window("short", n) == slice(0, n)
    # what tells good from bad stands behind the first lines only
    good, bad = "A plain sentence that ends well, as it should.", "$$$ click >>> %%% win ### 000 |||"
    rows = [(i, "\n".join(["same line here"] * n + [good if i % 2 else bad] * 30 * n)) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    scored = {r.doc_id: r.score for r in line_crf.score_documents(docs, line_crf.fit_field(docs, labels)).collect()}
    assert min(scored[i] for i in scored if i % 2) > max(scored[i] for i in scored if not i % 2)
