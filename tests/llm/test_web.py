"""URL rules, main text, archives."""

import hashlib
import io
import itertools
import random
import struct
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from kindred.llm import warc
from kindred.llm.dom_model import labelled_pages, node_features, parse, sum_product, trained_model, extract_text
from kindred.llm.queries import URL_RULES
from kindred.llm.url_filter import UrlRule, UrlTrie, filter_urls, split_url


def make_pages(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    for name in ("text", "host", "digest", "payload", "first_id", "revisit"):
        pages = pages.withColumn(name, F.lit("clash"))
    return pages


def test_split_url():
    assert split_url("HTTP://Ex.ORG/A/b?x#y") == ("ex.org", "/A/b")
    assert split_url("http://e.org#f/g") == ("e.org", "")
    assert split_url("e.org/a") == ("", "") and split_url(None) == ("", "") and split_url("") == ("", "")
    assert split_url("a://b://c/d") == ("b:", "//c/d")


def test_trie_against_scanning_all_rules():
    rules = [*URL_RULES, UrlRule("allow", "b.net", "/a"), UrlRule("block", "b.net", "/a/b"), UrlRule("block", "x.b.net", "/"), UrlRule("allow", "com", "/")]
    trie = UrlTrie(rules)
    hosts = [".".join(p) for n in (1, 2, 3) for p in itertools.product(["net", "b", "x", "example", "com", "bnet"], repeat=n)]
    for host in hosts:
        for path in ("", "/", "/a", "/a/", "/ab", "/a/b", "/a/bc/d", "/en", "/en/", "/de/1"):
            fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
            want = max(fit, key=lambda r: (len(r.host.split(".")), len(r.path)), default=None)
            assert trie.match(host, path) == want


def test_filter_rows(spark):
    rows = [(1, "http://a.example.net/en/x", ""), (1, "http://a.example.net/en/x", ""), (None, None, None), (2, "http://z.net/q", ""), (3, "nonsense", "")]
    got = sorted(tuple(r) for r in filter_urls(make_pages(spark, rows), URL_RULES, keep=("page_id",)).fillna(-1).collect())
    assert got == [
        (-1, "", "", None, "allow"), (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "z.net", "/q", "net/", "block"), (3, "", "", None, "allow"),
    ]
    assert filter_urls(make_pages(spark, rows).filter(F.lit(False)), URL_RULES).count() == 0


PAGE = (
    '<html><head><title>T</title><style>x</style></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
    '<div class="ad">Buy this thing now.</div><article><h1>Head &amp; line</h1><p>One  two\nthree &lt;four&gt;.<p>Next <b>bold</b> paragraph that is long '
    "enough.<br>more</p><script>var t='</p>';</script><!-- no --></article><aside class='sidebar'><p>Related stories here</p></aside>"
    '<section id="comments"><h2>Comments</h2><div class="comment"><p>I like it a lot.</p></div></section>'
    '<div class="cookie-notice">We use cookies.</div><form>Mail <input><button>Go</button></form><footer>&copy; site</footer></body></html>'
)


def test_main_text(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "no markup at all <"), (4, "u", "<div>" * 5000 + "deep"), (5, "u", PAGE[:520])]
    got = {r.page_id: r for r in extract_text(make_pages(spark, rows)).collect()}
    assert got[1].text == "Head & line\n\nOne two three <four>.\n\nNext bold paragraph that is long enough. more"
    assert got[1].n_chars == len(got[1].text)
    assert got[2].text == "" and got[3].text == "" and got[2].n_chars == 0
    assert got[5].text.startswith("Head & line")
    assert extract_text(make_pages(spark, rows).filter(F.lit(False))).count() == 0


def test_model_on_unseen_pages():
    pages = labelled_pages(150, seed=123)
    x, parents, depths = node_features(pages)
    model = trained_model()
    marginal, _ = sum_product(x @ model.weights, parents, depths, model.pair)
    labels = np.array([label for p in pages for label in p.labels])
    assert ((marginal >= 0.5) == labels).mean() > 0.98


def test_messages_against_enumeration():
    parents, depths = np.array([-1, 0, 0, 1, 1, -1, 5]), np.array([0, 1, 1, 2, 2, 0, 1])
    rng = np.random.default_rng(1)
    score, pair = rng.normal(size=7), rng.normal(size=(2, 2))
    total, ones, pairs = 0.0, np.zeros(7), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=7):
        w = np.exp(sum(s * v for s, v in zip(score, y)) + sum(pair[y[p], y[i]] for i, p in enumerate(parents) if p >= 0))
        total += w
        ones += w * np.array(y)
        for i, p in enumerate(parents):
            if p >= 0:
                pairs[y[p], y[i]] += w
    marginal, expected = sum_product(score, parents, depths, pair)
    assert np.allclose(marginal, ones / total) and np.allclose(expected, pairs / total)


LONG = "This sentence belongs to the article and is long enough to be told from others."


@pytest.mark.parametrize("part", [
    f"<svg viewBox='0 0 1 1' /><p>{LONG}</p>", f"<p>a <svg/> b</p><p>{LONG}</p>", f"<math/><p>{LONG}</p>", f"<noscript><p>{LONG}</p></noscript>",
    f"<object data='x'><p>{LONG}</p></object>", f"<p>{LONG} <math><mi>x</mi><mo>=</mo><mspace/><mn>42</mn></math> holds.</p>",
])
def test_nothing_of_the_article_is_dropped(part):
    page = f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>Head line</h1><p>{LONG}</p>{part}<p>Last one, {LONG}</p></article></body></html>"
    text = trained_model().texts([page])[0]
    assert text.count(LONG) == 3 and "Last one" in text and "Home" not in text
    assert ("x= 42" in text or "x=42" in text) == ("<mi>" in part)


@pytest.mark.parametrize("head", ["<title>T</title><meta charset=utf-8>", "<head><title>T</title>", "<html><head><meta charset=utf-8><title>T</title>\n<link rel=x>"])
def test_head_ends_without_its_tag(head):
    text = trained_model().texts([f"<!doctype html>{head}<article><h1>Head line</h1><p>{LONG}<p>Last one, {LONG}</article>"])[0]
    assert text.count(LONG) == 2 and "Head line" in text
    assert LONG in trained_model().texts([f"{head}{LONG}<p>{LONG}"])[0]
    inline = parse(f"{head}<b>{LONG}</b>")
    assert [t for _, t, _ in inline.blocks] == [LONG]


def _extracted(body):
    return trained_model().texts([f"<html><head><title>T</title></head><body>{body}</body></html>"])[0]


def test_article_under_names_that_say_something_else():
    parts = f"<div class='more-text'><p>{LONG}</p><p>{LONG}</p></div><section class='discussion'><h2>Discussion</h2><p>{LONG}</p><p>{LONG}</p></section>"
    text = _extracted(f"<nav><a href='/'>Home</a></nav><article class='story'><h1>Head line</h1>{parts}</article><footer>Foot</footer>")
    assert text.split("\n\n") == ["Head line", LONG, LONG, "Discussion", LONG, LONG]


@pytest.mark.parametrize("drawing", [
    "<svg viewBox='0 0 1 1'><path d='M0'>", "<svg><g><text>drawn</text>", "<svg><foreignObject><p>drawn</p></foreignObject><text>drawn</text></svg>",
    "<svg><a href='x'><text>drawn</text></a>", "<div><svg><path></div>",
])
def test_drawings_end(drawing):
    assert _extracted(f"<article><h1>Head line</h1><p>{LONG}</p>{drawing}<p>{LONG}</p><p>{LONG}</p></article>").split("\n\n") == ["Head line", LONG, LONG, LONG]


def test_links_inside_the_article_stay():
    items = "".join(f"<li><a href='/{i}'>Source {i} of the text</a></li>" for i in range(2))
    text = _extracted(f"<nav><a href='/'>Home</a></nav><main><h1>Head line</h1><p>{LONG}</p><ul>{items}</ul><p>{LONG}</p></main><footer>Foot</footer>")
    assert text.split("\n\n") == ["Head line", LONG, "Source 0 of the text", "Source 1 of the text", LONG]


@pytest.mark.parametrize("names", [
    ("kopf", "inhalt", "kommentare", "beitrag", "fuss"), ("entete", "contenu", "avis", "avis-un", "pied"), ("c1", "c2", "c3", "c4", "c5"), ("", "", "", "", ""),
])
def test_layouts_with_foreign_names(names):
    top, middle, talk, one, foot = (f" class='{n}'" if n else "" for n in names)
    comments = "".join(f"<div{one}><p>{said}</p></div>" for said in ("Sehr gut.", "Das sehe ich ganz anders.", "Danke!"))
    text = _extracted(
        f"<div{top}><a href='/'>Start</a> <a href='/n'>Neues</a></div><div{middle}><h1>Titel der Seite</h1>{f'<p>{LONG}</p>' * 3}</div>"
        f"<div{talk}><h3>Kommentare</h3>{comments}</div><div{foot}><p>Impressum</p><p>Alle Rechte vorbehalten.</p></div>"
    )
    assert text.split("\n\n") == ["Titel der Seite", LONG, LONG, LONG]


@pytest.mark.parametrize("markup", ["<b>" * 100_000 + "</i></u>" * 100_000, "<p><b></div>" * 50_000, "<svg>" * 50_000])
def test_parser_is_linear(markup):
    begun = time.process_time()
    parse(f"<article><p>{markup}{LONG}")
    assert time.process_time() - begun < 6


def test_parser_takes_anything():
    for source in ("<", "<a", "<!--", "</", "</p>", "<p", "<script>", "<p class='x", "a<b>c", "<table><tr><td>x<td>y", "<li>a<li>b", "\x00<é>"):
        parse(source)


def test_archives_round_trip(spark, tmp_path):
    long, short = "<p>" + "text " * 60 + "é</p>", "tiny"
    rows = [(5, "http://a/\n b", long), (3, None, long), (9, "u", long), (None, "u", long), (1, "u", short), (2, "u", short), (4, "u", None), (6, "u", "")]
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    many = [f"<html><p class='x'>{' '.join(rnd.choices(words, k=200))}</p></html>" for _ in range(80)]
    rows += [(100 + i, "u", html) for i, html in enumerate(many)] + [(100, "u", many[0])]
    archives = warc.write_archives(make_pages(spark, rows), f"file://{tmp_path}/warc")
    got = warc.read_archives(archives, with_payload=True).collect()
    want = sorted((i if i is not None else -1, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    kind = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kind[3] == ("response", None) and kind[5] == kind[9] == kind[None] == ("revisit", 3)
    assert kind[1] == kind[2] == kind[4] == kind[6] == ("response", None)
    assert [r.record_type for r in got if r.page_id == 100] == ["response", "response"]
    assert {r.payload.decode() for r in got if r.page_id == 3} == {long}
    assert warc.read_archives(warc.write_archives(make_pages(spark, rows).filter(F.lit(False)), f"file://{tmp_path}/none")).count() == 0
    # archives begin with the dictionary, and each record is a frame of its own
    for path in (tmp_path / "warc").iterdir():
        data = path.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_FRAME and data[8 + size :].startswith(warc.DATA_FRAME)


def test_damaged_archives():
    record = warc.record_bytes(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False, "2020-01-01T00:00:00Z")
    pack = zstandard.ZstdCompressor().compress
    assert [r.payload for r in warc.read_records(io.BytesIO(pack(record) * 3), "x")] == [b"payload"] * 3
    packed_dictionary = pack(zstandard.train_dictionary(2048, [record + bytes([i]) * 40 for i in range(60)]).as_bytes())
    raw = zstandard.ZstdDecompressor().decompress(packed_dictionary)
    framed = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(record)
    assert next(warc.read_records(io.BytesIO(warc.dictionary_frame(packed_dictionary) + framed), "x")).payload == b"payload"
    for bad in (
        pack(record)[:-3],
        pack(record) + b"zz",
        pack(record.replace(b"payload", b"pay")),
        pack(record.replace(b"WARC/1.1", b"HTTP/1.1")),
        pack(record.replace(b"WARC-Date:", b"WARC Date:")),
        pack(record.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n")),
        warc.dictionary_frame(b"abc")[:6],
        framed,
    ):
        with pytest.raises(warc.ArchiveError):
            list(warc.read_records(io.BytesIO(bad), "x"))
