"""HTML extraction on hand-made pages, language identification on held-out documents."""

import html
import re

import pytest
from pyspark.sql import functions as F

from liftkit.llm import html_density, language_id
from liftkit.llm.common import table

SF = "/root/testdata/sf0.01"
LOREM = "The quick brown fox jumps over the lazy dog and runs far away from all of them."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


CASES = [
    (page(f"<nav><a href=/>Home</a></nav><article><h1>Head &amp; more</h1><p>{LOREM}</p></article><footer>&copy; x</footer>"), f"Head & more {LOREM}"),
    (page(f"<div class='ad'>Buy now and buy more of it all</div><article><p><b>Bold start<br><p>{LOREM}</article>"), f"Bold start {LOREM}"),
    (page(f"<div id=side class='sidebar left'>{LOREM}</div><div><p>{LOREM} One.</p><p>{LOREM} Two.</p></div>"), f"{LOREM} One. {LOREM} Two."),
    (page(f"<main><p>a  b\n\tc&nbsp;d</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><p>{LOREM}</main>"), f"a b c d one two x y {LOREM}"),
    (page(f"<header><h1>Site</h1></header><article><p>{LOREM}</p><form><input value=q><button>Go</button></form></article>"
          f"<section class=comments><p>{LOREM} I agree.</p></section>"), LOREM),
    (page(f"<article><p>in<b>lin</b>e <a href='x>y'>li&#110;k</a>.</p><!-- <p>gone</p> --><aside>note</aside><p>{LOREM}</p></article>"), f"inline link. {LOREM}"),
    (page(f"<div class=cookie-notice>We use cookies on this site for you</div><div class=post><p>{LOREM}</p><p>{LOREM}</p></div>"), f"{LOREM} {LOREM}"),
    (f"<html><body><article><h1>Cut</h1><p>{LOREM}", f"Cut {LOREM}"),
    ("<p>no body tags</p>", "no body tags"), ("just text &lt;3 a < b", "just text <3 a < b"),
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<script>only()", ""), ("</div></p><p>stray", "stray"),
    (page("<article><h1>&am</h1><p>R&amp;D &notanentity; &#x41;</p></article>"), "&am R&D ¬anentity; A"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_main_text(source, want):
    assert html_density.main_text(source) == want


def paragraphs(name, n, size=400):
    return [(f"{name}{k} " + "plain words of a long text " * 20)[:size - 1] + "." for k in range(n)]


def joined(*parts):
    return " ".join(" ".join(p) for p in parts)


def marked(parts):
    return "".join(f"<p>{p}</p>" for p in parts)


@pytest.mark.parametrize("wrap", ["{}", "<div id=page>{}</div>", "<div><div class=content>{}</div></div>"])
def test_text_split_over_siblings(wrap):
    a, b = paragraphs("a", 8), paragraphs("b", 4)
    links = "<div>" + "".join(f"<a href=/{k}>Link number {k}</a> " for k in range(20)) + "</div>"
    for before, after in (("", ""), (links, ""), (links, links)):
        for first, second in ((a, b), (b, a)):
            body = wrap.format(f"{before}<div>{marked(first)}</div><div>{marked(second)}</div>{after}")
            assert html_density.main_text(page(body)) == joined(first, second)


def test_layout_names_do_not_cut_the_text():
    a, side = paragraphs("a", 5), paragraphs("s", 2, 90)
    for tag, name in (("div", "class='layout with-sidebar'"), ("div", "id=content class=no-sidebar"), ("section", "class='post related-topic'"),
                      ("div", "class=sidebar-left"), ("div", "role=form"), ("form", "method=post"), ("div", "class='comments'")):
        nav = "<div class=site-nav><p>One and two</p></div>"
        for inner in (f"<article>{marked(a)}</article>", f"<main>{marked(a)}</main>", f"<div>{marked(a)}</div>"):
            assert html_density.main_text(page(f"{nav}<{tag} {name}>{inner}</{tag}>")) == joined(a), (tag, name, inner)
            beside = f"<{tag} {name}>{inner}<div class='sidebar'>{marked(side)}</div></{tag}>"
            assert html_density.main_text(page(beside)) == joined(a), (tag, name, inner)
    long = marked(paragraphs("c", 20))
    assert html_density.main_text(page(f"<article>{marked(a)}</article><div class=comment-list><article>{long}</article></div>")) == joined(a)


def test_long_and_deep_pages():
    deep = "<div>" * 3000 + f"<p>{LOREM}</p>" + "</div>" * 3000
    assert html_density.main_text(page(deep)) == LOREM
    many = "".join(f"<p>{LOREM} {i}</p>" for i in range(5000))
    assert html_density.main_text(page(f"<article>{many}</article>")).count(LOREM) == 5000
    assert html_density.main_text("<a b='" + "x" * 200_000) != None  # noqa: E711  an unclosed quote ends


def test_extraction_of_the_table(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r for r in html_density.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(p|br|/p|h1|/h1)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_extraction_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (1, "u", ""), (None, "u", page(f"<p>{LOREM}</p>"))], "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("clash"))
    assert sorted((r["text"], r["n_chars"]) for r in html_density.extract(df).collect()) == [("", 0), ("", 0), (LOREM, len(LOREM))]
    assert html_density.extract(df.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    hidden = docs.withColumn("declared", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))  # a third is held out
    found = language_id.identify(hidden, declared_col="declared", host_col="source").collect()
    held = [r for r in found if r["declared"] is None and (r["text"] or "").strip()]
    assert len(held) > 300 and sum(r["_lang"] == r["lang"] for r in held) / len(held) > 0.99
    assert sum(r["_accepted"] for r in found) / len(found) > 0.99


def test_rejections_and_odd_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame(
        [(-1, None, "en", "src1"), (-2, "", "fr", None), (-3, "12345 ... !!!", "de", "src2"), (-4, "これは日本語の文章です。" * 20, None, "src3"),
         (-5, "the of and to in that is was for on with as by this be at from", None, None), (None, "x" * 50_000, "xx", "new")],
        docs.schema)
    both = docs.unionByName(odd).withColumn("_lang", F.lit("clash")).withColumn("prior", F.lit(1))
    got = {r["doc_id"]: r for r in language_id.identify(both, declared_col="lang", host_col="source").collect() if (r["doc_id"] or -9) < 0}
    assert [got[i]["_accepted"] for i in (-1, -2, -3, -4)] == [False] * 4 and got[-1]["_lang"] == "und"
    assert got[-5]["_lang"] == "en"
    assert language_id.identify(both.limit(0), declared_col="lang", host_col="source").count() == 0


def test_address_language_and_host_priors(spark):
    urls = [("http://a.b.de/x", "de"), ("http://a.com/fr/1", "fr"), ("http://a.es/en", "en"), ("http://a.com/frx", None), (None, None), ("none", None)]
    df = spark.createDataFrame(urls, "url string, want string")
    for r in df.withColumn("got", language_id.address_language("url")).collect():
        assert r["got"] == r["want"], r["url"]
    rows = [("x.a.com", 0)] * 30 + [("y.a.com", 1)] * 10 + [("z.org", 2)] * 5 + [(None, 3)]
    got = {r["host"]: r["prior"] for r in language_id.host_priors(spark.createDataFrame(rows, "host string, guess int")).collect()}
    counts = {"": [30, 10, 5, 1], "com": [30, 10, 0, 0], "a.com": [30, 10, 0, 0], "y.a.com": [0, 10, 0, 0]}
    prior = [0.25] * 4
    for domain in ("", "com", "a.com", "y.a.com"):
        n = counts[domain]
        prior = [(10 * p + c) / (10 + sum(n)) for p, c in zip(prior, n)]
    assert got["y.a.com"] == pytest.approx(prior) and len(got) == 4


def test_pages_by_markup_and_address(spark):
    from liftkit.llm.queries import language_id_pages

    want = {r["page_id"]: re.search(r'<html lang="(\w+)"', r["html"])[1] for r in table(spark, SF, "pages").collect()}
    got = {r["page_id"]: r["language"] for r in language_id_pages(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("tag", ["canvas", "svg", "object", "iframe", "title", "noscript"])
def test_a_raw_tag_without_its_end_drops_nothing(tag):
    body = "".join(f"<p>Paragraph number {i} of this article has quite some words in it, more than a menu.</p>" for i in range(5))
    stray = body.replace("<p>Paragraph number 2", f"<{tag}><p>Paragraph number 2")
    whole = html_density.main_text(f"<html><body><article>{body}</article></body></html>")
    assert html_density.main_text(f"<html><body><article>{stray}</article></body></html>") == whole and "number 4" in whole


def test_formulas_stay():
    text = html_density.main_text("<html><body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>5</mn></math> hold for all of the numbers here.</p></article></body></html>")
    assert text == "Let x=5 hold for all of the numbers here."


def test_many_raw_tags_without_an_end_take_linear_time():
    import time

    begun = time.time()
    html_density.main_text("<html><body><article>" + "<canvas>word word " * 20_000 + "</article></body></html>")
    assert time.time() - begun < 20
