import html
import re

from quarryline.llm import html_text
from quarryline.llm.html_text import Page


def own_text(source):
    page = Page(source)
    return page.text(page.best(page.scores()))


def test_boilerplate_goes_and_blocks_stay():
    source = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>
    <div class="cookie-notice">We use cookies</div><main><article><header><h1>Title</h1><p>by line</p></header>
    <p>First &amp; <b>bold</b>  text<p>Second<br>line<ul><li>one<li>two</ul><div class="ad-box">buy</div><form>name <input></form>
    <table><tr><td>a<td>b</table><aside>also</aside><script>if (a < b) "<p>no</p>"</script><style>p{}</style><!-- <p>no</p> -->
    <div id="comments"><p>reader</p></div>tail</article></main><footer>foot</footer></body></html>"""
    assert own_text(source) == "Title\nFirst & bold text\nSecond\nline\none\ntwo\na\nb\ntail"


def test_odd_sources():
    assert own_text("") == "" and own_text("<p>") == "" and own_text("just text &lt;3") == "just text <3"
    assert own_text("<div class='x'><p>open <i>tags <p>two") == "open tags\ntwo"
    assert own_text("a < b and <p>c") == "a < b and\nc"
    assert own_text("<p>" + "<div>" * 3000 + "deep") == "deep"
    assert own_text("<script>never closed <p>x") == "" and own_text("<p title='a>b'>x</p>") == "x"


def test_pages_against_their_articles(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", "\0", body)).split("\0")
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert got[r.page_id] == (want, len(want))


def test_the_hosts_path_wins_over_a_pages_own(spark):
    story = "<div class='story7'><p>{}</p></div><div class='extra'><p>{}</p></div>"
    rows = [(i, "http://h.example/a", story.format("long main text " * 9, "x")) for i in range(9)]
    rows += [(9, "http://h.example/b", story.format("short", "a longer text beside the story " * 9)), (10, "//u@H.example:80/c", story.format("other", "y"))]
    rows += [(11, None, "<p>no url</p>"), (12, "http://h.example/d", None), (13, "nonsense", ""), (9, "http://h.example/b", "<p>same id</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", html_text.F.lit("taken")).withColumn("host", html_text.F.lit(1))
    found = html_text.extract(df.repartition(4))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id, r.text) for r in found.collect())
    assert (9, "short") in got and (10, "other") in got and (11, "no url") in got and (12, "") in got and (13, "") in got and (9, "same id") in got
    assert len(got) == len(rows)
    assert html_text.extract(df.limit(0)).count() == 0
    assert html_text.host_paths(spark.createDataFrame(rows[:10], "page_id long, url string, html string").selectExpr("'h' AS host", "html")).first().winners[0] == "div.story#"


def sections(*sizes, cell="<div class=section><p>{}</p></div>", around="<div class=content>{}</div>"):
    return "<html><body>" + around.format("".join(cell.format(f"s{i} " + "x" * n) for i, n in enumerate(sizes))) + "</body></html>"


def whole(*sizes):
    return "\n".join(f"s{i} " + "x" * n for i, n in enumerate(sizes))


def test_all_parts_of_an_article_cut_into_siblings(spark):
    cells = {"cell": "<td>{}", "around": "<table><tr>{}</table>"}
    bare = {"cell": "<section>{}</section>", "around": "{}"}
    cases = {
        "uneven": [((1000, 200), {}), ((1000, 200), {}), ((200, 200, 200, 200, 200), {}), ((500,), {})],
        "equal": [((200, 200, 200, 200, 200), {}), ((1000, 200), {})],
        "single": [((500,), {}), ((500,), {}), ((500,), {}), ((200, 200, 200, 200, 200), {}), ((1000, 200), {})],
        "cells": [((1000, 200), cells), ((300, 300, 300), cells), ((100,), cells)],
        "bare": [((1000, 200), bare), ((200, 200, 200, 200, 200), bare)],
    }
    rows = [(f"http://{host}.example/{i}", sections(*sizes, **how), whole(*sizes)) for host, pages in cases.items() for i, (sizes, how) in enumerate(pages)]
    rows.append(("http://intro.example/", sections(1000, 200, around="<div class=content><p>intro</p>{}<p>end</p></div>"), "intro\n" + whole(1000, 200) + "\nend"))
    pages = spark.createDataFrame([(i, url, source) for i, (url, source, _) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages.repartition(3)).collect()}
    for i, (url, _, want) in enumerate(rows):
        assert got[i] == want, url


def test_names_judge_by_their_head():
    source = """<html><body><article><h1>Title</h1><p class="advert">BUY NOW</p><p>One</p><h2 class="related">More</h2>
    <div class="widget-text">Two</div><div class="ad-free-content">Three</div><div class="header-less">Four</div>
    <div class="related-posts">x</div><div class="sponsored-content">x</div><div class="article-comments">x</div><div class="teaser">x</div>
    <article class="comment">x</article><div class="feedback">x</div><section class="discussion">x</section><div class="adBox">x</div>
    <div id="comment-list">x</div><p hidden>x</p><p class="hidden">x</p><p class="commentary">Five</p></article></body></html>"""
    assert own_text(source) == "Title\nOne\nTwo\nThree\nFour\nFive"


def test_deep_pages_take_memory_in_proportion():
    import tracemalloc

    tracemalloc.start()
    deep = Page("<div class=x>" * 100_000 + "<p>deep" + "</section>" * 100_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert deep.text(deep.best(deep.scores())) == "deep" and peak < 300e6
    long = Page("<article>" + "<p>word</p>" * 100_000 + "</article>")
    assert long.text(long.best(long.scores())).count("\n") == 99_999


def test_paths_come_back_from_words():
    page = Page("<div class='a7 b'><section><div class='a8'><p>x</p></div></section></div><div class='a9'>y</div>")
    words = [page.path(n) for n in page.paths]
    assert words == ["", "div.a#", "div.a#>section", "div.a#>section>div.a#", "div.a#>section>div.a#>p", "div.a#"]
    assert [page.number(w) for w in words[1:]] == page.paths[1:] and page.number("div.a#>table") == -1
