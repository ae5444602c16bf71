import re
from html import unescape

import duckdb
import pytest

from alvara.llm import html_text as H

FOLDER = "/root/testdata/sf0.001"


def test_query_equals_the_articles(spark):
    pages = {p: (u, h) for p, u, h in duckdb.execute(f"select page_id, url, html from '{FOLDER}/pages.parquet'").fetchall()}
    rows = H.op10_html_extraction(spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        url, html = pages[r.page_id]
        inside = html[html.index("<article>") + 9:html.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == url


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<", "a<"),
    ("<div class='menu'><a href=x>A</a></div><p>Hello &lt;b&gt; world<br>more<p>second <i>x</i>y", "Hello <b> world more\nsecond xy"),
    ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside><div class='comments'><p>c</p></div><form>f</form>"
     "<script>var a='</article>'</script></article><p>out</p>", "T\nx"),
    ("<main><div id=cookie-notice>no</div><ul><li>one<li>two</ul></main><footer>f</footer>", "one\ntwo"),
    ("<title>t</title><style>p{}</style><!-- <p>no</p> --><p>yes&nbsp;&#233;\n\t now</p><nav>n", "yes é now"),
    ('<p title="a > b">t</p>', "t"), ("<article><p>a</p>" + "<b>x" * 20_000, "a\n" + "x" * 20_000),
])
def test_pages_without_template(html, text):
    assert H.article_text(html, [], []) == text


def site(k, body):
    return f"<html><head><title>{k}</title></head><body><div class=top>Welcome to us</div><div class=links><ul>" + \
        "".join(f"<li><a href=/{i}>go {k}{i}</a></li>" for i in range(3)) + f"</ul></div><div class=text>{body}</div>" \
        "<div class=low>All rights kept</div></body></html>"


def test_template_of_a_host_without_article_tags(spark):
    bodies = [f"<p>First {k}.</p><p>Then <b>{k}</b> more.</p>" for k in range(8)]
    rows = [(k, "HTTP://me@Site.example:80/x", site(k, b), 1) for k, b in enumerate(bodies)]
    rows += [(90, None, None, 1), (91, "http://other.example/", "<p>alone</p>", 1), (None, "http://site.example/", "", 1)]
    rows = rows[:8] + rows[8:10] + [rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = H.extract(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for k in range(8):
        assert text[k] == f"First {k}.\nThen {k} more."
    assert text[90] == "" and text[91] == "alone"


def test_no_pages(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_hosts():
    assert [H.host_of(u) for u in ("http://a@B.c:1/x", "//h?q", None, "x", "https://h")] == ["b.c", "h", "", "", "h"]


def extracted(spark, pages, host="site.example"):
    rows = [(k, f"http://{host}/{k}", html) for k, html in enumerate(pages)]
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def framed(inner):
    return f"<html><body><div class=top>Hello</div>{inner}<div class=extra>{len(inner)} more to see</div></body></html>"


@pytest.mark.parametrize("odd", [
    "<html><body>Not found</body></html>", framed("<article><p>a</p></article><article><p>b</p></article>")])
@pytest.mark.parametrize("tag", ["article", "div class=article", "article id='post-{}'", "div class=post id='post-{}'"])
def test_an_odd_page_or_an_id_keeps_the_article(spark, odd, tag):
    close = tag.split(" ")[0]
    pages = [framed(f"<{tag.format(k)}><p>Body {k}.</p></{close}>") for k in range(7)]
    found = extracted(spark, [*pages, odd])
    assert [found[k] for k in range(7)] == [f"Body {k}." for k in range(7)]
    assert found[7] == ("Not found" if "Not" in odd else "a\nb")


def test_a_rare_article_of_the_page_itself(spark):
    pages = [framed(f"<div class=box{k}><p>Text {k}.</p></div>") for k in range(6)]
    assert extracted(spark, [*pages, framed("<main><p>Only this.</p></main>")])[6] == "Only this."
    assert extracted(spark, [*pages, framed("<div class=post-body><p>Only this.</p></div>")])[6] == "Only this."


def test_links_inside_prose_stay(spark):
    menu = "<ul>" + "".join(f"<li><a href=/{i}>go {{0}}{i}</a></li>" for i in range(3)) + "</ul>"
    row = "<p>" + " | ".join(f"<a href=/{i}>part {{0}}{i}</a>" for i in range(3)) + "</p>"
    pages = [f"<html><body>{(menu + row).format(k)}<p>See <a href=x>the {k} list</a> now.</p></body></html>" for k in range(6)]
    assert extracted(spark, pages) == {k: f"See the {k} list now." for k in range(6)}


def test_an_article_inside_a_sidebar_is_none():
    assert H.article_text("<p>Text.</p><div class=sidebar><div class=content>no</div></div>", [], []) == "Text."


def test_a_long_shared_menu_ahead_of_the_article(spark):
    menu = "".join(f"<div class=c{i}>item {i}</div>" for i in range(1_500))
    pages = [f"<html><body>{menu}<div class=low><p>Body {k}.</p></div></body></html>" for k in range(6)]
    found = H.templates(spark.createDataFrame(
        [(k, "http://site.example/", p) for k, p in enumerate(pages)], "page_id long, url string, html string"))
    assert len(found.where("host = 'site.example'").first()["root"]) > 3_000
    assert extracted(spark, pages) == {k: f"Body {k}." for k in range(6)}


def test_words_of_a_frame_leave_nothing_out():
    for page in (
        '<body class="has-sidebar"><article><p>Text.</p></article></body>',
        '<article class="post nav-enabled"><p>Text.</p></article>',
        '<main class="with-menu"><p>Text.</p></main>',
        '<body class="with-menu"><article><h2 id="market-share">Text.</h2></article></body>',
        '<article><h2 class="section-header">Text.</h2></article><article class="comment"><p>First!</p></article>',
    ):
        assert H.article_text(page, [], []) == "Text."
