"""Consensus HTML extraction on pages whose article is known."""

import random

from martstar.llm import html_consensus as H
from tests.llm.helpers import prose

SCHEMA = "page_id long, url string, html string, path string, host string"


def run(spark, rows):
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)
    return {r.page_id: r for r in H.main_text(pages, H.host_paths(pages)).collect()}


def page(i, body_class="post-%d", extra="", comments=6):
    paras = [f"Part {k} of {i}: {prose(i * 10 + k, 30)}." for k in range(3)]
    text = "\n".join([f"Heading {i}", *paras])
    html = f"""<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var a="</p><article>";</script></head>
    <body><header><h2>Site name, {prose(1, 40)}</h2></header><nav><ul><li><a href="/a">Menu, entry.</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies, and {prose(2, 60)}.</p></div>
    <div class="sidebar"><p>{prose(3, 200)}.</p></div>{extra}
    <div class="{body_class % i} wide"><h1>Heading   {i}</h1><p>{paras[0]}<p>{paras[1].replace(' ', '  ', 4)}</p>
    <form><p>Subscribe now, please.</p><input value="x"></form><p>{paras[2]}</p></div>
    <section id="comments">{''.join(f'<p>reader {c}: {prose(c, 60)}.</p>' for c in range(comments))}</section>
    <footer><p>Copyright, {prose(5, 40)}.</p></footer></body></html>"""
    return html, text


def test_articles_of_one_host(spark):
    made = {i: page(i) for i in range(12)}
    got = run(spark, [(i, f"https://News.Example.org:8080/{i}", h) for i, (h, _) in made.items()])
    for i, (_, text) in made.items():
        assert got[i].text == text
        assert got[i].n_chars == len(text) and got[i].url.endswith(f"/{i}")


def test_consensus_overrules_one_odd_page(spark):
    """A page whose aside is longer than its article follows its host."""
    noise = "<div class='box'>" + "".join(f"<p>{prose(90 + k, 50)}, and more.</p>" for k in range(9)) + "</div>"
    made = {i: page(i, extra=noise if i == 3 else "") for i in range(8)}
    got = run(spark, [(i, "http://a.org/x", h) for i, (h, _) in made.items()])
    assert got[3].text == made[3][1]
    alone = run(spark, [(3, "http://b.org/x", made[3][0])])
    assert alone[3].text != made[3][1]  # without its host the longer box wins


def test_references_white_space_and_broken_markup(spark):
    cases = {
        1: ("<article><p>a &amp; b &lt;c&gt; &#233;&#xe9;&nbsp;d\n\te</p></article>", "a & b <c> éé d e"),
        2: ("<article><p><b>bold.<br><p>next</article>", "bold.\nnext"),
        3: ("<article><p>one<br/>two</p><ul><li>x<li>y</ul></article>", "one two\nx\ny"),
        4: ("<article><p>cut off in a t", "cut off in a t"),
        5: ("<article><p>cut off in a tag</p><p class=\"x", "cut off in a tag"),
        6: ("<article><p>kept</p><!-- <p>gone</p> --><p hidden>gone</p><script>if (a < b) { \"</article>\" }</script><p>too</p></article>",
            "kept\ntoo"),
        7: ("plain words only", "plain words only"),
        8: ("", ""), 9: (None, ""), 10: ("<nav><p>menu</p></nav>", ""),
        11: ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        12: ("<article><p>2 < 3 and 5 > 4</p></article>", "2 < 3 and 5 > 4"),
        13: ("<article><header><h1>Head</h1><p>by line</p></header><p>Body</p></article>", "Head\nBody"),
        14: ("<article><p>in<span> li</span>ne <a href='/x'>link</a></p></article>", "in line link"),
        15: ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    }
    got = run(spark, [(i, f"http://h{i}.org/", h) for i, (h, _) in cases.items()])
    for i, (_, text) in cases.items():
        assert got[i].text == text, i


def test_paths_are_generalised():
    assert H._step("div", {"class": "post-123 Wide x9"}) == "div.post.wide.x"


def test_hosts(spark):
    urls = ["http://A.org/x", "https://u:p@b.org:1/x", "c.org/x", None, "", "ftp://d.org?x", "http://e.org#x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(H.host_of("url").alias("h"))
    assert [r.h for r in df.collect()] == ["a.org", "b.org", "", "", "", "d.org", "e.org"]


def test_null_urls_repeated_rows_and_empty(spark):
    h, text = page(1)
    got = run(spark, [(1, None, h), (2, None, h), (None, "http://x.org", h)])
    assert {r.text for r in got.values()} == {text}
    assert run(spark, []) == {}


def test_shuffled_join_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(H, "BROADCAST_HOSTS", 0)
    h, text = page(1)
    assert run(spark, [(i, f"http://h{i % 3}.org/", h) for i in range(9)])[4].text == text


def test_random_markup_never_fails():
    r = random.Random(1)
    bits = ["<p>", "</p>", "<div class='a'>", "</div>", "<b", ">", "text ", "&amp", ";", "<!--", "-->", "<script>", "</script>",
            "<li>", "</ul>", "<article>", "'", '"', "<br>", "</", "<td>", "\n", "<a href=x>", "</a>", "&#x110000;", "&#0;"]
    for _ in range(2000):
        H.extract("".join(r.choice(bits) for _ in range(r.randint(0, 40))), None)


def test_class_words_and_forms_around_the_article_keep_it(spark):
    for k, (before, after) in enumerate([("<div class='layout has-sidebar'>", "</div>"), ("<div class='post no-comments'>", "</div>"),
                                         ("<form action='/x'>", "</form>"), ("<div class='widget'>", "</div>"),
                                         ("<div id='comments-page'>", "</div>")]):
        made = {}
        for i in range(5):
            h, text = page(i)
            made[i] = (h.replace("<body>", "<body>" + before).replace("</body>", after + "</body>"), text)
        got = run(spark, [(i, f"http://host{k}.org/{i}", h) for i, (h, _) in made.items()])
        for i, (_, text) in made.items():
            assert got[i].text == text, (before, i)


def test_comments_stay_away_even_as_articles():
    h, text = page(4)
    h = h.replace("<section id=\"comments\">", "<section id=\"comments\"><article class='comment-body'><p>First, of the readers.</p></article>")
    h = h.replace("<div class=\"post-4 wide\">", "<article class=\"post-4 wide\">").replace("</p></div>\n    <section", "</p></article>\n    <section")
    assert H.extract(h, None) == text


def test_hostile_pages_take_linear_time():
    import time

    cases = ["<div>x " * 5000, "<div>x " * 40000, "<a '" * 40000, "<a b='" * 40001, "<a b=\"'" * 30000 + ">", "<!" * 50000, "<!--" * 50000,
             "<b>" * 30000 + "</i>" * 30000, "<p><div>" + "<b>" * 20000 + "</p>" * 20000, "<li>" * 30000, "</" * 50000, "<" * 100000,
             "<div class='a b c'>" * 10000 + "end", "&" * 200000, "<a " + "=" * 100000 + ">", "<script>" * 20000, "<td><table>" * 20000]
    for c in cases:
        t0 = time.perf_counter()
        p = H.Page(c)
        H.extract(c, p.best())
        assert time.perf_counter() - t0 < 8, c[:20]
    assert H.extract("<div>x " * 5000, None).count("x") > 0
