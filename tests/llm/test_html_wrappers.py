import random

from siltbed.llm import html_wrappers as hw

SCHEMA = "page_id long, url string, html string, text string, host int"


def page(r, layout):
    """A page and its main text."""
    words = lambda n: " ".join(r.choice(["alpha", "beta &amp; co", "gamma", "d&eacute;lta", "x &lt; y"]) for _ in range(n))
    import html

    title, paras = words(4), [words(r.randint(5, 40)) for _ in range(r.randint(1, 6))]
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" if r.random() < 0.5 else f"<p>\n {p} <b>bold</b> <i>it</i>\n" for p in paras)
    menu = "<nav><ul>" + "".join(f"<li><a href='/{i}'>{words(1)}</a>" for i in range(r.randint(2, 7))) + "</ul></nav>"
    if layout == 0:
        out = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p><article>';</script></head><body class='has-sidebar'>{menu}<!-- ad <p>x</p> --><div class=ad>{words(9)}</div><article>{body}</article><aside>{words(9)}</aside><footer>&copy; {words(3)}</footer></body></html>"
    elif layout == 1:
        out = f"<html><body><header><p>{words(5)}</header><div id=main-content class='post'>{body}<form><p>{words(4)}<input></form><section class=comments><p>{words(30)}</p></section></div><div class='sidebar'><p>{words(9)}</div>"
    else:
        out = f"<html><body><div class=top-menu><p>{words(3)}</div><div class='cookie-notice'>{words(6)}</div><div><div>{body}<p>{words(40)}</p></div></div><div class=footer>{words(3)}</div>"
    return out, html.unescape(title), paras


def clean(text):
    import html

    return " ".join(html.unescape(text).split())


def test_main_text_of_several_layouts(spark):
    r = random.Random(1)
    rows, wants = [], {}
    for i in range(150):
        layout = i % 3
        p, title, paras = page(r, layout)
        rows.append((i, f"https://host{layout}.example.com/{i}", p, "x", 1))
        wants[i] = (layout, title, paras)
    got = {x.page_id: x for x in hw.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == 150
    for i, (layout, title, paras) in wants.items():
        blocks = got[i].text.split("\n\n")
        assert got[i].n_chars == len(got[i].text)
        assert blocks[0] == clean(title)
        assert [b.removesuffix(" bold it") for b in blocks[1 : 1 + len(paras)]] == [clean(p) for p in paras]
        assert len(blocks) == 1 + len(paras) + (layout == 2)


def test_wrapper_is_an_expression_without_alternatives(spark):
    rows = [(1, "http://a.b/1", "<body><p>x<p>y<div>z</div>"), (2, "http://a.b/2", "<body><p>x<ul><li>1<li>2</ul><div>z</div>"), (3, "http://c.d/", "<dl><dt>a<dd>b<dt>c<dd>d</dl>")]
    got = {x.host: x.wrapper for x in hw.infer(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got["a.b"] == "body[p[#text]+ ul[li[#text]+]? div[#text]]"
    assert got["c.d"] == "dl[(dt[#text] dd[#text])+]"


def test_partial_wrappers_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(hw, "FAN_IN", 2)
    rows = [(i, "http://a.b/", f"<body><nav>m{i}</nav><article><p>t{i}</p></article>") for i in range(40)]
    got = hw.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)).collect()
    assert {x.page_id: x.text for x in got} == {i: f"t{i}" for i in range(40)}


def test_odd_pages(spark):
    cases = {
        "": "", None: "", "   ": "", "no tags at all": "no tags at all", "a < b &gt; c": "a < b > c", "<p>one<br>two&nbsp;three</p>": "one two three",
        "<article>kept<!-- never ends <p>gone</p>": "kept", "<article><script>x < y": "", "<b>unclosed <p>two": "unclosed\n\ntwo",
        "<a href='x": "", "<article>" + "<p>long words here</p>" * 3000 + "</article>": "\n\n".join(["long words here"] * 3000),
        "<div>" * 500 + "deep" + "</div>" * 500: "deep", "</p></div>text": "text", "<article><p>&#x41;&bogus;&amp;lt;</p></article>": "A&bogus;&lt;",
    }
    rows = [(i, None if i % 2 else f"http://h{i}.x/", h, None, None) for i, h in enumerate(cases)]
    rows += [(None, "not a url", "<article>z</article>", None, None)] * 2
    got = hw.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {x.page_id: x.text for x in got}
    assert {h: by[i] for i, h in enumerate(cases)} == cases
    assert [x.text for x in got if x.page_id is None] == ["z", "z"]
    assert hw.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_text_after_deep_nests(spark):
    cases, wants = [], []
    for n in (10, 55, 56, 60, 100, 500, 3000):
        cases.append(f"<html><body><div><article><p>first</p>{'<div>' * n}deep<p>block</p><nav>menu</nav>more{'</div>' * n}<p>second</p><p>third</p></article></div><p>outside</p></body></html>")
        wants.append("first\n\ndeep\n\nblock\n\nmore\n\nsecond\n\nthird")
    for n in (70, 1000):  # inline tags that never end, and a main place below
        cases.append(f"<html><body>{'<span>' * n}<p>lead</p><article><p>one</p><div class=ad>buy</div><p>two <b>bold</b></p></article><p>outside</p>")
        wants.append("one\n\ntwo bold")
    cases.append("<body>" + "<article>" * 400 + "<p>in</p><nav>menu</nav>" + "</article>" * 400 + "<p>out</p>")
    wants.append("in")
    rows = [(i, f"http://h{i}.x/", h, None, None) for i, h in enumerate(cases)]
    by = {x.page_id: x.text for x in hw.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [by[i] for i in range(len(cases))] == wants
    assert [hw.main_text(h, None) for h in cases] == wants


def test_text_beside_the_densest_container_stays(spark):
    body = "".join(f"<p>{'body words ' * 20}{i}</p>" for i in range(3))
    paras = [f"{'body words ' * 20}{i}" for i in range(3)]
    links = "<div>" + "".join(f"<a href=/{i}>link {i}</a> " for i in range(5)) + "</div>"
    head = f"<html><body><nav>menu</nav><div class=ad>buy</div>{links}"
    rows = [(i, "http://a.b/", f"{head}<h1><a href=/>Title</a></h1><p>lead</p><div>{body}</div><section><p>second <a href=x>one</a></p></section><footer>f</footer>", None, None) for i in range(5)]
    rows.append((5, "http://a.b/", f"{head}<h1>Other</h1><p>{'all of it here ' * 30}</p><div><p>less</p></div><section><p>more</p></section>", None, None))
    by = {x.page_id: x.text.split("\n\n") for x in hw.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(by[i] == ["Title", "lead", *paras, "second one"] for i in range(5))
    assert by[5] == ["Other", ("all of it here " * 30).strip(), "less", "more"]


def test_marks_of_anchors_and_headings_drop_nothing():
    page = '<body><article><h2 id="related-work">Related work</h2><p id="share">one</p><h2 id=search class=header>Search</h2><section id="notice-period"><p>two</p></section><div id="site-footer">gone</div><div id=comments>gone</div><h3 style="display:none">gone</h3></article></body>'
    assert hw.main_text(page, None) == "Related work\n\none\n\nSearch\n\ntwo"


def test_template_texts_go_and_data_stays(spark):
    r = random.Random(3)
    text = lambda: " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randrange(99)) for _ in range(20))
    rows, want = [], {}
    for i in range(40):  # lines of a template without marks, a bold word and a heading that recur
        own = [text() for _ in range(r.randint(2, 5))]
        body = "".join(f"<p>{t} <b>bold</b></p>" for t in own)
        rows.append((i, f"https://a.example.com/{i}", f"<body><div><p>Subscribe now</p><h2>Summary</h2>{body}<p>All rights reserved by Example Ltd</p></div></body>", "x", 1))
        want[i] = "\n\n".join(["Summary", *(f"{t} bold" for t in own)])
        # the same within a place that a tag tells: nothing of it goes
        rows.append((1000 + i, f"https://d.example.com/{i}", f"<body><article><p>Part of a series</p>{body}</article><p>outside</p></body>", "x", 1))
        want[1000 + i] = "\n\n".join(["Part of a series", *(f"{t} bold" for t in own)])
    same = text()
    for i in range(100, 140):  # copies of one page
        rows.append((i, f"https://b.example.com/{i}", f"<body><div><p>{same}</p><p>{same}</p></div></body>", "x", 1))
        want[i] = f"{same}\n\n{same}"
    for i in range(200, 203):  # a host of few pages
        rows.append((i, f"https://c.example.com/{i}", f"<body><div><p>short</p><p>{text()}</p></div></body>", "x", 1))
    for i in range(300, 308):  # short pages, nearly half of whose text is the template's: it goes all the same
        rows.append((i, f"https://e.example.com/{i}", f"<body><div><p>This story is part of our series.</p><p>{text()[:40]} {i}</p></div></body>", "x", 1))
        want[i] = " ".join(rows[-1][2].split("<p>")[2].split("</p>")[0].split())
    df = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 7):
        got = {x.page_id: x.text for x in hw.extract(df.repartition(parts)).collect()}
        assert {i: t for i, t in got.items() if i in want} == want
        assert all(got[i].startswith("short\n\n") for i in range(200, 203))
    few = {x.page_id: x.text for x in hw.extract(df, least=3, share=0.9).collect()}
    assert not any(few[i].startswith("short") for i in range(200, 203))


def test_marks_that_do_not_say_so_drop_nothing(spark):
    cases = {
        '<div class="wrap has-sidebar"><div class="inner"><h1>T</h1><p>one</p></div></div>': "T\n\none",
        '<div class="with-sidebar layout"><h1>T</h1><p>x</p></div>': "T\n\nx",
        "<div class=comments-off><article>in</article><p>out</p></div>": "in",
        '<article><div class="page-header"><h1>T</h1><p>by X</p></div><section class="sharing-economy"><p>a</p></section></article>': "T\n\nby X\n\na",
        '<article><p class="legal">b</p><table class="search-volume"><tr><td>c</table><figure class="header-image"><p>d</figure></article>': "b\n\nc\n\nd",
        '<article><div data-id="related">e</div><p title="class=menu">f</p><p alt=\'id="ad"\'>g</p></article>': "e\n\nf\n\ng",
        '<article>a<div class="comments">no</div><div class="post-footer">no</div><div class="ad wide">no</div><div id="site_menu">no</div><div class=relatedPosts>b</div></article>': "a\n\nb",
        '<div class="wrap sidebar"><article>in<div class=sidebar>no</div></article></div>': "in",
        "<form id=aspnetForm><div><h1>T</h1><p>text</p></div></form>": "T\n\ntext",
        '<div class="sidebar"><p>all the text there is</p></div>': "all the text there is",
        '<div class="content-sidebar-wrap"><div class="sidebar">no</div><main><p>in</p></main></div>': "in",
        '<div class="entry-header"><h1>T</h1></div><div class="entry-content"><p>x</p></div><div class="comments"><article class="comment">no no no no no</article></div>': "T\n\nx",
        '<div role="search"><p>no</p></div><div class="search"><p>no</p></div><main><p>in</p><div class="search"><p>results</p></div></main>': "in\n\nresults",
        '<main><p>in</p><div hidden>no</div><p aria-hidden="true">no</p><p style="color:red;display: none">no</p><p data-hidden="x">yes</p></main>': "in\n\nyes",
    }
    rows = [(i * 10 + k, f"http://h{i}.x/{k}", f"<html><body>{h}</body></html>", None, None) for i, h in enumerate(cases) for k in range(8)]
    by = {x.page_id: x.text for x in hw.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {h: {by[i * 10 + k] for k in range(8)} for i, h in enumerate(cases)} == {h: {t} for h, t in cases.items()}
    assert {h: hw.main_text(h, None) for h in cases} == cases


def test_time_grows_with_the_length_of_odd_pages():
    import time

    shapes = {
        "inline elements, then items": lambda n: "<span>" * n + "<li>x</li>" * n, "sections that never end": lambda n: "<![CDATA[x>" * n,
        "different tags": lambda n: "".join(f"<t{i}>x</t{i}>" for i in range(n)), "quotes": lambda n: "<a '>" * n, "paragraphs": lambda n: "<p>x" * n,
        "cells": lambda n: "<table>" + "<tr><td>x" * n, "nests": lambda n: "<div>" * n, "attributes": lambda n: "<a " + "x " * n + ">",
        "end tags": lambda n: "<b>" * n + "</b>" * n, "lists": lambda n: "<div class='a b'><p>t<ul><li>x" * n, "comments": lambda n: "<!-- " * n,
    }
    for name, shape in shapes.items():
        began = time.process_time()
        n = 20_000
        hw.main_text(shape(n), None)
        assert time.process_time() - began < 12, name


def language(items):
    """The pattern of a wrapper over the marked-up labels of a nest."""
    import re

    def one(x):
        inner = language(x[hw.ITEMS])
        own = f"(?:{inner})" if x[hw.LABEL] == "()" else f"(?:<{re.escape(x[hw.LABEL])}>{inner}</>)"
        return own + {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[x[hw.OPTIONAL], x[hw.REPEATED]]

    return "".join(map(one, items))


def marked_up(node):
    return "".join(("<#text></>" if c.strip() else "") if isinstance(c, str) else f"<{c.label}>{marked_up(c)}</>" for c in node.children)


def test_every_page_is_in_the_language_of_its_wrapper():
    """Wrappers of two to five pages, each read as a regular expression over the pages' nests."""
    import json
    import re

    r = random.Random(11)

    def nest(depth):
        return "".join(f"<{t}>{nest(depth - 1) if depth and r.random() < 0.6 else 'x'}</{t}>" for t in r.choices(["div", "p", "ul", "b", "section"], k=r.randint(0, 4)))

    for _ in range(150):
        pages = [nest(2) for _ in range(r.randint(2, 5))]
        roots = [hw.parse(p) for p in pages]
        wrapper = json.loads(hw.merge([json.dumps([1, hw.items_of(x)]) for x in roots])[0])
        assert wrapper[0] == len(pages)
        pattern = re.compile(language(wrapper[1]))
        for root in roots:
            assert pattern.fullmatch(marked_up(root)), (pages, hw.wrapper_text(wrapper[1]))


def test_hot_hosts_change_nothing(spark, monkeypatch):
    from siltbed.llm import common

    r = random.Random(5)
    df = spark.createDataFrame([(i, f"https://host{i % 3}.example.com/{i}", page(r, i % 3)[0], "x", 1) for i in range(30)] + [(None, None, None, None, None)], SCHEMA)
    want = sorted(map(str, hw.extract(df).collect()))
    for share in (1, 10**9):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        assert sorted(map(str, hw.extract(df).collect())) == want
