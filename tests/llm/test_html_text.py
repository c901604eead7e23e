import pytest

from txstream.llm import html_text as h

PAGES = [
    ('<html><head><title>T t t t t t t t t t</title><style>p{x}</style></head><body><header><a href="/">Home page'
     ' of us</a></header><nav><ul><li><a href="#">One</a></li></ul></nav><div class="cookie-notice">We use'
     ' cookies a lot here, really a lot</div><main><h1>Head &amp; line</h1><p>First <b>bold</b>,\n  text&nbsp;here'
     '</p><script>var t="</p> words words";</script><aside>Buy this now and more</aside><p>Second &lt;p&gt;'
     ' para.</p><ul><li>item one</li><li>item two</li></ul><div class="ad">Advert text</div><p>Last <a href="x">'
     'link</a> words.</p><section id="comments"><p>I like it very much indeed</p></section></main><footer>&copy;'
     ' all rights reserved by everyone</footer></body></html>',
     "Head & line\n\nFirst bold, text here\n\nSecond <p> para.\n\nitem one\n\nitem two\n\nLast link words."),
    ("<body><nav>menu menu</nav><div>A plain page of words that is its text.</div><footer>foot foot",
     "A plain page of words that is its text."),
    ("<p>one<p>two<br>three<p cla", "one\n\ntwo three"), ("just words &am", "just words &am"),
    ("<article><h1>x</h1><p>a <!-- gone -->b &amp", "x\n\na b &"), ("<script>only", ""), ("", ""), (None, ""),
    ("<p>2 < 3 and <3</p>", "2 < 3 and <3"), ("<DIV CLASS=Sidebar>side side</DIV><P>Main text here</P>",
                                              "Main text here"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_pages(page, want):
    assert h.extract(page, dict(h.PRIOR)) == want


def test_best_stretch_equals_all_ranges():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(-4, 5, rng.integers(0, 15)).astype(float)
        a, b = h.best_stretch(s)
        best = max([s[i:j].sum() for i in range(len(s)) for j in range(i + 1, len(s) + 1)], default=0)
        assert (s[a:b].sum() if b > a else 0) == max(0, best)


def test_weights_are_learned_and_not_positive():
    page = ("<body><p class=x>" + "lead " * 12 + "</p><hr><article><p>" + "text " * 30 + "</p></article><hr><p>"
            + "tail " * 9 + "</p></body>")
    w = h.learn([page] * 20)
    assert max(w.values()) <= 0 and w["hr"] < -1
    assert h.extract(page, w) == ("text " * 30).strip()


def test_spark_rows(spark):
    rows = [(i if i else None, "u", p, "clash") for i, (p, _) in enumerate(PAGES)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = h.main_text(df, dict(h.PRIOR)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted(
        (i, t, len(t)) for i, (_, t) in enumerate(PAGES) for _ in range(2))
    assert h.main_text(df.limit(0)).count() == 0
    assert h.main_text(df).count() == len(rows)


LONG = "buy this now " * 40
MENU = "<ul>" + "<li><a href=x>go to part</a></li>" * 100 + "</ul>"


@pytest.mark.parametrize("block", [f"<aside>{LONG}</aside>", f"<form><p>{LONG}</p></form>", f"<nav>{MENU}</nav>",
                                   f'<div class="newsletter"><div>{LONG}</div></div>',
                                   f"<div><aside>{LONG}</aside></div><aside>{LONG}</aside>"])
@pytest.mark.parametrize("before, after", [
    ("<article>", "</article>"), ("<article>", ""), ("<main><section>", "</section></main>"), ("<body>", "</body>"),
    ("<div id=content>", "</div>"), ("", "")])
def test_long_boilerplate_within_a_text(block, before, after):
    head, last = "<h1>six word title stands right here</h1>", "<p>a short last paragraph</p>"
    text = "words of the text " * 20
    got = h.extract(f"{before}{head}{block}<p>{text}</p>{block}{last}{after}", dict(h.PRIOR))
    assert got.split("\n\n") == ["six word title stands right here", text.strip(), "a short last paragraph"]


def test_long_boilerplate_between_like_containers():
    page = f"<body><div class=p>one two three four five</div><aside>{LONG}</aside><div class=p>{'text ' * 30}</div>"
    assert h.extract(page, dict(h.PRIOR)).startswith("one two")


def test_long_boilerplate_between_parts_keeps_its_cost():
    text = "text " * 30
    for part in (f"<article><p>{text}</p></article>", f"<div><main><p>{text}</p></main></div>", f"<div>{text}</div>"):
        page = f"<body><p>site name and a claim</p><nav>{MENU}</nav>{part}<aside>{LONG}</aside><p>tail of it</p></body>"
        assert h.extract(page, dict(h.PRIOR)) == text.strip()


def test_learning_ignores_what_scores_nothing():
    page = f"<body><article><h1>six word title stands right here</h1><aside><b>{LONG}</b></aside><p>x y</p></article>"
    assert h.learn([page + "</body>"] * 5) == h.PRIOR


@pytest.mark.parametrize("page", [
    "<article class='post share'><p>{0}</p><article class='comment'><p>I like it</p></article></article>",
    "<main id=related><p>{0}</p><article class=Comment><p>I like it</p></article></main>",
    "<article><p>{0}</p></article><article id='reply-7'><p>I like it</p></article>",
    "<main><article class=post><p>{0}</p><article role='complementary'><p>I like it</p></article></article></main>"])
def test_articles_that_are_comments(page):
    source = "<body>" + page.format("text " * 30) + "</body>"
    assert h.extract(source, dict(h.PRIOR)) == ("text " * 30).strip()
    parsed = h.Page(source)
    assert parsed.region() and "".join(h.Page(source).blocks(*parsed.region())) == ("text " * 30).strip()


TEXT = "text words here " * 20


@pytest.mark.parametrize("page", [
    '<div class="layout no-sidebar"><article><p>{0}</p></article></div>',
    '<div id="wrap" class="with-header sticky-nav"><nav>a b</nav><article><p>{0}</p></article></div>',
    '<form id="aspnetForm"><article><p>{0}</p></article></form>', '<p data-id="search">{0}</p>',
    '<p title="see class=ad here">{0}</p>', "<p don't>{0}</p>", '<p class=x data-x="> class=ad">{0}</p>',
    '<body class=x><div class="sidebar-right"><div class=content><p>{0}</p></div><aside>side side</aside></div>',
    '<article><div class="share-enabled body">{0}</div><section id=comments>' + "spam ham " * 300 + "</section></article>",
    '<article><div class="post-header">{0}</div></article>', '<div class="headerless"><p>{0}</p></div>',
    '<div class=menu><main><p>{0}</p></main></div><footer>' + "foot note " * 20 + "</footer>",
    '<DIV CLASS="Search"><p>{0}</p></DIV><nav>a b c</nav>'])
def test_frames_states_and_attributes_keep_the_text(page):
    assert h.extract(page.format(TEXT), dict(h.PRIOR)) == TEXT.strip()


def test_words_between_apostrophes_are_no_attribute():
    page = f"<p>one <img alt=John's house>these words stay don't <b class='x'>you</b> see</p><p>{TEXT}</p>"
    assert h.extract(page, dict(h.PRIOR)).startswith("one these words stay don't you see\n\n")


def test_nested_headings_and_tables_stay_in_their_region():
    page = f"<main><div><div><div><h1>Two words</h1></div></div></div><p>{TEXT}</p></main>"
    assert h.extract(page, dict(h.PRIOR)) == "Two words\n\n" + TEXT.strip()
    rows = "".join(f"<tr><td>a{i}</td><td>b{i}</td></tr>" for i in range(40))
    got = h.extract(f"<article><table>{rows}</table><p>closing words</p></article>", dict(h.PRIOR))
    assert got.split("\n\n") == [x for i in range(40) for x in (f"a{i}", f"b{i}")] + ["closing words"]
    plain = h.extract(f"<body><table>{rows}</table><p>closing words</p></body>", dict(h.PRIOR))
    assert plain == got


def test_comments_are_no_frame():
    page = "<article><p>short text of it</p><div class='comments'>" + "I like it very much " * 50 + "</div></article>"
    assert h.extract(page, dict(h.PRIOR)) == "short text of it"


def test_class_tokens_are_learned():
    """A boilerplate word around all texts is content; an unknown token beside them is not."""
    page = ("<body><div class='teaserbox'><p>" + "read more of this " * 8 + "</p></div><div class='widget'><article><p>"
            + TEXT + "</p></article></div></body>")
    w = h.learn([page] * h.SEEN)
    assert w[".teaserbox"] < 0 and w[".widget"] == 0 and max(w.values()) <= 0
    other = "<body><div class='teaserbox'><p>" + "read more " * 30 + "</p></div><div class='widget'><p>" + TEXT
    assert h.extract(other + "</p></div></body>", w) == TEXT.strip()
    assert ".widget" not in h.learn([page] * (h.SEEN - 1))


def twin(rng):
    """A page with a known article: random wrappers, classes, attributes and boilerplate."""
    words = lambda n: " ".join(rng.choice(["ant", "bee", "cat's", "dog", "émeu", "fox"]) for _ in range(n))
    spare = lambda: "".join(rng.choice([                                                                     # noqa: E731
        "", f"<nav><ul><li><a href='/x'>{words(2)}</a></li></ul></nav>", f"<aside>{words(9)}</aside>",
        f"<div class='ad-slot'>{words(6)}</div>", f"<script>var a='<p>{words(3)}</p>';</script>",
        f"<div id=cookieNotice>{words(12)}</div>", "<!-- <article>no</article> -->",
        f"<form action='?a=1&b=2'><label>{words(2)}</label></form>",
        f"<section class='x comments'><article class=comment><p>{words(8)}</p></article></section>"])
        for _ in range(rng.randrange(3)))
    extra = lambda: rng.choice(["", " class='layout no-sidebar'", ' data-class="ad"', " title='class=ad >'",      # noqa: E731
                                ' id="main-wrap" class="has-header"', " style=x", " hidden-nav", ' class="with-menu"'])
    blocks, html = [], ""
    for _ in range(rng.randrange(2, 9)):
        t = words(rng.randrange(1, 40))
        kind = rng.choice(["p", "h2", "div", "table", "ul", "deep"])
        blocks.append(t)
        if kind == "table":
            html += f"<table><tr><td{extra()}>{t}</td></tr></table>"
        elif kind == "ul":
            html += f"<ul><li>{t}</li></ul>"
        elif kind == "deep":
            html += f"<div{extra()}><div><div><p>{t}</p></div></div></div>"
        else:
            a, b = t.split(" ", 1) if " " in t else (t, "")
            html += f"<{kind}{extra()}>{a} <b>{b}</b></{kind}>"
        html += spare()
    name = rng.choice(["article", "main"])
    html = f"{spare()}<{name}{extra()}>{html}</{name}>{spare()}"
    for _ in range(rng.randrange(4)):
        tag = rng.choice(["div", "form", "section", "div"])
        html = f"{spare()}<{tag}{extra()}>{html}</{tag}>{spare()}"
    page = f"<html><head><title>{words(3)}</title></head><body{extra()}>{html}<footer>{words(5)}</footer></body></html>"
    return page, "\n\n".join(blocks)


def test_generated_pages_give_exactly_their_article():
    import random
    rng = random.Random(7)
    pages = [twin(rng) for _ in range(400)]
    learned = h.learn([p for p, _ in pages[:60]])
    for weights in (dict(h.PRIOR), learned):
        for page, want in pages:
            assert h.extract(page, weights) == want, page


def test_the_sample_is_never_empty(spark):
    df = spark.range(500).selectExpr("id page_id", "'u' url",
                                     "concat('<article><p>', repeat('text ', 20), id, '</p></article>') html")
    assert "p" in h.train(df, sample=1) and h.train(df.limit(0), sample=5) == h.PRIOR
    assert h.main_text(df, sample=3).where("n_chars < 100").count() == 0
