import random

import pytest

from rill.llm import mainpaths
from tests_llm_rows import ODD  # noqa: F401

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>no</article>";</script></head><body class="home">'
    '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <article>not this</article> --><div class="ad">Buy now</div>'
    "{main}<aside>Side</aside><form>Form text</form><div id='comments'><p>I disagree at great length, {noise}</p></div>"
    "<footer>&copy; all</footer></body></html>"
)


@pytest.mark.parametrize("main, want", [
    ("<article><h1>A &amp; B</h1><p>One<b>two</b>\n three<br>four.<p>Five</article>", "A & B Onetwo three four. Five"),
    ("<article class='story'><h1>Head</h1><div class='copy'><p>Long enough text of the story.</p></div></article>", "Head Long enough text of the story."),
    ("<div class='post-12 body'><p>Alpha beta</p><div class=share>Share me</div><p>Gamma</div>", "Alpha beta Gamma"),
    ("<article><p><b>Bold never closed.<br><p>Next one.</p><p>Last &#233;&eacute; &am</p></article>", "Bold never closed. Next one. Last éé &am"),
    ("<article><p>a < b and c > d</p><p title='x > y'>quoted</p><style>p{}</style></article>", "a < b and c > d quoted"),
])
def test_extracts_the_article(main, want):
    page = mainpaths.read_page(PAGE.replace("{main}", main).replace("{noise}", "no"))
    assert mainpaths.extract(page, None) == want


def test_host_consensus_finds_short_articles(spark):
    """Pages whose comments outweigh a short article follow the path that their host votes for."""
    random.seed(1)
    words = lambda n: " ".join(random.choices(["calm", "river", "stone", "light"], k=n))
    rows = []
    for i in range(30):
        text = words(120) if i else "Short note."
        side = words(80) if not i else words(3)
        rows.append((i, f"https://Blog.example.org/{i}", f"<body><div class='c{i}'><div class='lead'>{side}</div></div><div class='entry-{i}'><p>{text}</p></div></body>"))
    got = {r.page_id: r for r in mainpaths.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].text == "Short note." and got[0].n_chars == 11
    assert all(len(got[i].text.split()) == 120 for i in range(1, 30))


def test_odd_pages(spark):
    rows = [
        (None, None, "<p>text", "x"), (1, "not a url", None, "x"), (2, "http://h/", "", "x"), (3, "http://h/", "no markup at all", "x"),
        (3, "http://h/", "no markup at all", "x"), (4, "http://h/", "<" * 3000 + "a \"" * 3000, "x"), (5, "http://h/", "<div>" * 20_000 + "deep", "x"),
        (6, "http://h/", "<nav>only a menu</nav>", "x"), (7, "http://h/", "<article><p>" + "long text " * 100_000, "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in mainpaths.main_texts(df).collect()), key=str)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    by = {i: t for i, t, _ in got}
    assert by[None] == "text" and by[1] == by[2] == by[6] == "" and by[3] == "no markup at all" and len(by[7]) == 999_999 and by[5] == "deep"
    assert mainpaths.main_texts(df.limit(0)).collect() == []


@pytest.mark.parametrize("body", [
    "<div class=post><h1>Head</h1><p>lead</p><div class=body>{t}</div></div>",
    "<main><section class=a><p>Head</p><p>lead</p></section><section class=b>{t}</section></main>",
    "<div class=post><div class=top><h1>Head</h1> <p>lead</p></div><div class=in><div class=body>{t}</div></div></div>",
    "<h1>Head</h1><p>lead</p><table><tr><td>{t}</td></tr></table>",
])
@pytest.mark.parametrize("n", [5, 60])
def test_text_around_the_largest_part_stays(spark, body, n):
    """Headline, lead and small sections around a part with four fifths or nearly all of the text."""
    text = " ".join(["word"] * n)
    page = "<html><body><nav>Menu</nav>" + body.replace("{t}", f"<p>{text}</p>") + "<footer>f</footer></body></html>"
    assert mainpaths.extract(mainpaths.read_page(page), None) == f"Head lead {text}"
    node, _ = mainpaths.best(mainpaths.read_page(page))
    assert mainpaths.extract(mainpaths.read_page(page), [node.path]) == f"Head lead {text}"


def test_articles_split_over_winning_paths():
    page = mainpaths.read_page("<body><div class=one><p>First part.</p></div><div class=ad>Buy</div><div class=two><p>Second part.</p></div></body>")
    assert mainpaths.extract(page, [">body>div.one", ">body>div.two"]) == "First part. Second part."


@pytest.mark.parametrize("main, want", [
    ("<div class='content no-sidebar'><h1>Head</h1><p>Text here.</p></div>", "Head Text here."),
    ("<div class='layout with-comments'><article><p>Text here.</p></article></div>", "Text here."),
    ("<article><h2 id='related-work'>Related</h2><p id='notice'>Note.</p><section id='search'><h2>Search</h2>Find.</section></article>", "Related Note. Search Find."),
    ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><object data=a>Fallback</object></article>", "So x=1. Fallback"),
    ("<div class='widget'><p>" + "All of the text. " * 20 + "</p><div class='site-footer'>Foot</div></div>", ("All of the text. " * 20).strip()),
    ("<article><p>Text here, long enough to outweigh.</p><div class='ad-slot'>Buy</div><ul class='main-nav'><li>Home</ul></article>", "Text here, long enough to outweigh."),
])
def test_names_that_only_sound_like_boilerplate(main, want):
    page = f"<html><body><nav>Menu</nav>{main}<footer>Foot</footer></body></html>"
    assert mainpaths.extract(mainpaths.read_page(page), None) == want


def test_pages_left_empty_are_read_again():
    read = lambda x: mainpaths.extract(mainpaths.read_page(x), None)
    assert read("<body><div class=widget><p>One part</p></div><div class=promo><p>Two part</p></div></body>") == "One part Two part"
    assert read("<body><div class=widget><nav>Menu</nav></div></body>") == ""


@pytest.mark.parametrize("n", [10, 5_000, 200_000])
def test_quoted_values_of_any_length(n):
    for quote, other in ("\"'", "'\""):
        value = f"a > <b>{'b' * n}</div><nav class={other}x{other}>"
        page = f"<body><div data-x={quote}{value}{quote} class='ad'><p>Buy</p></div><article><p data-x={quote}{value}{quote}>Text here, long enough.</p></article></body>"
        assert mainpaths.extract(mainpaths.read_page(page), None) == "Text here, long enough."


def test_quotes_left_open():
    read = lambda x: mainpaths.extract(mainpaths.read_page(x), None)
    assert read("<body><p title=\"open>One</p><p>Two</p></body>") == "One Two"
    assert read("<body><p title=\"closed\"\">One</p><p title=it's>Two</p></body>") == "One Two"
    for odd in ("<p b=\"", "<p ", "<p b='\"", "<p b=\"'>"):
        mainpaths.read_page(odd * 50_000)  # in time that grows with the length only


def test_a_rarer_template_keeps_its_article(spark):
    """Its pages have a teaser on the path that the host's other pages vote for."""
    words = lambda n, w: " ".join([w] * n)
    rows = [(i, f"http://h/{i}", f"<body><div class=content><p>{words(60, 'news')}</p></div></body>") for i in range(40)]
    rows += [(100 + i, f"http://h/x{i}", f"<body><div class=content><p>short teaser</p></div><div class=main><p>{words(90, 'story')}</p></div></body>") for i in range(3)]
    got = {r.page_id: r.text for r in mainpaths.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == words(60, "news") for i in range(40))
    assert all(got[100 + i] == words(90, "story") for i in range(3))


@pytest.mark.parametrize("page, want", [
    ("<body><form id=f><div class=content><p>The article.</p></div></form></body>", "The article."),
    ("<body><nav>Menu</nav><form action=/><div class=top>Search</div><div class=content><p>" + "The article. " * 9 + "</p></div></form></body>", ("The article. " * 9).strip()),
    ("<body><article><header><h1>Title</h1></header><p>Text of the article, long enough.</p></article></body>", "Title Text of the article, long enough."),
    ("<body><header><p>Site name</p></header><article><p>Text of the article, long enough.</p></article><form>Join</form></body>", "Text of the article, long enough."),
    ("<body><article><p>Text of the article, long enough to stand.</p><p class=advert>Buy</p><p id=ad>Kept.</p></article></body>", "Text of the article, long enough to stand. Kept."),
])
def test_forms_headers_and_marked_paragraphs(page, want):
    assert mainpaths.extract(mainpaths.read_page(page), None) == want


def test_links_depth_and_closed_scripts_take_linear_time():
    import time

    def took(page):
        start = time.process_time()
        mainpaths.best(mainpaths.read_page(page))
        return time.process_time() - start

    for make in (
        lambda n: "<div>" * n + "<a href=x>y</a>" * n, lambda n: "<p>t</p>" + "<script/>" * n, lambda n: "<div>t" * n,
        lambda n: "<div><h1>t</h1></div>" * n,
    ):
        took(make(500))
        assert took(make(16_000)) < 60 * max(took(make(1_000)), 0.005)


def plain_extract(blocks):
    return " ".join(" ".join(b.split()) for b in blocks if b.split())


def test_generated_sites_of_several_templates(spark):
    """Each host mixes templates; the texts that the generator put into the article come back, and nothing else."""
    random.seed(21)
    words = lambda lo, hi: " ".join(random.choices(["calm", "river", "stone", "light", "caf\u00e9", "&amp;"], k=random.randint(lo, hi)))
    templates = [
        lambda body: f"<main><section>{body}</section></main>", lambda body: f"<div class='wrap-7'><div class='post post-123'>{body}</div></div>",
        lambda body: f"<article class=entry>{body}</article>", lambda body: f"<table><tr><td class=text>{body}</td></tr></table>",
        lambda body: f"<form id=aspnet><div class=content>{body}</div></form>",
    ]
    rows, want = [], {}
    for i in range(300):
        host = i % 4
        template = templates[(host + (i // 4 % 10 == 0) + 2 * (i // 4 % 10 == 1)) % len(templates)]
        blocks = [words(15, 60) for _ in range(random.randint(1, 6))]
        body = "".join(f"<p>{b}</p>" for b in blocks)
        rows.append((i, f"https://h{host}.org/{i}", f"<html><head><title>x</title></head><body><nav><ul><li><a href=/>Home {words(1, 3)}</a></ul></nav><div class=ad>Buy {words(1, 4)}</div>"
                     f"{template(body)}<aside>{words(1, 9)}</aside><div id=comments><p>{words(1, 30)}</p></div><footer>{words(1, 5)}</footer></body></html>"))
        want[i] = plain_extract([b.replace("&amp;", "&") for b in blocks])
    got = {r.page_id: r.text for r in mainpaths.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
