import pytest

from tidemark.llm import html_text as h

PROSE = "A sentence of some length that fills the page with words, again and again. "


def paragraphs(n):
    return "".join(f"<p>{PROSE * 3}{k}</p>" for k in range(n))


def expected(n):
    return [f"{PROSE * 3}{k}" for k in range(n)]


AROUND = (
    "<header><h1>Site</h1></header><nav><ul><li><a href=/a>One</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies. " + PROSE * 5 + "</div>"
    "<aside><p>" + PROSE * 4 + "</p></aside>"
)
BEHIND = (
    "<form><label>Mail</label><input name=a></form><section id=comments><article>"
    "<p>" + PROSE * 6 + "</p></article></section><footer>&copy; site</footer>"
)


def test_article_without_its_surroundings():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body>" + AROUND
        + "<article><h1>Head &amp; line</h1><p>Short.</p>" + paragraphs(3)
        + "<script>var a='</p>'</script><div class=ad>Buy</div><p>End&nbsp; of\n it</p></article>"
        + BEHIND + "</body></html>"
    )
    assert h.main_text(page).split("\n") == [
        "Head & line", "Short.", *expected(3), "End of it",
    ]


def test_region_without_article_element():
    page = (
        "<body><div class=top><a href=x>Home</a> <a href=y>News</a></div>" + AROUND
        + "<div><div class=story>" + paragraphs(4) + "<p>Short.</p>" + paragraphs(2) + "</div>"
        "<div><ul>" + "<li><a href=z>More</a></li>" * 8 + "</ul></div></div>" + BEHIND
    )
    assert h.main_text(page).split("\n") == [*expected(4), "Short.", *expected(2)]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<nav>only a menu</nav>", ""),
        ("just text", "just text"),
        ("<article><p><b>A<br><p>B<p>C", "A\nB\nC"),
        ("<article><p>x &lt;b&gt; &#233; &eacute;</p></article>", "x <b> é é"),
        ("<article><p>a</p><![weird[ b</article>", None),
        ("<div><article><p>one</p></div></article><p>after", None),
        ("<nav><a>menu</a><article><p>inside an open menu</p></article>", "inside an open menu"),
        ("<article><p>t" + "</div>" * 50 + "<p>u</article>", "t\nu"),
        ("<head><title>never closed<body><article><p>x</p>", "x"),
    ],
)
def test_odd_pages(page, text):
    found = h.main_text(page)
    assert found == (found if text is None else text)


def test_deep_and_long_pages_stay_fast():
    page = "<div>" * 3000 + paragraphs(3) + "</div>" * 3000
    assert h.main_text(page).split("\n") == expected(3)
    assert h.main_text("<article>" + paragraphs(3000)).count("\n") == 2999


def test_smoothing_and_threshold():
    assert h.smoothed([1.0] * 5) == pytest.approx([1.0] * 5)
    assert h.threshold([1, 2, 1, 100, 90]) == pytest.approx((4 / 3 + 95) / 2)
    assert h.threshold([3, 3]) == 3


def lengths(*sizes):
    return [("word " * 600)[: n - 1] + "." for n in sizes]


@pytest.mark.parametrize(
    "sizes",
    [
        (20, 60, 300, 300, 300, 60),
        (30, 120, 150, 140, 130, 2500, 140, 150, 120),
        (40, 200, 260, 240, 900, 850, 230, 210, 190),
    ],
)
def test_regions_keep_short_and_long_lines(sizes):
    first, *rest = lengths(*sizes)
    story = f"<h2>{first}</h2>" + "".join(f"<p>{t}</p>" for t in rest)
    links = "<div><ul>" + "<li><a href=z>More</a></li>" * 8 + "</ul></div>"
    pages = [
        f"<body>{AROUND}<div class=story>{story}</div>{BEHIND}",
        f"<body>{links}<div><div class=story>{story}</div></div>{links}",
        f"<body><div class=top><a href=x>Home</a></div>{story}<a href=z>More</a>",
    ]
    for page in pages:
        assert h.main_text(page).split("\n") == [first, *rest]


def test_every_region_stays():
    small, large = "<p>A few words.</p>", paragraphs(3)
    both = ["A few words.", *expected(3)]
    for page in (
        f"<body><article>{small}</article><article>{large}</article>",
        f"<body>{AROUND}<article>{small}</article>{BEHIND}<article>{large}</article>",
        f"<body><section>{small}</section><section>{large}</section>",
        f"<body><article>{small}</article><div>{large}</div>",
        f"<body><main><article>{small}</article><article>{large}</article></main>",
    ):
        assert h.main_text(page).split("\n") == both


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><div>{}</div>",
        "<body class=sidebar><div>{}</div>",
        "<div class='content no-sidebar'>{}</div>",
        "<div class=widget>{}</div>",
        "<article><section id='legal-analysis'>{}</section></article>",
        "<article><div class='search-results'>{}</div></article>",
        "<head><meta charset=utf-8><div>{}</div>",
        "<head><title>T</title>{}",
        "<div><select><option>A<option>B</select>{}</div>",
        "<div class=site-footer><p>&copy; site</p></div><div>{}</div>",
    ],
)
def test_no_text_vanishes(page):
    assert h.main_text(page.format(paragraphs(3))).split("\n") == expected(3)


def test_text_in_an_open_head():
    assert h.main_text("<head><meta charset=utf-8>Just text<p>more") == "Just text\nmore"


# What surrounds an article, under names of many kinds.
LEAKS = [
    "reader-comments", "user-comments", "comment-thread", "ad-slot", "ad-unit",
    "related-posts", "related-articles", "sticky-banner", "cookie-message", "left-rail",
    "article-footer", "siteFooter", "post-share-buttons", "newsletter-signup", "breadcrumb",
]
LEAK = "<p>" + "Some words that belong to no article at all. " * 4 + "</p>"


@pytest.mark.parametrize("name", LEAKS)
@pytest.mark.parametrize(
    "page",
    [
        "<body><article>{0}<div class='{1}'>{2}</div>{0}</article>",
        "<body><article>{0}</article><div class='{1}'>{2}</div>",
        "<body><div><div class=story>{0}{0}</div><div id='{1}'>{2}</div></div>",
    ],
)
def test_named_surroundings_go(name, page):
    text = h.main_text(page.format(paragraphs(4), name, LEAK))
    assert "belong to no article" not in text
    assert text.count("\n") in (3, 7)


RIGHTS = "<div>Copyright 2024 Somebody. All rights reserved.</div>"
COOKIES = "<div>We use cookies on this site. <button>Accept</button></div>"
LINKS = "<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>"
BARE = "<ul><li>Home<li>News<li>Sport</ul>"
# (page, whether the two paragraph runs have something between them that stays)
PAGES = [
    f"<body><div>{{}}</div>{RIGHTS}",
    f"<body>{COOKIES}<div>{{}}</div>",
    f"<body><main>{LINKS}{{}}</main>",
    f"<body><main>{{}}{LINKS}</main>",
    f"<body>{BARE}<div>{{}}</div>{BARE}",
    f"<body><div>{BARE}</div><section>{{}}</section>",
    f"<body>{LINKS}{{}}{LINKS}{RIGHTS}",
    f"<body><table><tr><td>{LINKS}<td>{{}}</table>",
    f"<body><div><div>{BARE}</div><div>{{}}</div><div>{COOKIES}</div></div>",
    f"<body><main><div>{COOKIES}</div><div>{{}}</div>{RIGHTS}</main>",
    "<body><div><p>Copyright 2024 Somebody</p></div><div>{}</div>",
    "<body><div>{}</div><div><p>&copy; Somebody</p></div>",
]


@pytest.mark.parametrize("page", PAGES)
def test_unnamed_surroundings_go(page):
    assert h.main_text(page.format(paragraphs(4))).split("\n") == expected(4)


@pytest.mark.parametrize(
    "inside, lines",
    [
        ("<p><a href=a>An opening paragraph that is a link</a></p>{}", ["An opening paragraph that is a link", None]),
        ("{}<p><a href=a>A closing paragraph that is a link</a></p>", [None, "A closing paragraph that is a link"]),
        ("<div><h1>Title</h1></div>{}", ["Title", None]),
        ("<div><p>By somebody</p></div><div>{}</div>", ["By somebody", None]),
        ("{}<ul><li>First<li>Second</ul>{}", [None, "First", "Second", None]),
        ("{}<table><tr><td>1<td>2</table>{}", [None, "1", "2", None]),
    ],
)
@pytest.mark.parametrize("around", ["<body><div>{}</div>", "<body><main>{}</main>", "<article>{}</article>"])
def test_lines_of_the_article_stay(around, inside, lines):
    runs = inside.count("{}")
    page = around.format(inside.format(*[paragraphs(3)] * runs))
    want = [x for line in lines for x in (expected(3) if line is None else [line])]
    assert h.main_text(page).split("\n") == want


def test_the_clusters_decide(monkeypatch):
    """With every line in the upper cluster, what they tell apart comes along."""
    page = PAGES[4].format(paragraphs(4))
    assert h.main_text(page).split("\n") == expected(4)
    monkeypatch.setattr(h, "threshold", lambda values: 0.0)
    assert "Sport" in h.main_text(page)
    changed = sum(h.main_text(p.format(paragraphs(4))).split("\n") != expected(4) for p in PAGES)
    assert changed >= 6


@pytest.mark.parametrize(
    "piece",
    ["<div><p>word</p>", "<div class=ad><p>word</p>", "<p>word<br>", "</p></div>word", "<ul><li>word",
     "<article><p>word</p></article>", "<article><p>word", "<a href=x>word"],
)
def test_megabytes_of_broken_markup(piece):
    import time

    page = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    h.main_text(page)
    assert time.perf_counter() - start < 15  # some 3 s; quadratic work took minutes
