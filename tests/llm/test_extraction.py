"""Content regions by text-to-tag ratio: what names do and do not decide, broken pages, and the ratio itself."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest

from facetmill.llm.extraction import content_lines, main_text, smoothed

LINE = "Some longer text of the article that goes on. " * 6
P = f"<p>{LINE}</p>"


def _lines(html):
    return [x[:24] for x in main_text(html).split("\n")]


def test_ratio_and_smoothing_from_the_definition():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 60):
        sizes, tags = rng.integers(1, 400, n).astype(float), rng.integers(0, 9, n).astype(float)
        ratio = [s / max(t, 1) for s, t in zip(sizes, tags)]
        weights = lambda i: [math.exp(-0.5 * ((j - i) / 1.5) ** 2) if abs(j - i) <= 5 else 0 for j in range(n)]
        mean = [sum(w * r for w, r in zip(weights(i), ratio)) / sum(weights(i)) for i in range(n)]
        assert smoothed(sizes / np.maximum(tags, 1)) == pytest.approx(mean)
        limit = min(float(np.std(mean)), max(mean))
        expected = [m >= limit for m in mean]
        close = [abs(m - limit) < 1e-9 for m in mean]
        assert all(c or g == e for g, e, c in zip(content_lines(sizes, tags), expected, close))


def test_lists_of_links_before_the_content_go():
    assert _lines(f"<body><div><a>Home</a> <a>News</a> <a>Contact</a></div>{P * 3}</body>") == [LINE[:24]] * 3
    assert _lines(f"<body><ul><li><a>Home</a></li><li><a>News</a></li></ul>{P * 3}<p>Short end.</p></body>") == [LINE[:24]] * 3 + ["Short end."]


def test_links_and_short_blocks_inside_the_content_stay():
    page = f"<div>{P}<p><a>See this</a></p><ul><li>one</li><li><a>two</a></li></ul>{P}</div>"
    assert _lines(page) == [LINE[:24], "See this", "one", "two", LINE[:24]]


def test_heading_and_short_last_paragraph_of_the_container_stay():
    assert _lines(f"<body><div>Elsewhere</div><div><h1>Title</h1>{P * 4}<p>The end.</p></div><div>Small print</div></body>") == ["Title", *[LINE[:24]] * 4, "The end."]
    assert _lines(f"<body><article><header><h1>Title</h1></header><div>By me</div>{P * 4}<div>End</div></article></body>") == ["Title", "By me", *[LINE[:24]] * 4, "End"]


def test_an_article_in_several_parts_is_whole():
    parts = f"<div>{P * 8}</div><div class='ad'>Buy this</div><div>{P * 3}</div>"
    assert _lines(f"<body>{parts}</body>") == [LINE[:24]] * 11


def test_names_take_away_only_what_they_are_made_for():
    kept = f"<article>{P}<p class='social-history'>History.</p>{P}<p class='search-theory'>Theory.</p>{P}</article>"
    assert _lines(kept) == [LINE[:24], "History.", LINE[:24], "Theory.", LINE[:24]]
    assert _lines(f"<article><p>by <span class='login'>joe</span>.</p>{P * 2}</article>")[0] == "by joe."
    for name in ("ad", "cookie-banner", "sidebar left", "commentList", "ad-slot top", "nav-menu", "relatedPosts share"):
        assert _lines(f"<body><div><p>Lead.</p>{P * 3}</div><div class='{name}'><p>{'Named part. ' * 9}</p></div><div>{P}</div></body>") == ["Lead.", *[LINE[:24]] * 4]


def test_the_ratio_decides_against_a_name_around_most_of_the_content():
    assert _lines(f"<body><div class='sidebar content'>{P * 4}</div><p>{'Another. ' * 4}</p></body>")[:4] == [LINE[:24]] * 4


def test_parts_left_out_by_tag():
    page = f"<body><header>Head</header><nav>Menu</nav><main>{P * 2}<aside>Side</aside><form>Form</form></main><footer>Foot</footer><script>x='</p>'</script></body>"
    assert _lines(page) == [LINE[:24]] * 2


def test_unclosed_menus_do_not_empty_the_page():
    assert _lines(f"<body><nav><ul><li><a>Home</a></li></ul><article>{P * 2}</article></body>") == [LINE[:24]] * 2
    assert _lines(f"<body><nav><a href=x>Home</a>{P * 3}</body>") == [LINE[:24]] * 3


def test_markup_that_is_cut_off():
    for tail in ("<div cla", "<", "</p", "<!-- x <p>y</p>", "<!DOC", "<?x", "<!--"):
        assert main_text(P + tail) == LINE.strip()
    assert main_text(f"<script>a='<!--';</script>{P}") == LINE.strip()
    assert main_text("<p>3 < 4 &amp; 5 > 2 &lt;b&gt; &copy</p>") == "3 < 4 & 5 > 2 <b> ©"


@pytest.mark.parametrize("html", ["<!--" * 260_000, "<" * 200_000, "<a " * 100_000, "<div>" * 60_000 + "x", "<p>x" * 60_000, "</x>" * 100_000, "<li><ul>" * 20_000 + "x"])
def test_time_follows_the_length_of_a_page(html):
    start = time.perf_counter()
    main_text(html)
    assert time.perf_counter() - start < 20


def test_pages_without_text():
    assert [main_text(x) for x in (None, "", "<p></p>", "<nav>Menu</nav>", "<!-- x -->", "   ")] == [""] * 6
