"""HTML extraction: the cut against all labellings, whole pages of several makes."""

import html
import itertools
import random
import re

import pytest

from rollcall.llm import mincut
from rollcall.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, Main_Text string, _source int"
LONG = ("The river rose in the night, and by the morning the lower fields were under water. "
        "People from the village carried what they could to the church, which stands higher. "
        "Nobody was hurt.")
MORE = ("Three days later the water had gone. It left mud in every house, and the work of cleaning "
        "began before the roads were open again.")
TALK = ("I live two streets away and can say that it was far worse than it is told here. We had no "
        "power for a week. The council did nothing at all, and it will not next time either.")


def cost(gains, edges, kept):
    return (sum(g for g, k in zip(gains, kept) if g > 0 and not k)
            + sum(-g for g, k in zip(gains, kept) if g < 0 and k)
            + sum(w for a, b, w in edges if kept[a] != kept[b]))


def test_cut_is_least_of_all_labellings():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 9)
        gains = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 9)) for a in range(n) for b in range(a + 1, n)
                 if rng.random() < 0.5]
        best = min(cost(gains, edges, kept) for kept in itertools.product((0, 1), repeat=n))
        assert cost(gains, edges, mincut.minimum_cut(gains, edges)) == best


def test_long_chain_is_cut_without_recursion():
    gains = [5 if i % 1000 < 500 else -5 for i in range(20_000)]
    kept = mincut.minimum_cut(gains, [(i, i + 1, 3) for i in range(19_999)])
    assert kept == [g > 0 for g in gains]


PAGES = {
    "article": (f"<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>"
                f"<article><header><h1>The flood</h1></header><p>{LONG}</p><p>Short.</p><p>{MORE}"
                f"<aside><p>{TALK}</p></aside><footer>Filed under weather.</footer></article>"
                f"<footer>&copy; 2020 Paper</footer>", f"The flood {LONG} Short. {MORE}"),
    "classes": (f"<div class='top-menu'><a href=/>Home</a> <a href=/n>News</a></div>"
                f"<div class='page has-sidebar'><div id=content><h2>The flood</h2><div>{LONG}</div>"
                f"<div class=advert>{MORE}</div><div>{MORE}</div></div>"
                f"<div class='sidebar widget'><p>{TALK}</p></div>"
                f"<div id=comments><article><p>{TALK}</p></article></div></div>"
                f"<div class=cookie-notice><p>We use cookies. They are good for you. Say yes.</p></div>",
                f"The flood {LONG} {MORE}"),
    "bare": (f"<div><a href=/>Home</a> | <a href=/n>News</a> | <a href=/s>Sport</a></div>"
             f"<div><h1>The flood of the year</h1><p>{LONG}</p><p>It was over.</p><p>{MORE}</p></div>"
             f"<div><a href=/a>About</a> <a href=/c>Contact</a></div>"
             f"<div>&copy; 2020 All rights reserved</div>",
             f"The flood of the year {LONG} It was over. {MORE}"),
    "form": (f"<form method=post><input type=hidden name=a><div class=menu>Home News</div>"
             f"<article><p>{LONG}</p><form><label>Mail</label><p>{TALK}</p><button>Go</button></form>"
             f"</article></form>", LONG),
    "broken": (f"<p><b>{LONG}<br><p>{MORE}</p></i></b></div><!-- <p>{TALK}</p> --><script>var a='</p>"
               f"<p>{TALK}';</script><style>p{{}}</style><p hidden>{TALK}</p><p title=\"a>b\">End of it."
               f"</p><a b='", f"{LONG} {MORE} End of it."),
    "references": ("<article><p>a &amp;lt; b &lt;i&gt;\n\t c&nbsp;&eacute;&#233;&#xE9; x<b>y</b>z</p>"
                   "<p>1 < 2 and 3 > 2 </p></article>", "a &lt; b <i> c ééé xyz 1 < 2 and 3 > 2"),
    "plain": (LONG, LONG),
    "empty": ("", ""), "null": (None, ""), "nothing": ("<nav><a href=/>Home</a></nav>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    source, want = PAGES[name]
    assert mincut.main_text(source) == want


def test_smoothness_decides_what_words_do_not():
    page = "<div>%s<p>%s</p><p>Yes.</p><p>%s</p></div>" % (
        "<p><a href=/>More about us</a></p>" * 4, LONG, MORE)
    blocks = mincut.blocks_of(page)
    alone = [mincut.score(b) > 0 for b in blocks]
    assert mincut.main_text(page) == f"{LONG} Yes. {MORE}" and alone[:4] == [False] * 4


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 50_000 + f"<p>{LONG}</p>" + "</div>" * 50_000
    assert mincut.main_text(deep) == LONG
    assert mincut.main_text("<b>" * 30_000 + "<i>x y </i></u>" * 1000) == "x y " * 999 + "x y"
    assert mincut.main_text("<!--" * 100_000) == "" and mincut.main_text("<a b='" * 30_000) == ""
    many = "<article>" + f"<p>{LONG}</p>" * 5000
    assert mincut.main_text(many) == " ".join([LONG] * 5000)


def expected(source):
    """The article of a given page, by its own tags."""
    found = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
    text = re.sub(r"<[^>]*>", "", re.sub(r"<(?:p|/p|br|h1|/h1)>", " ", found[1]))
    return " ".join(html.unescape(text).split())


def test_given_pages_without_their_article_tag(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    right = total = 0
    for r in rows:
        bare = r.html.replace("<article>", "<div>").replace("</article>", "</div>").replace(
            ' class="ad"', "")
        got, want = mincut.main_text(bare), expected(r.html)
        total += len(want) + len(got)
        right += 2 * len(want) if got == want else 2 * len(want) * (want in got) \
            or 2 * len(got) * (got in want)
    assert right / total > 0.9


def test_extract_keeps_rows_and_columns(spark):
    rows = [(1, "u", PAGES["article"][0], "x", 1), (1, "u", PAGES["article"][0], "x", 1),
            (None, None, None, None, None), (2, None, "", "y", 2)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = mincut.extract(pages)
    assert got.columns == [*pages.columns, "main_text_"]
    assert sorted((str(r.page_id), r["main_text_"]) for r in got.collect()) == [
        ("1", PAGES["article"][1])] * 2 + [("2", ""), ("None", "")]
    assert mincut.extract(pages.where("false")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = {r.page_id: expected(r.html)
            for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op11_html_text"](spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert {r.page_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)
