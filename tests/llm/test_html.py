import pytest
from pyspark.sql import functions as F

from tablewright.llm.html import extract, main_text

ARTICLE = "word " * 40


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<nav>a</nav>", ""), ("plain &amp; <b>bold</b>", "plain & bold"), ("<p>a<p>b<ul><li>c<li>d</ul>", "a\nb\nc\nd"),
        ("<body><div class=ad>x</div><article><h1>T</h1><p><b>one<br><p>two&nbsp;&#8230;</article><footer>f", "T\none\ntwo …"),
        ("<body><article><p>in</p><section id=comments><article class=comment>no</article></section><aside>no</aside></article>", "in"),
        ("<script>if (a<b) x('</p>')</script><p>kept</p><!-- c --><style>p{}</style>", "kept"),
        ("<div " * 3 + "x", ""), ("a < b and c > d", "a < b and c > d"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_density_picks_the_article():
    page = f"<body><div><a href=1>one</a> <a href=2>two</a></div><div id=x><p>{ARTICLE}</p><p>{ARTICLE}</p><p>end</p></div><div class='cookie-notice'>{ARTICLE}</div><div class='has-sidebar'><p>{ARTICLE}</p></div>"
    assert main_text(page) == "\n".join([ARTICLE.strip()] * 2 + ["end", ARTICLE.strip()])


@pytest.mark.parametrize("wrap", ["<div id=c>{}</div>", "<div><div id=c>{}</div></div>", "{}", "<main>{}</main>", "<main><section>{}</section></main>"])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_every_section(wrap, tag):
    """An article of two sections, with headings, a short paragraph and a link list beside them."""
    one, two = (f"<{tag}>" + "".join(f"<p>{s}{k} {ARTICLE}</p>" for k in range(n)) + f"</{tag}>" for s, n in (("one", 5), ("two", 4)))
    links = "<div>" + "".join(f"<a href={k}>link {k}</a> " for k in range(9)) + "</div>"
    lines = [f"{s}{k} {ARTICLE}".strip() for s, n in (("one", 5), ("two", 4)) for k in range(n)]
    alone = tag == "article" and "main" not in wrap  # declared articles, nothing beside them
    text = main_text("<body>" + links + wrap.format(f"<h1>Title</h1>{one}<h2>More</h2>{two}<p>The end.</p>"))
    if wrap == "<main>{}</main>" or wrap == "<main><section>{}</section></main>" or not alone:
        assert text.split("\n") == ["Title", *lines[:5], "More", *lines[5:], "The end."]
    else:
        assert text.split("\n") == lines


def test_articles_in_sections():
    one = f"<section><article><p>one {ARTICLE}</p></article></section>"
    page = f"<body>{one}<section><article><h2>Two</h2><p>short</p></article></section><article><a href=1>a teaser</a></article>"
    assert main_text(page) == f"one {ARTICLE}".strip() + "\nTwo\nshort"


def test_deep_and_long():
    assert main_text("<div>" * 5000 + "deep") == "deep"
    assert len(main_text("<p>" + "word " * 200_000)) == 999_999


def test_column(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (1, "<p>a"), (2, None)], "page_id long, text string").withColumn("n_chars", F.lit(1))
    assert [r.x for r in pages.select(extract(F.col("text")).alias("x")).collect()] == ["a", "a", ""]
    assert pages.where("false").select(extract(F.col("text"))).count() == 0
