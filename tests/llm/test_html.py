import html
import os
import re

import numpy as np
import pytest

from clickbasin.llm import entries, html_extract

SF_DIR = "/root/testdata/sf0.001"


def plain(page):
    """The article element of the given pages, read with patterns that fit these pages only."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    cut = re.split(r"</?(?:p|h1)>", article)
    found = [" ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", x.replace("<br>", " "))).split()) for x in cut]
    return "\n\n".join(x for x in found if x)


@pytest.fixture(scope="module")
def extractor():
    return html_extract.fit([])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = entries.op4_html(spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == plain(pages[row.page_id].html)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_made_pages_held_out(extractor):
    maker = html_extract._Maker([], seed=99)
    kept = lost = extra = 0
    for _ in range(150):
        nodes, wanted = maker.labelled()
        x, length = html_extract.features(nodes, extractor.odds)
        chosen = extractor.keep(nodes, extractor.trees.probabilities(x), length)
        for node, want, got in zip(nodes, wanted, chosen):
            size = sum(len(t.strip()) for t in node.parts if isinstance(t, str))
            kept, lost, extra = kept + size * (want and got), lost + size * (want and not got), extra + size * (got and not want)
    assert kept / (kept + lost) > 0.98 and kept / (kept + extra) > 0.98


def test_nothing_below_a_dropped_element_is_kept(extractor):
    rng = np.random.default_rng(1)
    for _ in range(50):
        nodes, _ = html_extract._Maker([], seed=int(rng.integers(1000))).labelled()
        x, length = html_extract.features(nodes, extractor.odds)
        drop = extractor.keep(nodes, rng.random(len(nodes)), length)
        for i, node in enumerate(nodes):
            below_never = any(nodes[j].tag in html_extract.NEVER for j in ancestors(nodes, i))
            assert not (drop[i] and below_never)


def ancestors(nodes, i):
    while nodes[i].parent >= 0:
        i = nodes[i].parent
        yield i


LONG = "Some words of an article that go on for a while, with commas, and an end. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<<<>>&&&<a <b></c></d></p>", None),
        ("<nav><a href=/>one</a></nav><footer>&copy; x</footer>", ""),
        (f"<article><p>a &amp;&nbsp;\n b&#233; {LONG}<script>no()</script></article>", f"a & bé {LONG.strip()}"),
        (f"<article><h1>Top</h1><p>{LONG}<p>{LONG}<!-- x --></article>", f"Top\n\n{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<article><p>{LONG}</p><div class='ad'>Buy now</div><p>{LONG}</p></article>", f"{LONG.strip()}\n\n{LONG.strip()}"),
    ],
)
def test_pages(extractor, page, text):
    (got,) = extractor.texts([page])
    assert text is None or got == text


def test_odd_rows(spark, extractor):
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, f"<article>{'<p>' + LONG} </article>" * 400, None), (None, deep, "x")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = frame.withColumn("text", html_extract.main_text(extractor, frame.html)).collect()
    assert [r.text for r in got[:3]] == ["", "", ""]
    assert got[3].text.count("Some words") == 1600
    assert html_extract.train(frame).texts(["<p>x"]) is not None
    assert frame.where("false").withColumn("text", html_extract.main_text(extractor, frame.html)).count() == 0


END = f"<nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>Top</h1><p>{LONG}<p>{LONG}</article><footer>&copy; x</footer>"


@pytest.mark.parametrize("start", ["<head><title>x</title><meta charset=utf-8><body>", "<head><title>x</title><link href=a>"])
def test_head_without_end(extractor, start):
    want = f"Top\n\n{LONG.strip()}\n\n{LONG.strip()}"
    assert extractor.texts([start + END]) == [want]
    assert [node.tag for node in html_extract.parse("<head> <title>x</title>\nwords")] == ["#root", "head"]
    assert html_extract.parse("<head> <title>x</title>\nwords")[0].parts[-1] == "\nwords"


def test_page_or_article_in_a_form(extractor):
    want = f"Top\n\n{LONG.strip()}\n\n{LONG.strip()}"
    inputs = "<input type=hidden><label>Find</label><select><option>a</select><button>Go</button>"
    comments = "<footer>" + "<p>I think this is all good, and more.</p>" * 60 + "</footer>"
    pages = [
        f"<head></head><body><form method=post>{inputs}{END}</form></body>",
        f"<head></head><body><form>{END}{inputs}</form>{comments}</body>",
        f"<head></head><body>{END.replace('<p>', '<form>Find <input></form><p>', 1)}<form><p>Get our letter.</p>{inputs}</form></body>",
    ]
    assert extractor.texts(pages) == [want] * 3


@pytest.mark.parametrize("tag", sorted(html_extract.RAW))
def test_raw_elements_end_where_they_end(extractor, tag):
    page = f"<article><p>{LONG}{'İ' * 50}<{tag}>a < b İ</{tag.upper()}> after</p><p>{LONG}</p></article>"
    assert extractor.texts([page]) == [f"{LONG}{'İ' * 50} after\n\n{LONG.strip()}"]


LEAD_P = "<p>The first long paragraph of the article says something, with a comma and a full stop.</p>"
TAIL_P = "<p>The rest of the article goes on in another long paragraph, and it ends here at last.</p>"
LEAD = "The first long paragraph of the article says something, with a comma and a full stop."
TAIL = "The rest of the article goes on in another long paragraph, and it ends here at last."


@pytest.mark.parametrize(
    "between",
    [
        "<!-->", "<!--->", "<!---->", "<!-- a -- b --!>", "<!-- a > b -->", "<svg><g><svg><text>x</text></svg></g><text>y</text></svg>",
        "<template><template><p>x</p></template><p>y</p></template>", "<svg><path d='</svg>'/></svg>", "<svg/>", "<SVG a='>'><svg /></Svg >",
        "<script>if (a < b) '</scripty>'</script>",
    ],
)
def test_nothing_behind_comments_and_raw_elements_is_lost(extractor, between):
    page = f"<html><body><article><h1>A title of some length</h1>{LEAD_P}{between}{TAIL_P}</article></body></html>"
    assert extractor.texts([page])[0].split("\n\n")[1:] == [LEAD, TAIL]


def test_formulas_are_text(extractor):
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>x=1</annotation></math>"
    page = f"<html><body><article><h1>A title of some length</h1>{LEAD_P}<p>Here {formula} is the sum of all terms, as they stand.</p></article></body></html>"
    assert extractor.texts([page])[0].endswith("Here x=1 is the sum of all terms, as they stand.")


def test_list_items_end_however_much_is_open_inside():
    inline = "".join(f"<b{n}>" for n in range(40))
    nodes = html_extract.parse(f"<ul><li>{inline}one<li>two<ul><li>three</ul></ul>")
    items = [i for i, node in enumerate(nodes) if node.tag == "li"]
    assert [nodes[nodes[i].parent].tag for i in items] == ["ul", "ul", "ul"]
    assert nodes[items[0]].parent == nodes[items[1]].parent != nodes[items[2]].parent
    # Deep pages take time in proportion to their length.
    assert len(html_extract.parse("<li><ul>" + "<b>" * 20_000 + "<td>x" * 20_000)) > 40_000


def test_the_sample_is_bounded_by_characters(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "SAMPLE_CHARS", 1000)
    seen = []
    monkeypatch.setattr(html_extract, "fit", lambda pages: seen.extend(pages))
    rows = [(n, "x" * (400 if n % 2 else 5000)) for n in range(20)] + [(3, "y" * 300), (21, None)]
    html_extract.train(spark.createDataFrame(rows, "page_id long, html string"))
    assert len(seen) == 2 and all(len(page) == 400 for page in seen)
