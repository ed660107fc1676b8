import random
from html.parser import HTMLParser

import pytest

from corvane.llm import render

CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("a<b", "a"), ("1 < 2 and 3>2", "1 < 2 and 3>2"),
    ("<p>one<p>two<div>three", "one\n\ntwo\n\nthree"),
    ("<title>t</title><h1>Head</h1>text<br>more", "Head\n\ntext\nmore"),
    ("<head><style>.x{display:none}</style><body><p class='y x'>no</p><p class=y>yes</p>", "yes"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes<script>var a='<p>';</script>!", "yes!"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>a<li>b<li value=9>c<li>d</ol>", "3. a\n4. b\n9. c\n10. d"),
    ("<table><tr><th>Name<th>n<tr><td>abcdefg<td>1<tr><td>b<td>22</table>after",
     "Name     n\nabcdefg  1\nb        22\n\nafter"),
    ("<table><tr><td colspan=2>wide cell here<td>x<tr><td>a<td>b<td>c</table>",
     "wide cell here  x\na  b            c"),
    ("<table><tr><td>in<table><tr><td>p<td>q</table><td>z</table>", "in    z\n\np  q"),
    ("<pre>a  b\n  c</pre>x   y", "a  b\n  c\n\nx y"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("x<!-- no -->y<!-- open", "xy"), ("<b>bo<i>ld</b>er</i> end", "bolder end"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<img alt='pic & more' src=x>t", "pic & moret"),
    ("<textarea>a<b>c</textarea>", "a<b>c"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("</p></div>x</table>y", "xy"), ("<script>never closed <p>x", ""), ("<p>a &lt;b&gt; &eacute;&#8364;", "a <b> é€"),
    ("<td>cell<td>more", "cellmore"), ("<li>lone", "- lone"), ("<div/>x<br/>y", "x\ny"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_layout(page, want):
    assert render.render(page) == want


class Words(HTMLParser):
    """Visible words of a well-formed page."""

    def __init__(self):
        super().__init__()
        self.skip, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        if self.skip or tag in ("script", "style", "title") or "hidden" in dict(attrs):
            self.skip += tag not in render.VOID

    def handle_endtag(self, tag):
        self.skip -= bool(self.skip)

    def handle_data(self, data):
        self.words += [] if self.skip else data.split()


def random_page(rng, depth=0):
    n = [0]

    def word():
        n[0] += 1
        return f"w{rng.randrange(10 ** 6)}"

    def inline():
        return " ".join(rng.choice([word(), f"<b>{word()}</b>", f"<a href='x>y'>{word()}</a>"])
                        for _ in range(rng.randint(1, 6)))

    def block(d):
        kind = rng.randrange(8)
        inner = lambda: "".join(block(d + 1) for _ in range(rng.randint(0, 3))) if d < 4 else inline()
        if kind == 0:
            return f"<p>{inline()}</p>"
        if kind == 1:
            return f"<div>{inner()}</div>"
        if kind == 2:
            return f"<ul>{''.join(f'<li>{inline()}</li>' for _ in range(3))}</ul>"
        if kind == 3:
            return f"<div hidden>{inner()}</div>"
        if kind == 4:
            return "<script>if (a<b) { x() }</script><!-- c -->"
        if kind == 5:
            return f"<pre>{inline()}\n{word()}</pre>"
        if kind == 6:
            return f"<table>{''.join(f'<tr><td>{word()}</td><td>{word()}</td></tr>' for _ in range(2))}</table>"
        return f"<h2>{inline()}</h2>"

    return "<html><head><title>no</title></head><body>" + "".join(block(0) for _ in range(6)) + "</body></html>"


def test_all_visible_words_in_order():
    rng = random.Random(8)
    for _ in range(60):
        page = random_page(rng)
        parser = Words()
        parser.feed(page)
        drop = lambda ws: [w for w in ws if w != "-"]
        assert drop(render.render(page).split()) == drop(parser.words)


def test_any_input_is_rendered():
    rng = random.Random(9)
    pieces = ["<", ">", "</", "<p", "<td>", "<tr>", "<table>", "</table>", "<li>", "<ol>", "</ol>", "<!--", "-->", "&",
              "&amp;", "x", " ", "\n", "<pre>", "</pre>", "<script>", "</script>", "'", '"', "=", "<a href=", "<div hidden>"]
    for _ in range(300):
        render.render("".join(rng.choice(pieces) for _ in range(rng.randint(0, 80))))
    assert render.render("<div>" * 20_000 + "deep").strip() == "deep"
    assert render.render("<ul><li>" * 2_000 + "deep").strip().endswith("deep")
    assert len(render.render("<p>x y</p>" * 100_000).split()) == 200_000


def test_extract_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>é", "x"), (1, "u", "<p>é", "x"), (2, None, None, None), (3, "v", "", "y")],
        "page_id long, url string, html string, text string")
    got = sorted(map(tuple, render.extract(pages).collect()), key=repr)
    assert got == [(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0), (3, "v", "", 0)]
    assert render.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("css, want", [
    ("@media print {.x{display:none}}", "seen"), ("@media (max-width: 600px) {p{color:red} .x{display:none}}", "seen"),
    ("@media print {p{color:red}} .x{display:none}", ""), ("@media screen {.x{display:none}}", ""),
    ("@media print, screen {.x{display:none}}", ""), ("@media all { .x {display:none} }", ""),
    ("@import 'a.css'; .x{display:none}", ""), ("/* .y{} */ .x{display:none", ""),
    (".x{display:none} .x{display:block}", "seen"), (".x{display:block} .x{display:none}", ""),
    (".x{display:none!important} .x{display:block}", ""), (".x{display:none;display:block}", "seen"),
    ("@supports (display: grid) {.x{display:none}}", "seen"), (".y{content:'}'} .x{display:none}", ""),
    (".x{display:none; &:hover{color:red}}", ""), (".x{color:red; .y{display:none}}", "seen"),
    ("@media print {@media screen {.x{display:none}}}", "seen"), (".x{visibility:hidden}", ""),
])
def test_rules_that_hold_on_the_screen(css, want):
    assert render.render(f"<style>{css}</style><p class=x>seen</p>") == want


def test_print_sheet_formulas_and_drawings():
    page = ("<style media=print>.x{display:none}</style><p class=x>seen</p>"
            "<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b <svg><title>no</title><defs><text>no</text></defs><text>label</text></svg></p>")
    assert render.render(page) == "seen\n\na x=2 b label"
