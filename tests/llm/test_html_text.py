"""The rendered text of small pages, written out by hand."""

import pytest

from sondage.llm.html_text import extract, visible_text

CASES = [
    ("", ""),
    ("plain & simple", "plain & simple"),
    ("<p>a <b>b</b>\n c<p>d", "a b c\n\nd"),
    ("<p>a<div>b</div>c", "a\n\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", "- one\n- two\n  - in\n- three"),
    ("<ol start=3><li>c<li>d</ol>", "3. c\n4. d"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>", "Name   N\nalpha  1\nb      22"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td>x<br>y<td>z</table>", "x  z\ny"),
    ("<table><tr><td>漢字<td>1<tr><td>ab<td>2</table>", "漢字  1\nab    2"),
    ("<table><caption>c<tr><td>1<td>2<tr><td colspan=2>wide cell</table>", "c\n1  2\nwide cell"),
    # Cells that reach into rows below push later cells to the right, within their section.
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td>a<td rowspan='2'>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b  c\nd     e\nf  g"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "ab    c\n      d\ne  f  g"),
    ("<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D</table>", "A  B\n   C\n   D"),
    ("<table><thead><tr><th rowspan=3>H<th>I<tbody><tr><td>x<td>y</table>", "H  I\nx  y"),
    ("<table><tbody><tr><td rowspan=3>H<td>I</tbody><tr><td>x<td>y</table>", "H  I\nx  y"),
    ("<table><tr><td data-rowspan=2 data-colspan=3>A<td>B<tr><td>C</table>", "A  B\nC"),
    ("<table><tr><td rowspan=-1 colspan=0>A<td>B<tr><td rowspan=x>C</table>", "A  B\nC"),
    ("<table><tr><td colspan=2>wider than both<td>c<tr><td>1<td>2<td>3</table>", "wider than both  c\n1  2  3"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<script>if (a<b) x()</script>a<style>p{}</style><!-- c -->b<title>t</title>", "ab"),
    ("<div hidden>x</div><p style='color:red; display : none'>y</p><i style='visibility:hidden'>z</i>ok", "ok"),
    ("<div style='display:none'><p>x<div>y</div></div>z", "z"),
    ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
    ("&lt;p&gt; &eacute;&#233;&nbsp;x", "<p> éé\xa0x"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<h1>H</h1><p>p</p><blockquote>q<p>r</blockquote>s", "H\n\np\n\n  q\n\n  r\n\ns"),
    ("</p></div></table>a</b>", "a"),
    ("<a href='x>y'>link</a> <img alt=no><input type=hidden value=v>", "link"),
    ("<textarea>\n<b>raw</b></textarea>", "<b>raw</b>"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("a <", "a <"),
    ("1 < 2 <!-- open", "1 < 2"),
    ("<p>x</p >\r\n<p>y", "x\n\ny"),
    # A head that nothing closes ends at the first thing that may not stand in it.
    ("<html><head><title>T</title><h1>Hi</h1><p>text", "Hi\n\ntext"),
    ("<head>\n<meta charset=x><title>T</title>\n text <b>more</b>", "text more"),
    ("<head><style>x</style><script>y</script><noscript><p>n</p></noscript><template><p>t</p></template><a>link</a>", "link"),
    ("<head><title>T</title></p></br>x", "x"),
    ("<head><title>T</title></head>a<head><title>U</title>b", "ab"),
    ("<p>a<head>b", "ab"),
    # svg and math: slashes close, their text shows, what they define does not.
    ("a <svg width='1'/> b <math/> c", "a b c"),
    ("a<svg><path d='x'/><circle r=1 /></svg>b", "a b"),
    ("<svg><g><text>one</text><text x=1>two<tspan> three</tspan></text></g></svg>four", "one two three four"),
    ("<svg>loose<title>t</title><desc>d</desc><defs><text>s</text></defs><style>x</style><script/><title/><text>yes</text></svg>b", "yes b"),
    ("<svg a=b/><text>in</text></svg>c", "in c"),
    ("<svg><foreignObject><p>x<p>y</foreignObject><text>z</text></svg>", "x\n\ny\n\nz"),
    ("<svg><path><p>out", "out"),
    ("<svg><text display=none>h</text><text style='visibility:hidden'>i</text><text><![CDATA[a<b&amp;]]></text></svg>c<![CDATA[d]]>", "a<b&amp; c"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/><semantics><mi>y</mi><annotation>tex</annotation></semantics></math>.", "x=1y."),
    ("<p>a<svg><text>b</p>c", "a b\n\nc"),
    ("<svg hidden/><svg style='display:none'><text>h</text></svg>k", "k"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert visible_text(page) == text


def test_depth_and_length_do_not_matter():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<b>" * 20_000 + "y" + "</b>" * 20_000) == "y"
    assert visible_text("<ul><li>" * 300 + "z").endswith("- z")
    assert len(visible_text("<p>word " * 50_000).split()) == 50_000


def test_pages_as_a_table(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (None, "b"), (2, None), (3, "")]
    pages = spark.createDataFrame([(*r, "t", "k") for r in rows], "page_id bigint, html string, text string, keep string")
    assert sorted((str(r["page_id"]), r["text"]) for r in extract(pages).collect()) == [("1", "a"), ("1", "a"), ("2", ""), ("3", ""), ("None", "b")]
    assert extract(pages.where("false")).count() == 0
