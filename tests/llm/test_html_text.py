from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.html_text import extract, page_text


def test_blocks_and_space():
    assert page_text("<p>a  b\n c<p>d<br>e<div>f</div>g") == "a b c\n\nd\ne\n\nf\ng"
    assert page_text("<h1>T</h1>x <b>y</b>z<pre>\n k  l\n  m</pre>") == "T\n\nx yz\n\n k  l\n  m"
    assert page_text("a &amp; b &lt;c&gt; &nbsp;d") == "a & b <c> \xa0d"


def test_hidden_text_is_left_out():
    page = """<title>t</title><script>var a="<p>x</p>";</script><style>p{}</style><p hidden>a<p style="display: none">b</p>
    <div style="visibility:hidden">c<i style="visibility:visible">d</i></div><template>e</template><!-- f -->
    <details><summary>g</summary>h</details><details open><summary>i</summary>j</details><dialog>k</dialog>"""
    assert page_text(page).split() == ["d", "g", "i", "j"]


def test_lists():
    assert page_text("<ul><li>a<li>b<ol start=9><li>x<li>y<li value=3>z</ol><li>c</ul>d") == "* a\n* b\n  9. x\n  10. y\n  3. z\n* c\n\nd"
    assert page_text("<dl><dt>t<dd>d<dt>u</dl>") == "t\n    d\nu"


def test_tables_are_aligned():
    page = "<table><caption>C</caption><tr><th>Name<th>N<tr><td>x<td>100<tr><td colspan=2>wide<tr><td rowspan=2>r<td>1<br>2<tr><td>q</table>"
    assert page_text(page).split("\n") == ["C", "Name  | N", "x     | 100", "wide", "r     | 1", "      | 2", "      | q"]
    assert page_text("<table><tr><td>世界<td>1<tr><td>abcd<td>2</table>") == "世界  | 1\nabcd  | 2"
    assert page_text("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>") == "a       | d\n\nb  | c" or "b  | c" in page_text("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>")


def test_misnesting_and_depth():
    assert page_text("<b><p>x</b>y</p></i></div>z").split() == ["xy", "z"]
    assert page_text("<td>x</td><tr>y") != ""
    assert page_text("<div>" * 20000 + "deep") == "deep"
    assert page_text("<table><tr><td>" * 300 + "deep") == "deep"


def test_bogus_markup_ends_where_browsers_end_it():
    for markup in ("<![endif]-->", "<![endif]>", "<![CDATA[x]>", "<![CDATA[x]]>", "<![foo]>", "<![ x ]>", "<![", "<!x>", "<!>", "<!doctype x [<!x>"):
        markup += "" if markup.endswith(">") else ">"
        assert page_text(f"<p>a</p>{markup}<p>b") == "a\n\nb", markup
    assert page_text("<p>a</p><![endif]--><p>b</p>c ]> d") == "a\n\nb\n\nc ]> d"
    for markup in ("<!-->", "<!--->", "<!-- c --!>", "<!-- c -->", "<!---->", "<!-- > -- x -->", "<?x>", "</>", "</ >", "</1>"):
        assert page_text(f"<p>a</p>{markup}<p>b") == "a\n\nb", markup
    for markup in ("<script>x</script y>", "<style>x</style/>", "<script>x</scripty></SCRIPT\n>"):
        assert page_text(f"<p>a</p>{markup}<p>b") == "a\n\nb", markup
    for rest in ("<!-- b", "<!x b", "<![CDATA[ b", "<?b", "<i b", "</i b", "<script> b</script b", "<!"):
        assert page_text(f"<p>a</p>{rest}") == "a", rest
    assert page_text("a</") == "a</" and page_text("a<") == "a<" and page_text("a<script><!-- </script>b") == "ab"


def test_style_declarations():
    for style in ("backface-visibility: hidden", "-webkit-backface-visibility:hidden", "display:none;display:block", "visibility:hidden; VISIBILITY : Visible",
                  "display:none;display:block!important;display:none", "background:url(x;display:none)", "content:';display:none;'", "/* ; display:none; */color:red", "display:nothing", "x-display:none", "--display:none"):
        assert page_text(f'<p style="{style}">a') == "a", style
    for style in ("display:none", "display : NONE", "display:block;display:none", "display:none;display:nothing", "display:none !important;display:block", "color:red;;display:none;", "backface-visibility:visible;visibility:hidden", "/**/display:/**/none", "visibility:collapse", "visibility:visible;visibility:hidden"):
        assert page_text(f'<p style="{style}">a') == "", style


def test_formulas_drawings_and_maps():
    assert page_text("x <math><mi>y</mi><mo>=</mo><mfrac><mn>1</mn> <mn>2</mn></mfrac></math> z") == "x y=1 2 z"
    assert page_text("<math><semantics><mi>y</mi><annotation>tex</annotation><annotation-xml><mi>w</mi></annotation-xml></semantics><mphantom><mi>q</mi></mphantom></math>") == "y"
    assert page_text("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd>3</mtd><mtd>4</mtd></mtr></mtable></math>k") == "1 2\n3 4\nk"
    page = """<svg><title>t</title><desc>d</desc><metadata>m</metadata><defs><text>s</text></defs><path d="M0"/><desc/><style>p{}</style>
    <text>A<tspan x="1">B</tspan><tspan>C</tspan></text><g><text>D<![CDATA[ > E]]></text></g><text display="none">F</text>
    <foreignObject><p>G<br/>H</p></foreignObject></svg>I"""
    assert page_text(page) == "A\nBC\nD > E\n\nG\nH\n\nI"
    assert page_text("<p>a<svg><g><text>b<p>c") == "a\nb\n\nc" and page_text("<div><svg><text>a</div>b") == "a\nb"
    assert page_text("<svg><title><b>t</b></title></svg><svg/>a<math/>b<![CDATA[c]]>d") == "abd"
    assert page_text("<map name=m><p>a<area href=x>b</p></map>c").split() == ["ab", "c"]
    assert page_text("<p>a<svg><foreignObject><div>b</div></foreignObject></svg>c</p>d").split() == ["a", "b", "c", "d"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <ul> <li> </ul> <table> <tr> <td> </table> <div> </div> <b> </b> <br> <script> </script> x y <!-- --> < > & <pre> </pre> <td colspan=3> <ol start=-2> <dd> <select> <option>".split()), max_size=40))
def test_any_soup_is_read(tags):
    out = page_text(" ".join(tags))
    assert "<li" not in out and not out.endswith("\n")


def test_rows(spark):
    data = [(1, "<p>a<p>b", "u"), (2, None, "u"), (3, "", "u"), (1, "<p>a<p>b", "u"), (None, "x", "u")]
    pages = spark.createDataFrame(data, "page_id long, html string, text string")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    assert got == sorted([(1, "a\n\nb", 4, 3), (1, "a\n\nb", 4, 3), (2, "", 0, 0), (3, "", 0, 0), (None, "x", 1, 1)], key=str)
    assert extract(pages.limit(0)).collect() == []


def test_numbers_of_any_length(spark):
    long = "9" * 5000
    html = [
        f"<table><tr><td colspan={long}>a<td rowspan={long}>b<tr><td>c</table>", f"x&#{long};y", f"x&#x{long}y", "x&#" + "0" * 5000 + "65;y",
        "x&#x" + "0" * 5000 + "41;y", "&#0abc &#00;", f"<p style='display:{long}'>z",
    ]
    got = extract(spark.createDataFrame(list(enumerate(html)), "page_id long, html string")).sort("page_id").collect()
    texts = [r.text for r in got]
    assert texts[1:5] == ["x\ufffdy", "x\ufffdy", "xAy", "xAy"] and texts[6] == "z"
    assert "a" in texts[0] and "c" in texts[0]


def test_large_spans_are_cheap():
    import time
    import tracemalloc

    html = "<table>" + ("<tr>" + "<td colspan=1000 rowspan=1000>x" * 3) * 2 + "</table>"
    tracemalloc.start()
    began = time.process_time()
    page_text(html)
    assert time.process_time() - began < 3 and tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


spans_of = st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 5)), max_size=5), max_size=6)


@settings(max_examples=200, deadline=None)
@given(spans_of)
def test_cells_are_placed_as_on_a_grid(rows):
    """Against a grid with an entry for every covered cell."""
    from tidemark.llm.html_text import Grid

    grid = Grid()
    grid.rows = [[(["x"], cols, n) for cols, n in row] for row in rows]
    taken, want = set(), []
    for r, row in enumerate(rows):
        c = 0
        for cols, n in row:
            while (r, c) in taken:
                c += 1
            n = min(n or len(rows), len(rows) - r)
            taken |= {(r + i, c + j) for i in range(1, n) for j in range(cols)}
            want.append((r, c, cols, n))
            c += cols
    assert [x[:4] for x in grid.place()] == want
