"""Layout-aware text of web pages.

A page becomes a tree first (implied end tags, void elements, misnested closers),
then text: all that a reader would see, block by block.

* Hidden: head, script, style and other elements without a rendering, comments,
  ``hidden``, ``display:none``, ``visibility:hidden`` (a descendant may become
  visible again), closed dialogs and the body of closed details.
* Paragraphs and headings stand apart by an empty line, other blocks begin a new
  line, ``br`` breaks one, white space collapses outside ``pre`` and ``textarea``.
* List items carry a bullet or their number and are indented below it.
* Table cells are aligned in columns parted by two spaces and a bar; spans are
  kept, cells may hold several lines.
* Formulas (MathML) stand in the line, a fraction's parts and a matrix's cells
  apart, matrix rows on lines; each ``text`` of a drawing (SVG) has its own line.
  Their titles, definitions and annotations are hidden; text that a drawing
  repeats by ``use`` is not looked up.

Both steps walk iteratively, so deep nesting needs no deep stack.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import table

# Fixed values of HTML: elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("head script style template noscript title meta link base iframe object audio video canvas datalist noembed noframes frameset".split())
APART = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr menu fieldset".split())
BLOCKS = APART | set("html body div section article aside header footer nav main address li dt dd form details summary figcaption legend center dir search hgroup optgroup option select textarea caption tr td th thead tbody tfoot dialog".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul summary".split())
# An opening tag ends these, up to the nearest of the elements that stop the search.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}), "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
SCOPE = {"table", "td", "th", "caption", "button", "html", "template"}  # a closer does not reach past these
# Elements of drawings and formulas carry their namespace before the tag: "svg text", "math mi".
FOREIGN_SILENT = {f"svg {t}" for t in "title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter script style".split()}
FOREIGN_SILENT |= {f"math {t}" for t in "annotation annotation-xml script style none mprescripts".split()}
HOLDS_HTML = {"svg foreignobject", "svg desc", "svg title", "math mi", "math mo", "math mn", "math ms", "math mtext"}
SCOPE |= HOLDS_HTML | {"math annotation-xml"}
LEAVES_FOREIGN = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HEAD = set("head title meta link base script style template noscript".split())
SPACE = re.compile(r"[ \t\n\r\f]+")
# Character numbers of more digits than any character has; int() refuses very long ones.
LONG_NUMBER = re.compile(r"&#(?:[xX]0*[0-9a-fA-F]{7,}|0*[0-9]{8,});?")
ZEROS = re.compile(r"(&#)0+(?=[0-9])|(&#[xX])0+(?=[0-9a-fA-F])")
COMMENT_END = re.compile(r"--!?>")
STYLE_TOKEN = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\])*"?|'(?:\\.|[^'\\])*'?|\([^)]*\)?|;|[^;"'(/]+|/""", re.S)
GLOBAL = set("inherit initial unset revert revert-layer".split())
VALUES = {  # a declaration with another value does not count
    "display": GLOBAL | set("none contents block inline inline-block flow flow-root flex inline-flex grid inline-grid table inline-table list-item ruby ruby-base ruby-text table-row table-cell table-column table-caption table-row-group table-header-group table-footer-group table-column-group run-in math -webkit-box -webkit-inline-box -webkit-flex -webkit-inline-flex".split()),
    "visibility": GLOBAL | {"visible", "hidden", "collapse"},
}


class Node:
    __slots__ = ("tag", "attrs", "children", "inside")

    def __init__(self, tag: str, attrs: dict | None = None, inside: str = ""):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        self.inside = inside  # namespace of its children, "" for HTML


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.count = Counter()  # open elements by tag

    def _end(self, tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element of ``tags`` and all inside it."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                self.count.subtract(n.tag for n in self.open[i:])
                del self.open[i:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        if tag in LEAVES_FOREIGN or tag == "font" and attrs.keys() & {"color", "face", "size"}:
            self._leave_foreign()
        space = self.open[-1].inside or (tag if tag in ("svg", "math") else "")
        if self.open[-1].tag in HOLDS_HTML and tag in ("mglyph", "malignmark"):
            space = "math"
        if space:
            if not self.open[-1].inside:
                self._end({"head"}, {"body"})
            name = f"{space} {tag}"
            html = name in HOLDS_HTML or name == "math annotation-xml" and attrs.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
            self._push(Node(name, attrs, "" if html else space))
            return
        if tag in ("html", "body"):
            self._end({"head"}, set())
            if tag == "html" or self.count["body"]:
                return
        elif tag not in HEAD:
            self._end({"head"}, {"body"})
        if tag in CLOSES_P:
            self._end({"p"}, SCOPE)
        if tag in ENDS:
            ends, stop = ENDS[tag]
            if tag == "tr" or tag in ("thead", "tbody", "tfoot"):
                while any(n.tag in ends for n in self._within(stop)):
                    self._end(ends, stop)
            else:
                self._end(ends, stop)
            if tag == "tr" and self.open[-1].tag == "table":
                self._push(Node("tbody"))
            if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
                if self.open[-1].tag == "table":
                    self._push(Node("tbody"))
                self._push(Node("tr"))
        node = Node(tag, attrs)
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _within(self, stop: set[str]) -> list[Node]:
        out = []
        for node in reversed(self.open):
            if node.tag in stop:
                break
            out.append(node)
        return out

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[node.tag] += 1

    def _leave_foreign(self) -> None:
        while self.open[-1].inside:
            self.count[self.open.pop().tag] -= 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        last = self.open[-1]
        if " " in last.tag and last.tag.split(" ")[1] == tag and not last.children:  # only drawings and formulas have empty-element tags
            self.count[self.open.pop().tag] -= 1

    def handle_endtag(self, tag):
        if tag in ("br", "p"):
            self._leave_foreign()
        for i in range(len(self.open) - 1, 0, -1):
            space, _, name = self.open[i].tag.partition(" ")
            if not name:
                break
            if name == tag:
                self.count.subtract(n.tag for n in self.open[i:])
                del self.open[i:]
                return
        if tag in ("svg", "math"):  # from HTML inside it
            self._end({f"{tag} {tag}"}, BLOCKS | SCOPE)
        elif tag == "br":
            self.open[-1].children.append(Node("br"))
        elif tag in ("html", "body") or tag in VOID:
            return
        elif tag == "table":
            self._end({"table"}, set())
        elif tag in BLOCKS:
            self._end({tag}, SCOPE - {tag})
        else:  # inline elements do not close the blocks opened in them
            self._end({tag}, BLOCKS)

    def parse_comment(self, i, report=1):
        """``<!-->`` and ``<!--->`` are whole; else up to ``-->`` or ``--!>``, or all the rest."""
        for whole in ("<!-->", "<!--->"):
            if self.rawdata.startswith(whole, i):
                return i + len(whole)
        end = COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i):
        """Doctypes, ``<![...`` and other declarations end at the first ``>``; only
        drawings and formulas have CDATA sections, which are text up to ``]]>``."""
        if " " in self.open[-1].tag and self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            self.handle_data(self.rawdata[i + 9:end if end >= 0 else None])
            return end + 3 if end >= 0 else len(self.rawdata)
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def set_cdata_mode(self, elem):
        self.cdata_elem = elem
        self.interesting = re.compile(rf"</{elem}(?=[ \t\n\r\f/>])", re.I)

    def parse_endtag(self, i):
        if not self.cdata_elem:
            return super().parse_endtag(i)
        elem, end = self.cdata_elem, self.rawdata.find(">", i)  # script and style also end at a closer with attributes
        self.clear_cdata_mode()
        self.handle_endtag(elem)
        return end + 1 or len(self.rawdata)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._end({"head"}, set())
        self.open[-1].children.append(data)


def width(text: str) -> int:
    """Columns of a text: wide characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines being written: collapses space, separates blocks, indents lists."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.gap = False
        self.indent = ""
        self.marker = ""

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.line(hard=True)
                self._put(line)
            return
        for i, word in enumerate(SPACE.split(data)):
            if i and self.parts:
                self.space = True
            if word:
                self._put((" " if self.space else "") + word)
                self.space = False

    def _put(self, piece: str) -> None:
        if piece:
            self.parts.append(piece)

    def line(self, hard: bool = False) -> None:
        """End the line; an empty one only counts if ``hard``."""
        if self.parts or hard:
            self._write("".join(self.parts).rstrip())
        self.parts, self.space = [], False

    def _write(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        lead = self.indent
        if self.marker:
            lead = lead[:len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + text).rstrip())

    def block(self, apart: bool) -> None:
        self.line()
        self.gap = self.gap or apart

    def whole(self, lines: list[str]) -> None:
        for text in lines:
            self._write(text)

    def done(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Grid:
    """A table's cells: rows of (lines, column span, row span)."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.captions: list[str] = []

    def place(self) -> list[tuple[int, int, int, int, list[str]]]:
        """(row, column, columns, rows, lines) of each cell: it begins at the first column
        that no cell from above covers.  Spans end with the table; only the cells open
        over the present row are kept in mind, one entry each."""
        placed, above = [], []  # above: (first column, column after it, row after it)
        for r, row in enumerate(self.rows):
            above = sorted(x for x in above if x[2] > r)
            c, nth, new = 0, 0, []
            for lines, cols, rows in row:
                while nth < len(above) and above[nth][0] <= c:
                    c = max(c, above[nth][1])
                    nth += 1
                end = len(self.rows) if rows == 0 else min(r + rows, len(self.rows))
                if end > r + 1:
                    new.append((c, c + cols, end))
                placed.append((r, c, cols, end - r, lines))
                c += cols
            above += new
        return placed

    def render(self) -> list[str]:
        placed, widths = [(r, c, cols, lines) for r, c, cols, _, lines in self.place()], {}
        for _, c, cols, lines in placed:
            if cols == 1:
                widths[c] = max([widths.get(c, 0), *map(width, lines)])
        for _, c, cols, lines in placed:  # what a span needs beyond its columns goes to the last
            if cols > 1:
                room = sum(widths.get(c + j, 0) for j in range(cols)) + 4 * (cols - 1)
                more = max([0, *map(width, lines)]) - room
                if more > 0:
                    widths[c + cols - 1] = widths.get(c + cols - 1, 0) + more
        n = max(widths, default=-1) + 1
        start = [0, *accumulate(widths.get(j, 0) + 4 for j in range(n))]
        out = list(self.captions)
        by_row: dict[int, list] = {}
        for r, c, cols, lines in placed:
            by_row.setdefault(r, []).append((c, lines))
        for r in sorted(by_row):
            cells = sorted(by_row[r], key=lambda x: x[0])
            for k in range(max((len(lines) for _, lines in cells), default=0)):
                text, at = "", 0
                for c, lines in cells:
                    if c:
                        text += " " * (start[min(c, n)] - 4 - at) + "  | "
                        at = max(at, start[min(c, n)] - 4) + 4
                    piece = lines[k] if k < len(lines) else ""
                    text += piece
                    at += width(piece)
                text = text.rstrip(" |") if not text.strip(" |") else text.rstrip()
                out.append(text)
        return out


def span(node: Node, name: str) -> int:
    """A cell's span: at most 1000 columns or 65534 rows, as HTML has it; 0 rows reach to
    the end of the table."""
    value, most = node.attrs.get(name, "").strip(" \t\n\f\r"), 1000 if name == "colspan" else 65534
    if not (value.isascii() and value.isdigit()):
        return 1
    n = min(int(value.lstrip("0")[:6] or 0), most)
    return n if n or name == "rowspan" else 1


def inline_style(style: str) -> dict[str, str]:
    """``display`` and ``visibility`` as a style attribute sets them: the last valid
    declaration of the very property counts, an important one before others."""
    style = style.lower()
    if "display" not in style and "visibility" not in style:
        return {}
    out: dict[str, tuple[bool, str]] = {}
    declaration = ""
    for token in [*STYLE_TOKEN.findall(style), ";"]:
        if token != ";":
            declaration += " " if token.startswith("/*") else token
            continue
        prop, _, value = declaration.partition(":")
        prop, declaration = prop.strip(), ""
        if prop in VALUES:
            value, mark, rest = value.partition("!")
            words = value.split()
            important = bool(mark) and rest.strip() == "important"
            if not words or mark and not important or not VALUES[prop].issuperset(words) or len(words) > 1 and (prop == "visibility" or GLOBAL & set(words) or "none" in words):
                continue
            if important or not out.get(prop, (False,))[0]:
                out[prop] = important, " ".join(words)
    return {k: v for k, (_, v) in out.items()}


def visibility(node: Node, shown: bool) -> tuple[bool, bool]:
    """(rendered at all, text shown) of an element inside text that is ``shown``."""
    a = node.attrs
    if node.tag in SILENT or node.tag in FOREIGN_SILENT:
        return False, False
    if " " not in node.tag and (("hidden" in a and a["hidden"].lower() != "until-found") or (node.tag == "input" and a.get("type", "").lower() == "hidden") or (node.tag == "dialog" and "open" not in a)):
        return False, False
    if node.tag == "math mphantom":
        shown = False
    style = inline_style(a["style"]) if "style" in a else {}
    if node.tag.startswith("svg "):  # there both are attributes too
        style = inline_style(";".join(f"{k}:{a[k]}" for k in ("display", "visibility") if k in a)) | style
    if style.get("display") == "none":
        return False, False
    if style.get("visibility", "inherit") in ("visible", "initial", "hidden", "collapse"):
        shown = style["visibility"] in ("visible", "initial")
    return True, shown


def foreign(node: Node, shown: bool, flow: Flow) -> list:
    """What to render of an element of a drawing or formula, in order."""
    tag, children, leave = node.tag, node.children, []
    if tag in ("svg text", "svg foreignobject") or tag == "svg tspan" and node.attrs.keys() & {"x", "y"} or tag == "math math" and node.attrs.get("display", "").lower() == "block":
        flow.block(False)
        if tag != "svg tspan":
            leave.append(lambda: flow.block(False))
    elif tag in ("math mtable", "math mtr", "math mlabeledtr"):
        flow.block(False)
        leave.append(lambda: flow.block(False))
    elif tag in ("math semantics", "math maction"):  # alternatives: the first is seen
        children = [c for c in children if isinstance(c, Node)][:1]
    elif tag.startswith("svg ") and tag.split(" ")[1] not in ("tspan", "textpath", "a"):  # text outside of a text element is not drawn
        children = [c for c in children if isinstance(c, Node)]
    items = [(c, shown, False) for c in children]
    if tag in ("math mfrac", "math mtr", "math mlabeledtr"):
        items = [x for c in items if not isinstance(c[0], str) for x in ((" ", shown, False), c)][1:]
    return items + leave


def render(root: Node) -> list[str]:
    """Lines of the visible text below ``root``."""
    flows, grids, lists = [Flow()], [], []
    todo: list = [(root, True, False)]  # (node or text, shown, keep space), or a callable to leave an element
    while todo:
        item = todo.pop()
        if callable(item):
            item()
            continue
        node, shown, keep = item
        flow = flows[-1]
        if isinstance(node, str):
            if shown:
                flow.text(node, keep)
            continue
        rendered, shown = visibility(node, shown)
        if not rendered:
            continue
        tag, children = node.tag, node.children
        if " " in tag:
            todo += reversed(foreign(node, shown, flow))
            continue
        if tag == "br":
            flow.line(hard=True)
            continue
        if tag == "wbr":
            continue
        if tag in BLOCKS or tag == "table":
            flow.block(tag in APART and not (tag in ("ul", "ol") and lists))
        if tag in ("pre", "textarea"):
            keep = True
            if children and isinstance(children[0], str) and children[0].startswith("\n"):
                children = [children[0][1:], *children[1:]]
        if tag == "input" and node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "") and node.attrs.get("value") and shown:
            flow.text(node.attrs["value"], False)
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        leave = []
        if tag in ("ul", "ol", "menu", "dir"):
            start = node.attrs.get("start", "")
            lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            leave.append(lists.pop)
        elif tag == "li":
            marker = "* "
            if lists and lists[-1][0]:
                value = node.attrs.get("value", "")
                if re.fullmatch(r"-?\d{1,9}", value):
                    lists[-1][1] = int(value)
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            old = flow.indent
            flow.indent, flow.marker = old + " " * len(marker), marker

            def end_item(flow=flow, old=old):
                flow.block(False)
                flow.indent, flow.marker = old, ""
            leave.append(end_item)
        elif tag in ("dd", "blockquote"):
            old = flow.indent
            flow.indent = old + "    "

            def end_indent(flow=flow, old=old):
                flow.line()
                flow.indent = old
            leave.append(end_indent)
        elif tag == "table":
            grids.append(Grid())
            outer, lists = lists, []

            def end_table(flow=flow, outer=outer):
                nonlocal lists
                lists = outer
                lines = grids.pop().render()
                if lines:
                    flow.gap = True
                flow.whole(lines)
            leave.append(end_table)
        elif tag == "tr" and grids:
            grids[-1].rows.append([])
        elif tag in ("td", "th", "caption") and grids:
            flows.append(Flow())
            if tag != "caption" and not grids[-1].rows:
                grids[-1].rows.append([])

            def end_cell(tag=tag, node=node, grid=grids[-1]):
                lines = flows.pop().done()
                if tag == "caption":
                    grid.captions += lines
                else:
                    grid.rows[-1].append((lines, span(node, "colspan"), span(node, "rowspan")))
            leave.append(end_cell)
        if tag in BLOCKS and tag not in ("td", "th", "caption", "table", "li"):
            leave.append(lambda flow=flow, apart=tag in APART and not (tag in ("ul", "ol") and lists[:-1]): flow.block(apart))
        elif tag == "table":
            leave.append(lambda flow=flow: flow.block(True))
        todo += reversed(leave)
        todo += [(c, shown, keep) for c in reversed(children)]
    return flows[0].done()


def page_text(html: str | None) -> str:
    """Visible text of one page; '' for a null or empty page."""
    if not html:
        return ""
    if "&#" in html:
        html = LONG_NUMBER.sub("\ufffd", ZEROS.sub(lambda m: m[1] or m[2], html))
    builder = TreeBuilder()
    builder.feed(html)
    if re.match("<([?a-zA-Z]|/.)", builder.rawdata, re.S):  # a tag that never ends; the page is fed whole
        builder.rawdata = ""
    builder.close()
    return "\n".join(render(builder.root))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_chars, n_lines) per row of ``pages`` (page_id, html).

    Null and empty pages give empty texts of no lines; rows repeated stay; whatever is
    not well-formed is read as far as a browser would, never refused."""

    def run(batches):
        for b in batches:
            texts = [page_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                ["page_id", "text", "n_chars", "n_lines"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, text string, n_chars long, n_lines long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
