"""HTML to text as it is laid out: all visible text, with block spacing, lists and aligned table cells.

A tokenizer feeds a tree builder that supplies the end tags which HTML implies (p, li, dt, dd, option, table parts) and
closes what is left open. The tree is kept as its walk (open, text, close), so depth costs no recursion. The renderer
follows it with visibility rules: elements that are never shown, the hidden attribute, inline display:none and
visibility (inherited; a visible child of a hidden element shows), closed details, and the page's own style rules for the
screen, if their selectors are made of tags, ids, classes, descendants and children; others are left out, as are media with
conditions. Paragraph-like blocks are set off by a blank line, other blocks by a new line; list items get bullets or numbers
by depth, as value, start, reversed and type say; cells are padded to columns by the width that characters take on a screen,
also where others span columns or rows above them, which end with their row group. Runs of more than RUN spanned cells are left
out of a line. Attributes that should be numbers and aren't, or have more than nine digits, count as not given.

Null and empty pages give an empty text. Whole pages are rendered, however long. Repeated rows give repeated results;
columns besides the HTML are kept by extract(), except one named like the result, which it replaces.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import pieces, schema_with, table

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_SIGHT = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_WHOLE = re.compile(r"\s*([+-]?)0*(\d{1,9})(?!\d)")
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
_GAPS = re.compile(r"[ \t\n\f\r]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
NEVER = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist meta link param source track area base defs symbol desc metadata clippath mask marker pattern lineargradient radialgradient filter annotation annotation-xml".split())
#: Cells in a row that others span, as many as a line shows.
RUN = 16
#: Blocks with a blank line around them, and without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr menu dir".split())
BLOCK = SPACED | frozenset("address article aside body center dd details dialog div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary svg text tr caption thead tbody tfoot".split())
#: A start tag ends the open element of these names, up to one of the second names.
_LIST, _TABLE = frozenset(("ul", "ol", "menu", "dir")), frozenset(("table",))
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul xmp".split())
_P_WALL = frozenset("button table td th caption object html template".split())
IMPLIED = {
    "li": (frozenset(("li",)), _LIST),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "optgroup", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th")), _TABLE),
    "th": (frozenset(("td", "th")), _TABLE),
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), _TABLE),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset(("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup")), _TABLE)),
    "body": (frozenset(("head",)), frozenset()),
}


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text.strip(" \t\n\f\r/"):
        for m in _ATTR.finditer(text):
            value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
            out.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
    return out


def tree(page: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """The walk of the tree: ("open", tag, attributes), ("text", text, None), ("close", tag, None), all nested well."""
    stack: list[str] = []
    open_count: dict[str, int] = {}

    def pop() -> tuple[str, str, None]:
        tag = stack.pop()
        open_count[tag] -= 1
        return "close", tag, None

    def within(names: frozenset, wall: frozenset) -> int:
        """The depth of the outermost element of these names inside the nearest wall; -1: none."""
        if not any(open_count.get(n) for n in names):
            return -1
        found = -1
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] in wall:
                break
            if stack[k] in names:
                found = k
        return found

    at = 0
    for m in iter(lambda: _TOKEN.search(page, at), None):
        if m.start() > at:
            yield "text", html.unescape(page[at : m.start()]), None
        at = max(m.end(), m.start() + 1)
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("p", "br") and not open_count.get(tag):
                yield "open", tag, {}
                yield "close", tag, None
            elif open_count.get(tag):
                wall = _TABLE if tag not in ("table", "html", "body") and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else frozenset()
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k] == tag or stack[k] in wall), -1)
                if k >= 0 and stack[k] == tag:
                    while len(stack) > k:
                        yield pop()
            continue
        for names, wall in ([(frozenset(("p",)), _P_WALL)] if tag in _CLOSES_P else []) + ([IMPLIED[tag]] if tag in IMPLIED else []):
            k = within(names, wall)
            while k >= 0 and len(stack) > k:
                yield pop()
        yield "open", tag, attributes(m[3])
        if tag in VOID:
            yield "close", tag, None
            continue
        stack.append(tag)
        open_count[tag] = open_count.get(tag, 0) + 1
        if tag in RAW:
            end = RAW[tag].search(page, at)
            body = page[at : end.start() if end else len(page)]
            at = end.start() if end else len(page)
            yield "text", html.unescape(body) if tag in ("textarea", "title") else body, None
    if at < len(page):
        yield "text", html.unescape(page[at:]), None
    while stack:
        yield pop()


def whole_number(value: str, otherwise: int) -> int:
    """The number that an attribute begins with; numbers beyond nine digits, and no numbers, count as `otherwise`."""
    m = _WHOLE.match(value)
    return int(m[1] + m[2]) if m else otherwise


def _style(css: str) -> str:
    """What declarations do to an element: 'none' takes it out, 'hidden' and 'visible' set its sight, '' nothing."""
    if _NONE.search(css):
        return "none"
    sight = _SIGHT.findall(css)
    return "" if not sight else "visible" if sight[-1].lower() == "visible" else "hidden"


def _blocks(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on a screen without further conditions."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)
    at, start, opened = 0, 0, []  # opened: whether the rules inside each open block count
    for m in re.finditer(r"[{};]", css):
        if m[0] == ";":
            if not opened or opened[-1] is not None:
                start = m.end()  # a statement such as @import
        elif m[0] == "{":
            head = css[start : m.start()].strip()
            if head.startswith("@"):
                opened.append(for_screen(head[6:]) if head[:6].lower() == "@media" and (not opened or opened[-1]) else False)
            else:
                opened.append(None)  # declarations
                selectors = head
            start = m.end()
        elif opened:
            if opened.pop() is None and all(x is True for x in opened):
                yield selectors, css[start : m.start()]
            start = m.end()
        else:
            start = m.end()


def for_screen(media: str) -> bool:
    """Whether a list of media names the screen without conditions; an empty one does."""
    return not media.strip() or any(m.strip().lower() in ("all", "screen", "only screen", "only all") for m in media.split(","))


class Rules:
    """Rules that hide or show, by the id, class or tag that the last part of their selector asks for."""

    def __init__(self) -> None:
        self.by: dict[tuple[str, str], list[tuple[tuple, list, str]]] = {}
        self.count = 0

    def __bool__(self) -> bool:
        return bool(self.by)

    def add(self, css: str) -> None:
        for selectors, declarations in _blocks(css) if _style(css) else ():
            if does := _style(declarations):
                for selector in selectors.split(","):
                    if parts := self._parsed(selector):
                        _, tag, ids, classes = parts[-1]
                        weight = (sum(len(p[2]) for p in parts), sum(len(p[3]) for p in parts), sum(bool(p[1]) for p in parts), self.count)
                        key = ("#", ids[0]) if ids else (".", classes[0]) if classes else ("", tag)
                        self.by.setdefault(key, []).append((weight, parts, does))
                        self.count += 1

    @staticmethod
    def _parsed(selector: str) -> list[tuple[str, str, list[str], list[str]]]:
        """(how it stands to the part before, tag, ids, classes) for each part; none if a part isn't understood."""
        out, how = [], ""
        for word in selector.replace(">", " > ").split():
            if word == ">":
                if how == ">" or not out:
                    return []
                how = ">"
                continue
            m = _COMPOUND.match(word)
            if not m:
                return []
            names = re.findall(r"([.#])([\w-]+)", m[2])
            out.append((how or " ", (m[1] or "").lower().replace("*", ""), [n for k, n in names if k == "#"], [n for k, n in names if k == "."]))
            how = ""
        return out if how != ">" and out and any(any(p[1:]) for p in out[-1:]) else []

    def effect(self, element: tuple[str, str, frozenset], above: list[tuple[str, str, frozenset]]) -> str:
        tag, own, classes = element
        best = None
        for key in (("#", own), *((".", c) for c in classes), ("", tag)):
            for weight, parts, does in self.by.get(key, ()):
                if (best is None or weight > best[0]) and self._fits(parts[-1], element) and self._under(parts, len(parts) - 1, above, len(above)):
                    best = weight, does
        return best[1] if best else ""

    @staticmethod
    def _fits(part: tuple, element: tuple[str, str, frozenset]) -> bool:
        return (not part[1] or part[1] == element[0]) and all(i == element[1] for i in part[2]) and all(c in element[2] for c in part[3])

    def _under(self, parts: list, k: int, above: list, depth: int) -> bool:
        """Whether the parts before k fit the elements above. Nearest first, which for descendants is enough."""
        while k:
            child = parts[k][0] == ">"
            while depth:
                depth -= 1
                if self._fits(parts[k - 1], above[depth]):
                    if parts[k - 1][0] == ">" and k > 1 and not child:
                        if self._under(parts, k - 1, above, depth):
                            return True
                        continue
                    break
                if child:
                    return False
            else:
                return False
            k -= 1
        return True


class Flow:
    """Lines of a block; `gap` is the number of line ends due before the next line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def put(self, text: str) -> None:
        """Text whose white space collapses."""
        if text[0] in " \t\n\f\r":
            self.space = bool(self.inline)
        words = _GAPS.sub(" ", text).strip(" ")
        if words:
            if self.space:
                self.inline.append(" ")
            self.inline.append(words)
            self.space = text[-1] in " \t\n\f\r"

    def end_line(self, empty: bool = False) -> None:
        line = "".join(self.inline)
        self.inline, self.space = [], False
        if line or empty:
            self._add(line)

    def _add(self, line: str) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        self.lines.append((self.marker or self.indent) + line if line or self.marker else "")
        if self.marker:
            self.marker = ""

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def verbatim(self, text: str) -> None:
        first, *more = text.split("\n")
        self.inline.append(first)
        for line in more:
            self.end_line(empty=True)
            self.inline.append(line)

    def paste(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._add(line)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def columns(text: str) -> int:
    """Columns that a text takes on a screen."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) or unicodedata.category(c) in ("Mn", "Me", "Cf") else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _placed(rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[tuple[list[tuple[int, list[str], int]], int]]:
    """Rows of (row group, cells of (lines, columns, rows) spanned) as rows of (column, lines, columns) and the rows' ends, spanned
    cells included. Spans end with their row group; columns that are taken up to there are skipped at once."""
    out = []
    last: dict[int, int] = {}
    for k, (group, _) in enumerate(rows):
        last[group] = k
    now, skip, until, end = None, {}, {}, 0

    def free(c: int) -> int:
        path = []
        while c in skip:
            path.append(c)
            c = skip[c]
        for p in path:
            skip[p] = c
        return c

    for k, (group, row) in enumerate(rows):
        if group != now:
            now, skip, until, end = group, {}, {}, 0
        cells, at = [], 0
        for lines, span, down in row:
            at = free(at)
            while until.get(at, -1) >= k:
                at = free(at + 1)
            cells.append((at, lines, span))
            if down > 1:
                bottom = min(k + down - 1, last[group])
                if bottom > k:
                    end = max(end, at + span)
                    if bottom == last[group]:
                        skip |= {c: c + 1 for c in range(at, at + span)}
                    else:
                        until |= dict.fromkeys(range(at, at + span), bottom)
            at += span
        if until and end > at:
            while end > at and until.get(end - 1, -1) < k and end - 1 not in skip:
                end -= 1
        out.append((cells, max(at, end)))
    return out


def _grid(rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[str]:
    """Rows of cells as lines with the columns aligned."""
    placed = _placed(rows)
    widths = [0] * max((end for _, end in placed), default=0)
    for cells, _ in placed:
        for at, lines, span in cells:
            if span == 1:
                widths[at] = max(widths[at], *map(columns, lines), 0)

    def gap(lo: int, hi: int) -> list[str]:
        return [" " * w for w in widths[lo:hi]] if hi - lo <= RUN else []

    out = []
    for cells, end in placed:
        for n in range(max((len(lines) for _, lines, _ in cells), default=0)):
            parts, k = [], 0
            for at, lines, span in cells:
                parts += gap(k, at)
                text = lines[n] if n < len(lines) else ""
                parts.append(text + " " * (sum(widths[at : at + span]) + 3 * (span - 1) - columns(text)))
                k = at + span
            out.append(" | ".join([*parts, *gap(k, end)]).rstrip())
    return out


def _ordinal(n: int, kind: str) -> str:
    """The mark of a list item: a number, letters or a Roman number; numbers where the kind has no such mark."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(97 + k) + out
        return out if kind == "a" else out.upper()
    if kind in ("i", "I") and 0 < n < 4_000:
        out = ""
        for size, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out += sign * (n // size)
            n %= size
        return out if kind == "i" else out.upper()
    return str(n)


def _items(walk: list[tuple[str, str, dict[str, str] | None]]) -> dict[int, int]:
    """For each ordered list, by its place in the walk, how many items are its own."""
    out, stack = {}, []
    for k, (kind, tag, _) in enumerate(walk):
        if kind == "open" and tag in _LIST:
            stack.append(k)
            out[k] = 0
        elif kind == "open" and tag == "li" and stack:
            out[stack[-1]] += 1
        elif kind == "close" and tag in _LIST and stack:
            stack.pop()
    return out


def render(page: str | None) -> str:
    """The visible text of a page."""
    flows, tables, lists = [Flow()], [], []
    hidden = 0  # depth below an element that is taken out
    shown: list[bool] = []
    sight = [True]  # of the open elements: visibility is inherited, and a visible child of a hidden element shows
    pre = 0
    rules = Rules()
    above: list[tuple[str, str, frozenset]] = []  # the open elements that aren't taken out
    folded: list[int] = []  # of these, closed details: summaries so far and one; 0: none
    groups = [0]  # for each open table, how many row groups have begun and ended
    in_style = pre_starts = False
    walk = tree(page or "")
    own_items: dict[int, int] = {}
    if page and "reversed" in page.lower():
        walk = [*walk]
        own_items = _items(walk)
    for step, (kind, value, attrs) in enumerate(walk):
        flow = flows[-1]
        if kind == "text":
            if in_style:
                rules.add(value)
            elif not hidden and value and sight[-1] and not (folded and folded[-1]):
                if pre:
                    value = value.replace("\r\n", "\n")
                    flow.verbatim(value.removeprefix("\n") if pre_starts else value)
                else:
                    flow.put(value)
            pre_starts = False
            continue
        tag = value
        if kind == "open":
            in_style = tag == "style" and for_screen(attrs.get("media", ""))
            element = (tag, attrs.get("id", ""), frozenset(attrs["class"].split()) if "class" in attrs else frozenset())
            does = "none" if tag in NEVER else _effect(element, attrs, rules, above) if attrs or rules else ""
            if not hidden and folded and folded[-1]:
                if tag != "summary" or folded[-1] > 1:
                    does = "none"
                else:
                    folded[-1] += 1
            if hidden or does == "none":
                if tag not in VOID:
                    hidden += 1
                    shown.append(False)
                continue
            seen = does == "visible" if does else sight[-1]
            if tag not in VOID:
                shown.append(True)
                sight.append(seen)
                above.append(element)
                folded.append(int(tag == "details" and "open" not in attrs))
            if tag == "br":
                flow.end_line(empty=True)
            elif tag == "hr":
                flow.block(2)
                flow.paste(["-" * 8])
                flow.block(2)
            elif tag == "img" and seen and attrs.get("alt", "").strip():
                flow.put(attrs["alt"])
            elif tag == "input" and seen and attrs.get("type", "text").lower() in ("text", "submit", "button", "reset") and attrs.get("value", "").strip():
                flow.put(" " + attrs["value"] + " ")
            elif tag == "table":
                flow.block(2)
                tables.append([])
                groups.append(0)
            elif tag == "tr" and tables:
                tables[-1].append((groups[-1], []))
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append((groups[-1], []))
                flows.append(Flow())
                across, down = (max(1, min(most, whole_number(attrs.get(name, ""), 1))) for name, most in (("colspan", 1000), ("rowspan", 65534)))
                tables[-1][-1][1].append((flows[-1], across, down))
            elif tag in _LIST:
                flow.block(2 if not lists else 1)
                back = tag == "ol" and "reversed" in attrs
                lists.append([tag == "ol", whole_number(attrs.get("start", ""), own_items.get(step, 1) if back else 1), attrs.get("type", ""), -1 if back else 1])
            elif tag == "li":
                flow.block(1)
                if lists and lists[-1][0]:
                    number = whole_number(attrs.get("value", ""), lists[-1][1])
                    mark = f"{_ordinal(number, attrs.get('type', lists[-1][2]))}. "
                    lists[-1][1] = number + lists[-1][3]
                else:
                    mark = "- "
                flow.marker = flow.indent + mark
                flow.indent += " " * len(mark)
                lists.append([None, len(mark)])
            elif tag == "dd":
                flow.block(1)
                flow.indent += "  "
            elif tag == "blockquote":
                flow.block(2)
                flow.indent += "> "
            elif tag in BLOCK:
                groups[-1] += tag in ("thead", "tbody", "tfoot")
                flow.block(2 if tag in SPACED else 1)
                pre += tag == "pre"
                pre_starts = tag == "pre"
            continue
        # close
        in_style = False
        if tag in VOID:
            continue
        if not shown.pop():
            hidden -= 1
            continue
        sight.pop()
        above.pop()
        folded.pop()
        groups[-1] += tag in ("thead", "tbody", "tfoot")
        if tag == "table" and tables:
            groups.pop()
            flow.paste(_grid([(group, [(cell.text().split("\n"), *spans) for cell, *spans in row]) for group, row in tables.pop() if row]))
            flow.block(2)
        elif tag in ("td", "th") and tables and len(flows) > 1:
            flow.end_line()
            flows.pop()
        elif tag in _LIST:
            if lists:
                lists.pop()
            flow.block(2 if not lists else 1)
        elif tag == "li":
            if flow.marker and not flow.inline:
                flow.marker = ""
            flow.block(1)
            if lists and lists[-1][0] is None:
                flow.indent = flow.indent[: -lists.pop()[1]]
        elif tag == "dd":
            flow.block(1)
            flow.indent = flow.indent[:-2]
        elif tag == "blockquote":
            flow.block(2)
            flow.indent = flow.indent[:-2]
        elif tag in BLOCK:
            flow.block(2 if tag in SPACED else 1)
            pre -= tag == "pre"
    return flows[0].text().strip("\n")


def _effect(element: tuple[str, str, frozenset], attrs: dict[str, str], rules: Rules, above: list[tuple[str, str, frozenset]]) -> str:
    """What the element's own attributes and the page's rules do to it."""
    if "hidden" in attrs or element[0] == "input" and attrs.get("type", "").lower() == "hidden":
        return "none"
    return _style(attrs.get("style", "")) or (rules.effect(element, above) if rules else "")


def extract(df: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """df with the rendered text of its HTML column in place of the HTML."""
    keep = [c for c in df.columns if c not in (column, into)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, column, 4 << 20):
            texts = [render(p) for p in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, into])

    return df.select(*keep, column).mapInArrow(run, schema_with(df.select(*keep), **{into: "string"}))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return extract(pages).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))
