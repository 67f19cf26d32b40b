"""Fields of a result row's HTML, by one Arrow UDF.

Spark's xpath functions need well-formed XML, and the label rule ("the first text of any later sibling `font` of
the label's span") shifts to the next field when a field is empty, which no pattern reproduces. Each snippet is cut
at its marks and becomes a flat list of nodes and texts in document order, where what is below a node are the items up
to a number; fields are read by these numbers. There is no tree and no recursion, so tags may nest to any depth. Tags
are looked at once, however often they repeat; what is no plain tag or text goes to the standard library's parser.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content; labels of the case details; class of their block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LABELS = {"cnr": "CNR", "date_of_registration": "Date of registration", "decision_date": "Decision Date", "disposal_nature": "Disposal Nature"}
DETAILS_CLASS = "caseDetailsTD"

FIELDS = (
    "has_button boolean, onclick string, title string, description string, judge string, judge_valid boolean, "
    "cnr string, date_of_registration string, decision_date string, disposal_nature string, court_name string, labels map<string,string>"
)


class Flat:
    """A snippet's nodes and texts in document order, without a tree: what is below item i are the items up to end[i].

    tag is None for a text; data is a text, or a node's attributes; parent is an item's number, or -1 at the top.
    """

    __slots__ = ("tag", "data", "parent", "end", "_open", "_names")

    def __init__(self) -> None:
        self.tag: list[str | None] = []
        self.data: list = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self._open: list[int] = [-1]
        self._names: dict[str, int] = {}

    def start(self, tag: str, attrs: dict[str, str | None], empty: bool) -> None:
        i = len(self.tag)
        self.tag.append(tag)
        self.data.append(attrs)
        self.parent.append(self._open[-1])
        self.end.append(i + 1)
        if not empty:
            self._open.append(i)
            self._names[tag] = self._names.get(tag, 0) + 1

    def close(self, tag: str) -> None:
        """End the innermost open node of the name and those within it; a tag that closes none is passed over."""
        if not self._names.get(tag):
            return
        last, name = len(self.tag), None
        while name != tag:
            i = self._open.pop()
            self.end[i] = last
            name = self.tag[i]
            self._names[name] -= 1

    def text(self, text: str) -> None:
        """A text; one right behind another text of the same node goes on with it."""
        tag, top = self.tag, self._open[-1]
        if tag and tag[-1] is None and self.parent[-1] == top:
            self.data[-1] += text
            return
        tag.append(None)
        self.data.append(text)
        self.parent.append(top)
        self.end.append(len(tag))

    def done(self) -> Flat:
        for i in self._open[1:]:
            self.end[i] = len(self.tag)
        return self

    def _range(self, i: int, within: int) -> list[int]:
        last, end, found = self.end[within] if within >= 0 else len(self.tag), self.end, []
        while i < last:
            found.append(i)
            i = end[i]
        return found

    def below(self, node: int) -> list[int]:
        """Items right below a node (-1 for the top)."""
        return self._range(node + 1, node)

    def later(self, node: int) -> list[int]:
        """Items behind a node that have the same parent."""
        return self._range(self.end[node], self.parent[node])

    def first_text(self, node: int) -> str | None:
        """The first direct text of a node."""
        i, last, tag, end = node + 1, self.end[node], self.tag, self.end
        while i < last:
            if tag[i] is None:
                return self.data[i]
            i = end[i]
        return None

    def all_texts(self, node: int) -> list[str]:
        return [self.data[i] for i in range(node + 1, self.end[node]) if self.tag[i] is None]


class View:
    """A node of a Flat (-1 for the top) with its items, as a tree would have it."""

    def __init__(self, flat: Flat, at: int = -1) -> None:
        self.flat, self._at = flat, at

    @property
    def tag(self) -> str:
        return self.flat.tag[self._at] if self._at >= 0 else ""

    @property
    def attrs(self) -> dict[str, str | None]:
        return self.flat.data[self._at] if self._at >= 0 else {}

    @property
    def items(self) -> list[View | str]:
        return [self.flat.data[i] if self.flat.tag[i] is None else View(self.flat, i) for i in self.flat.below(self._at)]


class _Parsed(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.flat = Flat()

    def handle_starttag(self, tag, attrs):
        self.flat.start(tag, dict(attrs), tag in VOID)

    def handle_startendtag(self, tag, attrs):
        self.flat.start(tag, dict(attrs), True)

    def handle_endtag(self, tag):
        self.flat.close(tag)

    def handle_data(self, data):
        self.flat.text(data)


#: Elements whose content a parser reads by rules of its own.
_SPECIAL = frozenset("script style textarea title xmp iframe noembed noframes plaintext noscript".split())
_ATTRIBUTE = r"""[a-zA-Z][-\w:.]*(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'))?"""
_MARK = re.compile(r"<[^<>]*>|[^<>]+")
#: A plain tag: closing slash, name, attributes, slash of an empty element.
_TAG = re.compile(rf"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s+{_ATTRIBUTE})*)\s*(/?)>""")
_PAIR = re.compile(r"""([a-zA-Z][-\w:.]*)(?:(\s*=\s*)(?:"([^"]*)"|'([^']*)'))?""")


def _text(t: str) -> str:
    return unescape(t) if "&" in t else t


@lru_cache(maxsize=1 << 14)
def _tag(mark: str) -> tuple[bool, str, dict[str, str | None], bool] | None:
    """(closing, name, attributes, empty) of a plain tag; None for anything else. Most tags of a layer are the same few."""
    m = _TAG.fullmatch(mark)
    if m is None:
        return None
    closing, tag, attributes, slash = m.groups()
    tag = tag.lower()
    if tag in _SPECIAL or (closing and (attributes or slash)):
        return None
    pairs = {}
    if attributes:
        for name, equals, double, single in _PAIR.findall(attributes):
            pairs[name.lower()] = _text(double or single) if equals else None
    return bool(closing), tag, pairs, bool(slash) or tag in VOID


def _plain_tree(html: str) -> View | None:
    """The items of a snippet of plain tags and text; None if it has anything else."""
    marks = _MARK.findall(html)
    if sum(map(len, marks)) != len(html):
        return None
    flat = Flat()
    start, close, text = flat.start, flat.close, flat.text
    for m in marks:
        if m[0] != "<":
            text(unescape(m) if "&" in m else m)
            continue
        found = _tag(m)
        if found is None:
            return None
        closing, tag, attrs, empty = found
        if closing:
            close(tag)
        else:
            start(tag, attrs, empty)
    return View(flat.done())


def _parsed_tree(html: str) -> View:
    p = _Parsed()
    p.feed(html)
    p.close()
    return View(p.flat.done())


def scan(html: str) -> tuple[Flat, int]:
    """The items of a snippet and its root: the top (-1), or a lone outer element."""
    flat = (_plain_tree(html) or _parsed_tree(html)).flat
    kids = [i for i in flat.below(-1) if flat.tag[i] is not None or flat.data[i].strip()]
    return flat, kids[0] if len(kids) == 1 and flat.tag[kids[0]] in ("div", "td", "tr", "body", "html") else -1


def _field(flat: Flat, spans: list[tuple[str, int]], label: str) -> str:
    """First text of any later sibling `font` of the spans with the label, in document order; empty if none."""
    for first, span in spans:
        if label in first:
            for i in flat.later(span):
                if flat.tag[i] == "font" and (text := flat.first_text(i)) is not None:
                    return text.strip()
    return ""


def fields(html: str | None) -> dict:
    """All fields of a snippet; missing ones are empty. judge_valid is false where the row has to be dropped."""
    out = {"has_button": False, "onclick": None, "title": "", "description": "", "judge": "", "judge_valid": True, "cnr": "", "date_of_registration": "", "decision_date": "", "disposal_nature": "", "court_name": "", "labels": {}}
    if not html:
        return out
    flat, root = scan(html)
    tags, data = flat.tag, flat.data
    if "button" in tags:
        attrs = data[tags.index("button")]
        out["has_button"], out["onclick"] = "onclick" in attrs, attrs.get("onclick")
    title = direct = judge = None
    for i in flat.below(root):
        tag = tags[i]
        if tag is None:
            direct = data[i] if direct is None else direct
        elif tag == "button" and title is None:
            title = next(iter(flat.all_texts(i)), None)
        elif tag == "strong" and judge is None:
            judge = flat.first_text(i)
    out["title"], out["description"] = (title or "").strip(), (direct or "").strip()
    if judge is not None:
        parts = judge.split(":")
        out["judge_valid"] = len(parts) > 1
        out["judge"] = parts[1].strip() if len(parts) > 1 else ""
    block = next((i for i, t in enumerate(tags) if t == "strong" and data[i].get("class") == DETAILS_CLASS), None)
    if block is None:
        return out
    within = [i for i in range(block + 1, flat.end[block]) if tags[i] == "span"]
    spans = [(t, i) for i in within if (t := flat.first_text(i)) is not None]
    for name, label in LABELS.items():
        out[name] = _field(flat, spans, label)
    court = next((t for t, _ in spans if "Court" in t), "")
    if ":" in court:
        out["court_name"] = court.split(":")[1].strip()
    for span in within:
        value = next((i for i in flat.later(span) if tags[i] is not None or data[i].strip()), None)
        if value is not None and (key := "".join(flat.all_texts(span)).strip().rstrip(":").strip()):
            out["labels"].setdefault(key, (data[value] if tags[value] is None else "".join(flat.all_texts(value))).strip())
    return out


def _struct(html: pa.Array) -> pa.Array:
    rows = [fields(x) for x in html.to_pylist()]
    names = [x.split()[0] for x in FIELDS.split(", ")]
    kinds = [pa.map_(pa.string(), pa.string()) if n == "labels" else pa.bool_() if n in ("has_button", "judge_valid") else pa.string() for n in names]
    columns = [pa.array([list(r[n].items()) for r in rows] if n == "labels" else [r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
    return pa.StructArray.from_arrays(columns, names=names)


def html_fields(html: Column) -> Column:
    """Struct of FIELDS for each snippet."""
    return F.arrow_udf(_struct, FIELDS)(html)
