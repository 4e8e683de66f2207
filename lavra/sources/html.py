"""HTML pages: visible text, titles, anchors and references, by one Arrow UDF over the standard parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import body_lines, normalize_space

# Elements that begin a line of their own, and those whose text isn't shown.
BLOCKS = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul", "title"}
HIDDEN = {"script", "style", "noscript", "template", "head"}
# Where a record page has its title, the first that holds text counts.
TITLES = ("h1", ".record-title", ".title")


# Elements that refer to files, and the attribute that does, in the order in which they're read.
REFERRING = (("a", "href"), ("iframe", "src"), ("embed", "src"), ("object", "data"))


class _Reader(HTMLParser):
    """Visible text, the page's title, elements by title selector, anchors and references of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0
        self.open: list[list] = []  # [tag, selector, parts, depth of the same tag]
        self.found: dict[str, str] = {}
        self.anchors: list[tuple[str, list[str]]] = []
        self.anchor: list[str] | None = None
        self.refs: list[list[str]] = [[] for _ in REFERRING]
        self.title: list[str] | None = None
        self.titled: str | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        if tag in BLOCKS:
            self.out.append("\n")
        if tag == "title" and self.titled is None and self.title is None:
            self.title = []
        own = dict(reversed(attrs))  # the first of two attributes of one name counts
        for x in self.open:
            x[3] += x[0] == tag
        names = [tag] + [f".{c}" for c in (own.get("class") or "").split()]
        for want in TITLES:
            if want in names and want not in self.found:
                self.found[want] = ""
                self.open.append([tag, want, [], 1])
        for place, (kind, attribute) in enumerate(REFERRING):
            if tag == kind and own.get(attribute) is not None:
                self.refs[place].append(own[attribute])
        if tag == "a":
            self.anchor = None
            if own.get("href") is not None:
                self.anchor = []
                self.anchors.append((own["href"], self.anchor))

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        if tag in BLOCKS:
            self.out.append("\n")
        if tag == "a":
            self.anchor = None
        if tag == "title" and self.title is not None:
            self.titled, self.title = "".join(self.title), None
        for x in self.open:
            x[3] -= x[0] == tag
        for x in [x for x in self.open if x[3] <= 0]:
            self.found[x[1]] = "".join(x[2])
            self.open.remove(x)

    def handle_data(self, data: str) -> None:
        if self.title is not None:
            self.title.append(data)
        if self.hidden:
            return
        self.out.append(data)
        if self.anchor is not None:
            self.anchor.append(data)
        for x in self.open:
            x[2].append(data)


def _read(page: str | None) -> tuple:
    if page is None:
        return None, None, [None] * len(TITLES), [], []
    r = _Reader()
    r.feed(page)
    r.close()
    for _, want, parts, _ in r.open:
        r.found[want] = "".join(parts)
    return r.titled, "".join(r.out), [r.found.get(t) for t in TITLES], [(i, u, " ".join("".join(t).split())) for i, (u, t) in enumerate(r.anchors)], [(i, u) for i, u in enumerate(u for us in r.refs for u in us)]


def _of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, t) for k, t in kinds.items()])


PAGE = _of(
    title=T.StringType(), text=T.StringType(), titles=T.ArrayType(T.StringType()),
    anchors=T.ArrayType(_of(pos=T.IntegerType(), url=T.StringType(), text=T.StringType())), refs=T.ArrayType(_of(pos=T.IntegerType(), url=T.StringType())),
)


@F.pandas_udf(PAGE)
def read_page(pages: pd.Series) -> pd.DataFrame:
    """One reading of each page: its ``title``, visible ``text``, the first element of each title selector, the
    ``anchors`` with an address and, element kind by element kind, all that it refers to (``refs``)."""
    return pd.DataFrame([_read(p) for p in pages], columns=["title", "text", "titles", "anchors", "refs"])


def page_title(titles: Column, text: Column, start: str = "detalhes bibliográficos") -> Column:
    """The first title with content, else the line before the section's heading, else null."""
    lines = body_lines(text)
    before = F.filter(F.transform(lines, lambda x, i: F.when((F.lower(x) == start) & (i > 0), i)), lambda x: x.isNotNull())
    said = F.filter(F.transform(titles, normalize_space), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(said, F.lit(1)), F.try_element_at(lines, F.try_element_at(before, F.lit(1))))
