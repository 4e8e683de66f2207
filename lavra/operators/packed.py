"""Several values packed in one field: a parsing expression grammar, one row per value.

Grammar (ordered choice ``/``, greedy repetition, ``!`` not followed by, ``&`` followed by)::

    field    <- space json space end / space items space end
    json     <- '[' string (',' string)* ']'                      strings with backslash escapes
    items    <- sep* (mark? item sep*)*
    mark     <- '(' digit+ ')' space / digit+ [.)] space &start / bullet space
    item     <- quoted / bracketed / bare
    quoted   <- q (!closing any)+ closing                         q one of " ' and their curly forms
    closing  <- q &(space (sep / end)) / q &(quote / bracket)     the second where q isn't also the opening sign
    bracketed<- '<' (!'>' any)+ '>' / '[' (!']' any)+ ']' / '(' start (!')' any)+ ')'
    bare     <- (!stop any)+
    stop     <- end / line break / space+ / [;,|]+ space* &boundary
    boundary <- start / quote / bracket / end / sep
    start    <- scheme '://' / scheme ':' (doi hdl urn ark and the like) / 'www.' / '10.' digit+ '/'

A quoted or bracketed alternative that finds no closing sign fails and the parser goes back to the item's
first character: the sign is skipped, the value is read as a bare one and carries an error flag.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Signs that open a quoted value and what closes each.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "`": "`"}
BRACKETS = {"<": ">", "[": "]", "(": ")", "{": "}"}
# Words between two values that only join them.
JOINERS = ("e", "ou", "y", "o", "and", "or", "et", "&", "+", "/", "-", "–", "—", "•", "*", "·")
# Schemes of identifiers that have no '//'.
SCHEMES = ("doi", "hdl", "urn", "ark", "info", "oai", "isbn", "issn", "pmid", "arxiv", "mailto", "purl")

START = re.compile(r"(?:[a-z][a-z0-9+.\-]*:\\?/\\?/|(?:" + "|".join(SCHEMES) + r"):\S|www\.[^\s.]|10\.\d{3,9}/\S)", re.I)
MARK = re.compile(r"\(\d{1,3}\)[ \t]*|\[\d{1,3}\][ \t]*|\d{1,3}[.)][ \t]+")
WHITE = re.compile(r"\s+")
TOKEN = re.compile(r"\S+")


class Packed:
    """One parse of one field. ``values`` gets (value, flag); flag is null, or names what was repaired."""

    def __init__(self, text: str) -> None:
        self.text, self.end, self.values = text, len(text), []

    def parse(self) -> list[tuple[str, str | None]]:
        if not self.json():
            self.values = []
            self.items()
        return self.values

    def json(self) -> bool:
        """The first alternative; false where the text is no well-formed list of strings."""
        text = self.text.strip(" \t\r\n;,|")
        if not (text.startswith("[") and text.endswith("]") and '"' in text):
            return False
        try:
            got = json.loads(text)
        except ValueError:
            return False
        for x in got:
            if isinstance(x, str) and x.strip():
                self.values.append((x.strip(), None))
        return True

    def items(self) -> None:
        at = self.skip(0)
        while at < self.end:
            if (m := MARK.match(self.text, at)) and self.starts(m.end()):
                at = m.end()
            at = self.skip(self.item(at))

    def starts(self, at: int) -> bool:
        return at < self.end and (START.match(self.text, at) is not None or self.text[at] in QUOTES or self.text[at] == "<")

    def skip(self, at: int) -> int:
        """Past white space, delimiters and joining words."""
        while at < self.end:
            c = self.text[at]
            if c.isspace() or c in ";,|":
                at += 1
            elif (m := TOKEN.match(self.text, at)) and m[0].rstrip(";,|").lower() in JOINERS:
                at += len(m[0])
            else:
                break
        return at

    def item(self, at: int) -> int:
        sign = self.text[at]
        for signs, rule in ((QUOTES, self.quoted), (BRACKETS, self.bracketed)):
            if sign in signs and (to := rule(at, signs[sign])):
                return to
        if sign in QUOTES or sign in BRACKETS or sign in "\\]>)}”’»":
            after = at + 1
            while after < self.end and (self.text[after] in QUOTES or self.text[after] in BRACKETS or self.text[after] in "\\]>)}”’»"):
                after += 1
            if after >= self.end or self.text[after].isspace() or self.text[after] in ";,|":
                return max(after, at + 1)
            return self.bare(after, "unclosed")
        return self.bare(at, None)

    def quoted(self, at: int, close: str) -> int:
        """Position after the value, 0 where no closing sign fits."""
        to = at + 1
        while (to := self.text.find(close, to)) >= 0:
            back = to > at and self.text[to - 1] == "\\"
            after = WHITE.match(self.text, to + 1)
            nxt = after.end() if after else to + 1
            opens = close != self.text[at] and nxt < self.end and (self.text[nxt] in QUOTES or self.text[nxt] in BRACKETS)
            if not back and (nxt >= self.end or after or opens or self.text[nxt] in ";,|]>)"):
                if self.several(inner := self.text[at + 1 : to]):
                    return 0  # the sign closes a later value: this one has lost its own
                return self.add(inner, None) or to + 1
            to += 1
        return 0

    def bracketed(self, at: int, close: str) -> int:
        to = self.text.find(close, at + 1)
        if to < 0 or self.several(inner := self.text[at + 1 : to]) or self.text[at] in "[({" and not START.match(inner.lstrip("\"' ")):
            return 0
        self.add(inner.strip("\"' "), None)
        return to + 1

    def several(self, inner: str) -> bool:
        """Whether a delimiter and the start of another value lie inside."""
        return any(START.match(inner, m.end()) for m in re.finditer(r"[;,|\s]\s*[\"'<]*", inner))

    def bare(self, at: int, flag: str | None) -> int:
        to = at
        while to < self.end:
            c = self.text[to]
            if c.isspace():
                break
            if c in ";,|" and self.boundary(to):
                break
            if c in "\"”»>" and (to + 1 >= self.end or self.text[to + 1].isspace() or self.text[to + 1] in ";,|]"):
                flag = "unopened" if flag is None else flag
                break
            to += 1
        value = self.text[at:to]
        if flag and value.endswith(("]", ")", "'", "’")):
            value = value[:-1]
        self.add(value, flag)
        return max(to, at + 1)

    def boundary(self, at: int) -> bool:
        """Whether the delimiter at ``at`` ends the value, and isn't a sign within it."""
        to = at
        while to < self.end and (self.text[to] in ";,|" or self.text[to].isspace()):
            to += 1
        if to >= self.end or any(c.isspace() for c in self.text[at:to]):
            return True
        if m := MARK.match(self.text, to):
            to = m.end() if self.starts(m.end()) else to
        return self.starts(to) or self.text[to] in "\"'<“‘«"

    def add(self, value: str, flag: str | None) -> None:
        value = value.strip().replace("\\/", "/")
        if value:
            self.values.append((value, flag))


def parse_packed(text: str | None) -> list[tuple[str, str | None]]:
    """The values of one field in field order, each with its flag; none for null and blank text.

    Words that are no address or identifier ("ver na biblioteca") are not values of such a field.
    """
    if not text or not text.strip():
        return []
    return [(v, f) for v, f in Packed(text).parse() if START.match(v)]


def split_packed(df: DataFrame, key: str, column: str, least: int = 1) -> DataFrame:
    """One row (``key``, ``pos int``, ``value``, ``flag``, ``n int``) for each value in ``column``.

    ``n`` is the number of values in the field; fields with fewer than ``least`` give no rows. Null, blank and
    valueless fields give none either. A repeated value counts each time; rows with the same key each give their
    own values. Other columns of ``df`` are ignored, whatever their names. Texts are parsed whole, in linear time
    but for failed quotes, which cost one more pass each. Narrow: no shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, pos, values, flags, ns = [], [], [], [], []
            for k, text in zip(b["k"].tolist(), b["v"].tolist()):
                got = parse_packed(text)
                if len(got) >= least:
                    for i, (v, f) in enumerate(got, 1):
                        keys.append(k), pos.append(i), values.append(v), flags.append(f), ns.append(len(got))
            yield pd.DataFrame({key: pd.Series(keys, dtype=b["k"].dtype if keys else object), "pos": pd.Series(pos, dtype="int32"), "value": pd.Series(values, dtype=object), "flag": pd.Series(flags, dtype=object), "n": pd.Series(ns, dtype="int32")})

    kind = df.schema[key].dataType.simpleString()
    some = df.select(F.col(key).alias("k"), F.col(column).alias("v")).where(F.col("v").isNotNull())
    return some.mapInPandas(run, f"{key} {kind}, pos int, value string, flag string, n int")
