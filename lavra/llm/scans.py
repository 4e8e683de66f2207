"""Noise in text from scanned pages: furniture, divided words, misread letters, and the repaired text.

1. Blocks: a block of pages becomes one row: its distinct tokens, its pages as codes of them, its distinct forms with
   the number of pages that hold each, and the lines at the pages' edges. All that follows reads codes, not texts; a
   word that stands a million times in a block travels once.
2. Furniture: the lines at a page's edges, without their number and with confusable letters folded, are counted in
   overlapping stretches of the volume's pages; what stands on two pages of a stretch is running. Printed numbers vote
   on the volume's offset from ``page_no``; a line of nothing but the fitting number is a page number.
3. Lexicon: the forms of all pages with the number of pages that hold each.
4. Candidates: a symmetric-delete index. A lexicon word stands under itself and every form with one letter less; a
   suspect looks up itself, its forms with one letter less, and both with each doubtful letter group read as one letter.
   A weighted edit distance, cheap along known confusions, verifies; of several candidates the likeliest in the
   bigram context wins, then the cheaper, then the more frequent one. Context is counted for doubtful words only.
5. Division: a form across a line's end is looked up joined and with its hyphen. A page's last body line meets the
   first body word of the next page of its volume that has one.
6. The few forms that are repaired come back to the blocks that hold them, where lines are judged on the codes.
   Paragraphs are put together with the repairs of each page; a paragraph's pieces on several pages meet under the
   page on which it begins.

Hot words: a word stands in a block once, so a join on words has at most a row a block for each; those that stand in
more than one in twenty blocks, whose number a block's size bounds, are joined by broadcast (``blocks.join_words``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.blocks import join_words, often
from lavra.session import released, spread, table, written

# What scanners make of letters, (printed, read).
CONFUSIONS = [("a", "@"), ("e", "c"), ("c", "e"), ("o", "0"), ("i", "l"), ("l", "i"), ("i", "1"), ("l", "1"), ("i", "|"), ("l", "|"), ("s", "5"), ("t", "f"), ("f", "t"), ("n", "ri"), ("u", "ii"), ("d", "cl"), ("m", "rn"), ("v", "u"), ("u", "v"), ("b", "6"), ("ç", "g"), ("ã", "ä"), ("õ", "ö"), ("g", "9"), ("q", "9"), ("h", "li"), ("w", "vv"), ("z", "2"), ("a", "4"), ("b", "8"), ("ó", "6"), ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h")]
GROUPS = [(read, printed) for printed, read in CONFUSIONS if len(read) > 1]
APART = 16  # pages of a stretch in which a running line comes again; stretches overlap by half
WINDOW = 256  # pages of a volume that one window covers; the windows meet as one row each
COST, MOST = 0.4, 0.85  # of a confusion; of a whole reading: two confusions
RATIO = 8  # a candidate stands on so many times the pages of the form read for it, at least
ODD = r"[@|0-9]"
BLOCK_CHARS = 8_000_000  # a block ends after so many characters, or with the Arrow batch
HEAD, FOOT = 2, 3  # lines with content at a page's edges that can be furniture
LONG = 60  # letters from which a word is indexed by its segments: its forms with one letter less would be too many
SEGMENTS = 5  # of a long word: two confusions touch four at most
PAGE = "\x03"
TOKENS = re.compile(r" ?([\w@|'’\-]+[‐\xad¬]?|\n|\x03|[^\w\s@|'’\-\x03]+)")  # a match begins at the blank: half as much is tried
TOKEN = re.compile(r"[^\W_](?:[^\W_]|[@|'’-])*|[@|][^\W_]?(?:[^\W_]|[@|'’-])*")
LETTER = re.compile(r"[^\W\d_]")
FOLLOW = re.compile(r"(?:[^\W_]|[@|'’-])*[^\W\d_](?:[^\W_]|[@|'’-])*")
FOUR = re.compile(r"(?:[^\W\d_][\W\d_]*){4}")
GAP, BLANKS = re.compile(r"\s\s"), re.compile(r"[^\S\n]+")
SIGNS = "-'’"  # around a word
MARKS = "-‐­¬"
SHORT = 0.85  # of a page's widest line: a line that ends a sentence and is shorter ends its paragraph
STOPPED, HEADING = re.compile(r"[.!?:;][)\]”\"'’»]*$"), re.compile(r"^\d+(?:\.\d+)+\.?\s+[^\W\d_].*[^.,;:\-]$")
CLITICS = {"se", "lo", "la", "los", "las", "me", "te", "nos", "lhe", "lhes", "no", "na", "nas", "ei", "ia"}
# Foldings of letters that scanners confuse, groups first.
FOLD_GROUPS = [("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("li", "h"), ("vv", "w")]
FOLD = str.maketrans({c: k for k, cs in {"a": "@4äãáàâ", "o": "0öõóô", "i": "1l|í", "s": "5", "b": "68", "g": "9qç", "c": "eéê", "t": "f", "u": "vú", "z": "2"}.items() for c in cs})
NUMBER = r"[0-9lIiOoSs|@B]{1,4}"
ROMAN = r"[ivxlcdm1|]{1,7}"
ALONE = re.compile(rf"^(?P<a>[-–—\[(]?\s*|p[áa@]g(?:ina|\.)?\s*|p\.?\s*|fl?s?\.\s*)(?P<n>{NUMBER}|{ROMAN})(?P<z>\s*[-–—\])]?|\s*(?:/|de)\s*{NUMBER})$", re.I)
BEFORE, AFTER = re.compile(rf"^\s*({NUMBER}|{ROMAN})\s{{2,}}(\S.*)$", re.I), re.compile(rf"^(.*\S)\s{{2,}}({NUMBER}|{ROMAN})\s*$", re.I)
DIGITS = str.maketrans("lIiOoSs|@B", "1110055108")


def number_of(text: str) -> int | None:
    """A printed number, roman or with letters read for digits; null for a word."""
    if re.fullmatch(r"[ivxlcdm1|]+", text.lower()) and not re.search(r"\d\d", text) and not text.isdigit():
        s, total, last = text.lower().replace("1", "l").replace("|", "l"), 0, 0
        value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
        if not (set(s) <= {"l"}):
            for c in reversed(s):
                v = value[c]
                total, last = (total - v, last) if v < last else (total + v, v)
            return total
    if re.search(r"\d", text) or re.fullmatch(r"[lI|]+|[lIO|]{2,4}", text):
        n = text.translate(DIGITS)
        return int(n) if n.isdigit() else None
    return None


def folded(lines: list[str]) -> list[str]:
    """Lines with letters that scanners confuse made alike, without blanks and case."""
    s = BLANKS.sub("", "\n".join(lines).lower())
    for a, b in FOLD_GROUPS:
        s = s.replace(a, b)
    return s.translate(FOLD).split("\n")


def page_lines(text: str) -> list[str]:
    """Lines end at LF; a CR before it is no content."""
    lines = text.split("\n")
    return [l[:-1] if l.endswith("\r") else l for l in lines] if "\r" in text else lines


def outer(lines: list[str], head: int, foot: int) -> list[tuple[int, str]]:
    """The first ``head`` and last ``foot`` lines with content and their places, in order, each once."""
    first, last, i, j = [], [], 0, len(lines) - 1
    while i < len(lines) and len(first) < head:
        if s := lines[i].strip():
            first.append((i, s))
        i += 1
    while j >= i and len(last) < foot:
        if s := lines[j].strip():
            last.append((j, s))
        j -= 1
    return first + last[::-1]


def edge_of(s: str) -> tuple[str | None, int | None, bool] | None:
    """(body, number, alone) of a line that can be furniture; ``body`` without its number, null where that is all."""
    if (m := ALONE.match(s)) and (n := number_of(m["n"])) is not None:
        return None, n, True
    n, body = None, s
    if GAP.search(s):
        for p, g, b in ((BEFORE, 1, 2), (AFTER, 2, 1)):
            if (m := p.match(s)) and (v := number_of(m[g])) is not None:
                n, body = v, m[b].strip()
                break
    if n is None and (body[-1] in ".,;:?!" or body[-1] in MARKS and body[-2:-1].isalnum()):
        return None
    return (body, n, False) if FOUR.search(body) else None


def tail_of(s: str) -> str | None:
    """The piece of a word before a mark at the line's end, with \\u0001 for a hyphen or \\u0002 for another mark."""
    if s[-1] not in MARKS:
        return None
    i = len(s) - 1
    while i and (s[i - 1].isalnum() or s[i - 1] in "@|'’-"):
        i -= 1
    piece = s[i:-1].lower().lstrip(SIGNS)
    return piece + ("\u0001" if s[-1] == "-" else "\u0002") if LETTER.search(piece) else None


def page_edges(text: str) -> tuple[list[tuple], list[tuple]]:
    """(line, body, number, alone) of the lines at the edges, and the lines that may be the first or last of the body.

    The latter are all that can be furniture and one more on either side, each with what its end needs. ``token`` and ``rest``: the first word as it
    stands and its letters; ``tail``: see :func:`tail_of`; ``fresh``: it begins a paragraph; ``ended``: it ends one.
    """
    lines = page_lines(text)
    full = outer(lines, HEAD + 1, FOOT + 1)
    if not full:
        return [], []
    width = len(max(lines, key=len).strip())
    n = len(full)
    few = n <= HEAD + FOOT  # then any of them can be the first or last
    edges, ends = [], []
    for k, (i, s) in enumerate(full):
        if (k < HEAD or k >= n - FOOT) and (e := edge_of(s)):
            edges.append((i + 1, *e))
        heading = s[0].isdigit() and HEADING.match(s) is not None
        token = rest = fresh = tail = ended = None
        if k <= HEAD or few:  # the only ones that can be the first
            token = s.split(None, 1)[0]
            found = FOLLOW.match(token.lower())
            rest = found[0].rstrip(SIGNS) if found else ""
            fresh = heading or lines[i].startswith("   ")
        if k >= n - FOOT - 1 or few:
            tail = tail_of(s) if s[-1] in MARKS else None
            ended = heading or len(s) < SHORT * width and STOPPED.search(s) is not None
        ends.append((i + 1, token, rest, tail, fresh, ended))
    return edges, ends


def weighted(printed: str, read: str, most: float = MOST) -> float:
    """Weighted edit distance: ``COST`` for a known confusion, 1 for any other edit; above ``most`` it's 9."""
    i, near = 0, min(len(printed), len(read))
    while i < near and printed[i] == read[i]:
        i += 1
    j = 0
    while j < near - i and printed[-1 - j] == read[-1 - j]:
        j += 1
    # a confusion may share a letter with what is alike around it
    i, j = max(0, i - 1), max(0, j - 1)
    a, b = printed[i : len(printed) - j], read[i : len(read) - j]
    if abs(len(a) - len(b)) > 2:
        return 9.0
    best = {(0, 0): 0.0}  # of a band: no confusion moves by more than one place, and two are the most
    for x in range(len(a) + 1):
        for y in range(max(0, x - 2), min(len(b), x + 2) + 1):
            v = best.get((x, y), 9.0)
            if v > most:
                continue
            ways = [(x + dx, y + dy, v + c) for dx, dy, c in ((1, 1, 0.0 if x < len(a) and y < len(b) and a[x] == b[y] else 1.0), (1, 0, 1.0), (0, 1, 1.0))]
            ways += [(x + len(p), y + len(r), v + COST) for p, r in CONFUSIONS if a.startswith(p, x) and b.startswith(r, y)]
            for x2, y2, c in ways:
                if c < best.get((x2, y2), 9.0):
                    best[x2, y2] = c
    cost = best.get((len(a), len(b)), 9.0)
    return cost if cost <= most else 9.0


def _deletes(form: str) -> set[str]:
    return {form} | {form[:i] + form[i + 1 :] for i in range(len(form))}


def index_keys(word: str) -> set[str]:
    """The keys under which a lexicon word stands; a long word by its length and segments."""
    if len(word) <= LONG:
        return _deletes(word)
    k = len(word) // SEGMENTS
    return {f"{len(word)} {i} {word[i * k : (i + 1) * k]}" for i in range(SEGMENTS)}


def lookups(form: str) -> set[str]:
    """The keys under which a suspect is looked up."""
    keys: set[str] = set()
    if len(form) <= LONG + 2:
        forms = {form}
        for read, printed in GROUPS:
            at = form.find(read)
            while at >= 0:
                forms.add(form[:at] + printed + form[at + len(read) :])
                at = form.find(read, at + 1)
        keys = {k for f in forms for k in _deletes(f)}
    for size in range(max(len(form) - 2, LONG + 1), len(form) + 3):
        k = size // SEGMENTS
        keys |= {f"{size} {i} {form[at : at + k]}" for i in range(SEGMENTS) for at in range(max(0, i * k - 2), i * k + 3) if at + k <= len(form)}
    return keys


def _emit(column: str, keys):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 2000):
                part = b.iloc[at : at + 2000]
                out = [(k, w, d) for w, d in zip(part["w"], part["d"]) for k in keys(w)]
                yield pd.DataFrame(out, columns=["key", column, f"{column}_d"])

    return run


@F.pandas_udf(T.DoubleType())
def distance(printed: pd.Series, read: pd.Series) -> pd.Series:
    return pd.Series([weighted(a, b) for a, b in zip(printed, read)], dtype=float)


LINE = "struct<line_no: int, token: string, rest: string, tail: string, fresh: boolean, ended: boolean>"
BLOCK = f"""block bigint, pages array<bigint>, codes binary, words array<string>, forms array<struct<form: string, d: bigint>>,
    edges array<struct<page_id: bigint, volume: string, page_no: int, line_no: int, key: string, number: bigint, alone: boolean>>,
    ends array<struct<page_id: bigint, volume: string, page_no: int, ends: array<{LINE}>>>,
    of array<struct<pdf_path: string, page_no: int>>, texts array<string>"""


class Lines:
    """The lines with content of a block, from its codes. ``words`` are the block's distinct tokens."""

    def __init__(self, codes: np.ndarray, words: list[str]) -> None:
        self.words = words
        place = {w: i for i, w in enumerate(words) if w in ("\n", PAGE)}
        page_end = codes == place.get(PAGE, -1)
        ends = page_end | (codes == place.get("\n", -1))
        at = np.flatnonzero(~ends)
        self.codes = codes[at]
        line, page = np.cumsum(ends, dtype=np.int32), np.cumsum(page_end, dtype=np.int32)
        base = np.concatenate([[0], line[page_end]])
        new = np.ones(len(at), bool)
        new[1:] = line[at[1:]] != line[at[:-1]]
        self.first = np.flatnonzero(new)  # places among the tokens
        self.last = np.append(self.first[1:], len(at))[: len(self.first)] - 1
        self.line_of = np.cumsum(new) - 1  # of each token
        self.page = page[at[self.first]]
        self.line_no = line[at[self.first]] - base[self.page] + 1
        self._read_words()

    def _read_words(self) -> None:
        """Of each token: its form, and whether it may begin or end a divided word."""
        self.forms: list[str] = []  # distinct
        known: dict[str, int] = {}
        n = len(self.words)
        self.form_of, self.mark, self.begins, self.letters = np.full(n, -1), np.zeros(n, np.int8), np.zeros(n, bool), np.zeros(n, bool)
        for i, w in enumerate(self.words):
            if not (w[0].isalnum() or w[0] in "@|'’-"):
                continue
            mark = 1 if w[-1] == "-" else 2 if w[-1] in MARKS else 0
            form = (w[:-1] if mark == 2 else w).strip(SIGNS)
            if not form:
                continue
            letter = LETTER.search(form) is not None
            self.form_of[i] = known.setdefault(form, len(known))
            self.letters[i] = form.isalpha()
            self.mark[i] = mark if letter else 0
            self.begins[i] = letter and w[0] not in SIGNS
        self.forms = list(known)

    def rest(self, code: int) -> str:
        """The letters of a word that goes on from the line before."""
        w = self.words[code]
        return (w[:-1] if w[-1] in MARKS else w).rstrip(SIGNS)

    def piece(self, code: int) -> str:
        """The piece before a line's end, with its mark."""
        w = self.words[code]
        return w[:-1].lstrip(SIGNS) + ("\u0001" if w[-1] == "-" else "\u0002")

    def divided(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the given lines (places, in order): which end in a piece, the line that follows on the page or -1, and
        whether it begins with the rest. A rest alone on its line is no piece."""
        nxt = np.full(len(lines), -1)
        if len(lines) > 1:
            nxt[:-1] = np.where(self.page[lines[1:]] == self.page[lines[:-1]], lines[1:], -1)
        last, first = self.codes[self.last[lines]], self.codes[self.first[lines]]
        piece = self.mark[last] > 0
        goes_on = np.zeros(len(lines), bool)
        goes_on[:-1] = self.begins[first[1:]] & (nxt[:-1] >= 0)
        rest = np.zeros(len(lines), bool)
        rest[1:] = (piece & goes_on)[:-1]
        piece &= ~(rest & (self.first[lines] == self.last[lines]))
        return piece, nxt, piece & goes_on

    def counted(self) -> tuple[list[str], np.ndarray]:
        """The block's distinct forms and the number of its pages that hold each; a divided word is one form."""
        every = np.arange(len(self.first))
        _, nxt, joined = self.divided(every)
        single = self.form_of[self.codes]
        i = every[joined]
        single[self.last[i]] = single[self.first[nxt[joined]]] = -1
        page, own = self.page[self.line_of], single >= 0
        page, single = page[own], single[own]
        d = np.zeros(len(self.forms), np.int64)
        step = max(1, 20_000_000 // max(1, len(self.forms)))  # pages at a time
        for at in range(0, int(page[-1]) + 1 if len(page) else 0, step):
            lo, hi = np.searchsorted(page, [at, at + step])
            held = np.zeros((min(step, int(page[-1]) + 1 - at), len(self.forms)), bool)
            held[page[lo:hi] - at, single[lo:hi]] = True
            d += held.sum(0)
        there = np.flatnonzero(d)
        a, b = self.codes[self.last[i]].astype(np.int64), self.codes[self.first[nxt[joined]]]
        pairs = np.unique(np.stack([a * len(self.words) + b, self.page[i]], 1), axis=0)[:, 0] if len(i) else np.zeros(0, np.int64)
        pairs, n = np.unique(pairs, return_counts=True)
        more: dict[str, int] = {}
        for p, c in zip(pairs.tolist(), n.tolist()):
            form = self.piece(p // len(self.words)) + self.rest(p % len(self.words))
            more[form] = more.get(form, 0) + c
        return [self.forms[k] for k in there] + list(more), np.concatenate([d[there], np.array(list(more.values()), np.int64)])


def _packed(codes: np.ndarray, words: int) -> bytes:
    return zstandard.compress(codes.astype(np.uint16 if words <= 65_536 else np.int32).tobytes(), 1)


def _unpacked(codes: bytes, words: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(codes), np.uint16 if words <= 65_536 else np.int32).astype(np.int32)


def _tokens(texts: list[str]) -> pa.DictionaryArray:
    """The tokens of pages, with line and page ends; a sign of its own for every underline."""
    t = PAGE.join(texts)
    if t.count(PAGE) != len(texts) - 1:
        t = PAGE.join(x.replace(PAGE, " ") for x in texts)
    return pa.array(TOKENS.findall(t.lower().replace("_", "~").replace("\r", " ")), pa.string()).dictionary_encode()


def _list(values: pa.Array) -> pa.ListArray:
    """The values as the single list of a column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["block", "pages", "codes", "words", "forms", "edges", "ends", "of", "texts"]
    line = {"line_no": pa.int32(), "token": pa.string(), "rest": pa.string(), "tail": pa.string(), "fresh": pa.bool_(), "ended": pa.bool_()}
    for b in batches:
        chars = np.cumsum(np.asarray(b.column("chars"), dtype=np.int64))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + BLOCK_CHARS, side="right")))
            part = b.slice(at, end - at)
            at = end
            texts, ids, volumes, numbers = (part.column(c) for c in ("raw_text", "page_id", "volume", "page_no"))
            texts = texts.to_pylist()
            coded = _tokens(texts)
            codes, words = coded.indices.to_numpy().astype(np.int32), coded.dictionary.to_pylist()
            forms, d = Lines(codes, words).counted()
            rows, bodies, owner, lines, pages, sizes = [], [], [], [], [], [0]
            for i, t in enumerate(texts):
                e, l = page_edges(t)
                if l:
                    lines += l
                    sizes.append(len(lines))
                    pages.append(i)
                for x in e:
                    rows.append(x)
                    owner.append(i)
                    bodies.append(x[1] or "")
            keys = folded(bodies) if bodies else []
            edges = pa.StructArray.from_arrays(
                [ids.take(pa.array(owner, pa.int64())), volumes.take(pa.array(owner, pa.int64())), numbers.take(pa.array(owner, pa.int64())), pa.array([x[0] for x in rows], pa.int32()), pa.array([k or None for k in keys], pa.string()), pa.array([x[2] for x in rows], pa.int64()), pa.array([x[3] for x in rows], pa.bool_())],
                names=["page_id", "volume", "page_no", "line_no", "key", "number", "alone"],
            )
            own = pa.array(pages, pa.int64())
            each = pa.StructArray.from_arrays([pa.array([x[k] for x in lines], kind) for k, kind in enumerate(line.values())], names=list(line))
            ends = pa.StructArray.from_arrays([ids.take(own), volumes.take(own), numbers.take(own), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), each)], names=["page_id", "volume", "page_no", "ends"])
            counted = pa.StructArray.from_arrays([pa.array(forms, pa.string()), pa.array(d, pa.int64())], names=["form", "d"])
            kept = _list(part.column("kept"))
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), _list(ids), pa.array([_packed(codes, len(words))], pa.binary()), _list(coded.dictionary), _list(counted), _list(edges), _list(ends), _list(part.column("of")), kept], names=names)


def coded_pages(pages: DataFrame, texts: bool = False) -> DataFrame:
    """The blocks of ``pages`` (columns of ``BLOCK``), written; with their texts only where asked for.

    Pages without a ``pdf_path`` are volumes of one page.
    """
    p = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("pdf_path", F.concat(F.lit("page "), F.col("page_id"))).alias("volume"), F.coalesce(F.col("page_no").cast("int"), F.lit(0)).alias("page_no"),
        F.struct("pdf_path", F.col("page_no").cast("int").alias("page_no")).alias("of"), "raw_text", F.length("raw_text").alias("chars"), (F.col("raw_text") if texts else F.lit(None).cast("string")).alias("kept"),
    )
    return written(p.mapInArrow(_coded, BLOCK), "blocks")


def furniture(blocks: DataFrame) -> DataFrame:
    """(page_id, block, volume, page_no, fur, first, last) of every page with content.

    ``volume``: its hash; ``fur``: (line_no, kind) of running lines and page numbers; ``first`` and ``last``: what is
    needed of the body's outer lines, null where all is furniture. No volume is one group: lines are counted by (volume, line, stretch of pages), volumes and
    lines by their 64-bit hashes; the offset joins in 16 parts of a volume. A volume's offset is the commonest
    difference of printed and counted number; a bare number must fit it.
    """
    e = blocks.select(F.inline("edges")).select("page_id", F.xxhash64("volume").alias("v"), "page_no", "line_no", F.when(F.col("key").isNotNull(), F.xxhash64("key")).alias("k"), "number", "alone")
    e = written(e, "edges")  # read five times
    # lines of text: first those of more than one page of the volume, of them those that come again within a stretch
    keyed = e.where("k IS NOT NULL").select("v", "k", "page_no", "page_id", "line_no")
    two = F.min("page_no").alias("least"), F.max("page_no").alias("most")
    again = keyed.groupBy("v", "k").agg(*two).where("least < most").select("v", "k")
    stretch = F.array(F.floor(F.col("page_no") / APART) * 2, F.floor((F.col("page_no") + APART // 2) / APART) * 2 + 1)  # overlapping, of APART pages
    held = keyed.join(again, ["v", "k"], "left_semi").withColumn("stretch", F.explode(stretch))
    near = held.groupBy("v", "k", "stretch").agg(*two).where("least < most").select("v", "k", "stretch")
    running = held.join(near, ["v", "k", "stretch"], "left_semi").select("page_id", "line_no", F.lit("running").alias("kind"))
    # numbers: alone or beside a line
    numbered = e.where("number IS NOT NULL")
    votes = numbered.groupBy("v", (F.col("number") - F.col("page_no")).alias("off")).agg(F.count("*").alias("n"))
    offset = votes.groupBy("v").agg(F.max(F.struct("n", -F.abs("off"), "off")).alias("o")).where("o.n >= 2").select("v", "o.off", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part"))
    fits = numbered.withColumn("part", F.pmod("page_no", F.lit(16))).join(offset, ["v", "part"]).where("number - page_no = off")
    fits = fits.select("page_id", "line_no", F.when(F.col("alone"), "page_number").otherwise("running").alias("kind"))
    fur = running.unionByName(fits).groupBy("page_id").agg(F.collect_set(F.struct("line_no", "kind")).alias("fur"))  # a line is one kind, both ways
    of = blocks.select("block", F.inline("ends")).select("block", "page_id", F.xxhash64("volume").alias("volume"), "page_no", "ends").join(fur, "page_id", "left")
    of = of.withColumn("ends", F.expr("filter(ends, x -> NOT coalesce(exists(fur, f -> f.line_no = x.line_no), false))"))
    first, last = (F.expr(f"get(ends, {i})") for i in ("0", "size(ends) - 1"))
    first = F.when(first.isNotNull(), F.struct(*(first[c].alias(c) for c in ("token", "rest", "fresh"))))
    last = F.when(last.isNotNull(), F.struct(*(last[c].alias(c) for c in ("tail", "ended"))))
    return of.select("page_id", "block", "volume", "page_no", "fur", first.alias("first"), last.alias("last"))


def beside(rows: DataFrame, before: F.Column, after: F.Column) -> DataFrame:
    """``rows`` (volume, page_no, page_id, ...) with ``prev``, the nearest value of ``before`` above that isn't null, and ``next``, that of ``after`` in the row below.

    Windows cover WINDOW pages; what lies beyond comes from the table of spans, so no volume is sorted as a whole.
    """
    rows = rows.withColumns({"span": F.floor(F.col("page_no") / WINDOW), "up": before, "down": after})
    own, far = Window.partitionBy("volume", "span").orderBy("page_no", "page_id"), Window.partitionBy("volume").orderBy("span")
    last = F.max(F.when(F.col("up").isNotNull(), F.struct("page_no", "page_id", "up")))
    spans = rows.groupBy("volume", "span").agg(last["up"].alias("up"), F.min(F.struct("page_no", "page_id", "down"))["down"].alias("down"))
    above = lambda w: F.last("up", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("volume", "span", above(far).alias("far_prev"), F.lead("down").over(far).alias("far_next")).where("far_prev IS NOT NULL OR far_next IS NOT NULL")
    near = rows.withColumns({"prev": above(own), "next": F.lead("down").over(own)}).drop("up", "down")
    near = near.join(spans, ["volume", "span"], "left")
    return near.withColumns({"prev": F.coalesce("prev", "far_prev"), "next": F.coalesce("next", "far_next")}).drop("span", "far_prev", "far_next")


def page_turns(lines: DataFrame) -> DataFrame:
    """Of the pages of :func:`furniture`: (page_id, block, volume, fur, tail, before, rest, token, after, next_token, runs_on).

    ``tail``: the divided piece at the page's end, and ``after`` and ``next_token`` what the next page goes on with;
    ``before``: the piece at the end of the page before, and ``rest`` and ``token`` how it goes on here. Pages without
    a body are passed over. ``runs_on``: the page begins within a paragraph.
    """
    b = beside(lines.where("first IS NOT NULL"), F.struct(F.col("last")["tail"].alias("tail"), F.col("last")["ended"].alias("ended")), F.struct(F.col("first")["rest"].alias("rest"), F.col("first")["token"].alias("token")))
    cut = F.col("prev")["tail"].isNotNull() & (F.col("first")["rest"] != "")
    on = F.col("last")["tail"].isNotNull() & (F.col("next")["rest"] != "")
    b = b.select(
        "page_id", "block", "volume", "fur", F.col("last")["tail"].alias("tail"), F.when(cut, F.col("prev")["tail"]).alias("before"), F.when(cut, F.col("first")["rest"]).alias("rest"), F.when(cut, F.col("first")["token"]).alias("token"),
        F.when(on, F.col("next")["rest"]).alias("after"), F.when(on, F.col("next")["token"]).alias("next_token"), (F.col("prev").isNotNull() & (cut | ~(F.col("first")["fresh"] | F.col("prev")["ended"]))).alias("runs_on"),
    )
    return b.unionByName(lines.where("first IS NULL").select("page_id", "block", "volume", "fur"), allowMissingColumns=True)


def _over(turns: DataFrame) -> DataFrame:
    """(block, page_id, form): the forms over the pages' ends, on both pages."""
    both = F.array(F.concat("tail", F.coalesce("after", F.lit(""))), F.concat("before", "rest"))
    return turns.select("block", "page_id", F.explode(both).alias("form")).where("form IS NOT NULL")


def repairs(n: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of all distinct forms with their pages ``d``: (form, printed, printed_d, cost) of misread ones and (form) of compounds broken at their own hyphen."""
    plain = n.where(~F.col("form").rlike("[\u0001\u0002]")).select(F.col("form").alias("w"), "d")
    broken = n.where(F.col("form").rlike("[\u0001\u0002]")).select("form", F.regexp_replace("form", "[\u0001\u0002]", "").alias("w"))
    lexicon = plain.where(r"d >= 4 AND NOT w RLIKE '[@|0-9!]'")
    whole = plain.unionByName(broken.select("w").distinct().withColumn("d", F.lit(1))).groupBy("w").agg(F.sum("d").alias("d"))
    suspects = whole.where(r"w RLIKE '[\\p{L}@|]|^0$'")
    index = lexicon.mapInPandas(_emit("printed", index_keys), "key string, printed string, printed_d bigint")
    asked = suspects.mapInPandas(_emit("form", lookups), "key string, form string, form_d bigint")
    odd = F.col("form").rlike(ODD) | F.col("form").rlike("[äö]")
    # both are many times as large as what they're made of, which Spark doesn't know: no broadcast
    met = asked.hint("merge").join(index.hint("merge"), "key").where(F.col("form") != F.col("printed")).where(F.when(odd, F.col("printed_d") > F.col("form_d")).otherwise((F.col("printed_d") >= RATIO * F.col("form_d")) & (F.col("printed_d") >= 5)))
    near = met.select("form", "printed", "printed_d").distinct().withColumn("cost", distance("printed", "form")).where(f"cost <= {MOST}")
    near = written(near, "near")
    return near, _compounds(n, plain, near)


def _compounds(n: DataFrame, plain: DataFrame, near: DataFrame) -> DataFrame:
    hyphen = n.where(F.col("form").contains("\u0001"))
    parts = hyphen.select("form", F.substring_index("form", "\u0001", 1).alias("a"), F.substring_index("form", "\u0001", -1).alias("b"))
    parts = parts.withColumn("ab", F.concat("a", "b")).withColumn("a_b", F.concat_ws("-", "a", "b"))
    known = lambda c: plain.select(F.col("w").alias(c), F.col("d").alias(f"{c}_d"))
    p = parts.join(known("ab"), "ab", "left").join(known("a_b"), "a_b", "left")
    p = p.join(near.select(F.col("form").alias("ab")).distinct().withColumn("misread", F.lit(True)), "ab", "left")
    inline = plain.where("w LIKE '%-%'").groupBy(F.substring_index("w", "-", 1).alias("a")).agg(F.sum("d").alias("a_d"))
    p = p.join(inline, "a", "left")
    d_ab, d_hy = F.coalesce("ab_d", F.lit(0)), F.coalesce("a_b_d", F.lit(0))
    own = (d_hy > 0) & (d_hy >= 0.2 * d_ab)
    clitic = F.col("b").isin(*sorted(CLITICS)) & (d_ab == 0) & F.col("misread").isNull()
    last = (F.col("b") == "") & (F.coalesce("a_d", F.lit(0)) >= 5)  # the volume ends: as the first part mostly goes on
    return p.where(own | clitic | last).select("form").distinct()


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n): how often a stands right before b, of the words b that the block is asked for."""
    for batch in batches:
        for row in range(batch.num_rows):
            words, asked = batch.column("words")[row].as_py(), set(batch.column("need")[row].as_py())
            l = Lines(_unpacked(batch.column("codes")[row].as_py(), len(words)), words)
            form = l.form_of[l.codes]
            page = l.page[l.line_of][form >= 0]
            form = form[form >= 0]
            wanted = np.array([f in asked for f in l.forms], bool)
            at = np.flatnonzero(wanted[form[1:]] & (page[1:] == page[:-1])) + 1 if len(form) else np.zeros(0, int)
            pair, n = np.unique(form[at - 1].astype(np.int64) * max(1, len(l.forms)) + form[at], return_counts=True)
            forms = pa.array(l.forms, pa.string())
            yield pa.RecordBatch.from_arrays([forms.take(pa.array(pair // max(1, len(l.forms)))), forms.take(pa.array(pair % max(1, len(l.forms)))), pa.array(n, pa.int64())], names=["a", "b", "n"])


def choose(near: DataFrame, blocks: DataFrame, hot: DataFrame) -> DataFrame:
    """(form, printed): the repair of each misread form; bigrams with the word before settle several candidates."""
    many = near.groupBy("form").agg(F.count("*").alias("c")).where("c > 1").select("form")
    doubtful = near.join(many, "form").select("form", "printed")
    need = doubtful.select(F.col("form")).union(doubtful.select("printed")).distinct()
    asked = join_words(blocks.select("block", F.explode("forms.form").alias("form")), need, "form", hot).groupBy("block").agg(F.collect_list("form").alias("need"))
    counts = blocks.select("block", "codes", "words").join(asked, "block").select("codes", "words", "need").mapInArrow(_contexts, "a string, b string, n bigint")
    pairs = written(counts.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    before = pairs.join(doubtful.select(F.col("form").alias("b")).distinct(), "b").select(F.col("b").alias("form"), "a")
    support = before.join(doubtful, "form").join(pairs.select("a", F.col("b").alias("printed"), "n"), ["a", "printed"]).groupBy("form", "printed").agg(F.sum("n").alias("support"))
    scored = near.join(support, ["form", "printed"], "left").withColumn("support", F.coalesce("support", F.lit(0)))
    return scored.groupBy("form").agg(F.min_by("printed", F.struct(-F.col("support"), "cost", -F.col("printed_d"), "printed")).alias("printed"))


def misread_parts(a: str, b: str, printed: str) -> tuple[bool, bool]:
    """Whether the wrong letters of ``a + b``, read for ``printed``, lie in a, and in b."""
    joined = a + b
    p = 0
    while p < min(len(joined), len(printed)) and joined[p] == printed[p]:
        p += 1
    q = 0
    while q < min(len(joined), len(printed)) - p and joined[-1 - q] == printed[-1 - q]:
        q += 1
    return p < len(a), len(joined) - q > len(a) + (p < len(a))


def judge(l: Lines, fixes: dict[str, str], compounds: set[str], furniture_lines: dict[tuple[int, int], str], before: dict[int, str], after: dict[int, str]) -> list[tuple[int, int, str]]:
    """(page, line, kind) of a block's lines; pages by their place in the block.

    ``before``: the piece and its mark at the end of the page before, of pages that go on with its rest; ``after``:
    the rest on the next page.
    """
    key = (l.page.astype(np.int64) << 32) + l.line_no
    body = np.ones(len(key), bool)
    if furniture_lines and len(key):
        body[np.searchsorted(key, np.array([(p << 32) + n for p, n in furniture_lines], np.int64))] = False
    lines = np.flatnonzero(body)
    piece, nxt, joined = l.divided(lines)
    skip, wrong, split = np.zeros(len(l.codes), bool), np.zeros(len(key), bool), np.zeros(len(key), bool)

    # words begun on the page before
    for page, a in before.items():
        k = int(np.searchsorted(l.page[lines], page))
        if k < len(lines) and l.page[lines[k]] == page and l.begins[code := l.codes[l.first[i := lines[k]]]]:
            b = l.rest(code)
            skip[l.first[i]] = True
            piece[k] &= l.first[i] != l.last[i]
            wrong[i] |= (printed := fixes.get(a + b)) is not None and misread_parts(a[:-1], b, printed)[1]
    joined &= piece

    # divided words within the page: each pair of tokens is looked up once
    i, j = lines[joined], nxt[joined]
    pairs, inverse = np.unique(l.codes[l.last[i]].astype(np.int64) * max(1, len(l.words)) + l.codes[l.first[j]], return_inverse=True)
    told = np.zeros((len(pairs), 3), bool)
    for k, p in enumerate(pairs.tolist()):
        a, b = l.piece(p // len(l.words)), l.rest(p % len(l.words))
        told[k, 0] = a[-1] == "\u0002" or a + b not in compounds
        if (printed := fixes.get(a + b)) is not None:
            told[k, 1:] = misread_parts(a[:-1], b, printed)
    split[i] = told[inverse, 0]
    wrong[i] |= told[inverse, 1]
    wrong[j] |= told[inverse, 2]
    skip[l.first[j]] = True

    # pieces whose rest stands on the next page, or nowhere
    for i, j in zip(lines[piece & ~joined].tolist(), nxt[piece & ~joined].tolist()):
        a, b = l.piece(l.codes[l.last[i]]), after.get(int(l.page[i]), "") if j < 0 else ""
        split[i] = a[-1] == "\u0002" or a + b not in compounds
        wrong[i] |= b != "" and (printed := fixes.get(a + b)) is not None and misread_parts(a[:-1], b, printed)[0]
    skip[l.last[lines[piece]]] = True

    bad = np.array([f in fixes for f in l.forms] + [False], bool)  # the last for tokens without a form
    hit = bad[l.form_of[l.codes]] & ~skip
    if "0" in fixes and "0" in l.forms:  # a letter only among words
        among = np.bincount(l.line_of, l.letters[l.codes], len(key)) > 2
        hit &= (l.form_of[l.codes] != l.forms.index("0")) | among[l.line_of]
    wrong[l.line_of[hit]] = True
    out = [(p, n, k) for (p, n), k in furniture_lines.items()]
    for own, kind in ((split & body, "split_word"), (wrong & body, "misread")):
        out += [(p, n, kind) for p, n in zip(l.page[own].tolist(), l.line_no[own].tolist())]
    return out


def _told(hits: pa.StructArray | None) -> tuple[dict[str, str], set[str]]:
    """The repairs and the compounds among a block's hits."""
    if hits is None:
        return {}, set()
    forms, printed, own = (hits.field(c).to_pylist() for c in ("form", "printed", "own"))
    return {f: p for f, p in zip(forms, printed) if p is not None}, {f for f, o in zip(forms, own) if o}


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            words, pages, hits, turns = (b.column(c)[row].values for c in ("words", "pages", "hits", "turns"))
            words, pages = words.to_pylist(), pages.to_pylist()
            l = Lines(_unpacked(b.column("codes")[row].as_py(), len(words)), words)
            fixes, own = _told(hits)
            far, before, after = {}, {}, {}
            if turns is not None:
                place = {p: i for i, p in enumerate(pages)}
                at = [place[p] for p in turns.field("page_id").to_pylist()]
                fur = turns.field("fur")
                owner = np.repeat(at, pc.fill_null(pc.list_value_length(fur), 0).to_numpy(zero_copy_only=False)).tolist()
                flat = fur.flatten()
                far = dict(zip(zip(owner, flat.field("line_no").to_pylist()), flat.field("kind").to_pylist()))
                before, after = ({i: x for i, x in zip(at, turns.field(c).to_pylist()) if x} for c in ("before", "after"))
            got = judge(l, fixes, own, far, before, after)
            yield pa.RecordBatch.from_arrays([pa.array([pages[p] for p, _, _ in got], pa.int64()), pa.array([n for _, n, _ in got], pa.int32()), pa.array([k for _, _, k in got], pa.string())], names=["page_id", "line_no", "kind"])


def _prepared(pages: DataFrame, texts: bool = False) -> DataFrame:
    """The blocks with their repairs (``hits``) and the ``turns`` of their pages: codes, or (``texts``) the texts."""
    blocks = coded_pages(pages.where("raw_text IS NOT NULL"), texts)
    turns = written(page_turns(furniture(blocks)), "turns")
    over = _over(turns)
    counts = blocks.select(F.inline("forms")).unionByName(over.select("form", F.lit(1).cast("bigint").alias("d")))
    n = written(counts.groupBy("form").agg(F.sum("d").alias("d"), F.count("*").alias("blocks")), "forms")
    hot = written(often(n, "form", blocks.count()), "hot")
    near, own = repairs(n)
    printed = written(choose(near, blocks, hot), "printed")
    across = n.where(F.col("form").rlike("[\u0001\u0002]")).select("form", F.regexp_replace("form", "[\u0001\u0002]", "").alias("w")).join(printed.withColumnRenamed("form", "w"), "w").select("form", "printed")
    repair = written(printed.unionByName(across).join(own.withColumn("own", F.lit(True)), "form", "full").select("form", "printed", F.coalesce("own", F.lit(False)).alias("own")), "repairs")
    released(n, near, printed)
    held = blocks.select("block", F.explode("forms.form").alias("form")).unionByName(over.select("block", "form"))
    hits = join_words(held, repair, "form", hot).groupBy("block").agg(F.collect_list(F.struct("form", "printed", "own")).alias("hits"))
    if texts:
        turned = turns.groupBy("block").agg(F.collect_list(F.struct("page_id", "fur", "token", "next_token", "runs_on")).alias("turns"))
    else:
        turned = turns.where("fur IS NOT NULL OR before IS NOT NULL OR after IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("page_id", "fur", "before", "after")).alias("turns"))
    return blocks.select("block", "pages", *(("of", "texts") if texts else ("codes", "words"))).join(hits, "block", "left").join(turned, "block", "left")


def noisy_lines(pages: DataFrame) -> DataFrame:
    """(page_id, line_no, kind): ``running``, ``page_number``, ``split_word`` and ``misread`` lines.

    ``page_id`` is unique; null and empty texts give no row. Whole texts are read. Furniture is sought among the first
    ``HEAD`` and last ``FOOT`` lines with content of a page: that is what a header or footer is. A group is a block,
    bounded by ``BLOCK_CHARS`` or a page.
    """
    blocks = _prepared(pages.select("page_id", "pdf_path", "page_no", "raw_text"))
    return blocks.mapInArrow(_judged, "page_id bigint, line_no int, kind string")


def paragraphs(text: str, furniture_lines: dict[int, str], fixes: dict[str, str], compounds: set[str], token: str = "", next_token: str = "") -> list[str]:
    """A page's paragraphs: no furniture, whole words, printed letters; blank lines and indents part paragraphs.

    ``token``: the first word, where it's the rest of one begun on the page before, which has it whole; the first
    paragraph is then given even if nothing else is in it. ``next_token``: the rest of this page's last word.
    """
    lines = page_lines(text)
    body = [i for i, l in enumerate(lines) if i + 1 not in furniture_lines and l.strip()]
    out: list[str] = []
    held = ""
    for k, i in enumerate(body):
        s = lines[i].strip()
        if k and not held and (lines[i].startswith("   ") or i - body[k - 1] > 1 and any(not l.strip() for l in lines[body[k - 1] + 1 : i])):
            out.append("\n")
        if k == 0 and token:
            s = s[len(token) :].lstrip()
        s = held + s
        held = ""
        if len(s) > 1 and s[-1] in MARKS and s[-2].isalnum():
            follow = FOLLOW.match((lines[body[k + 1]].strip() if k + 1 < len(body) else next_token).lower())
            compound = s[-1] == "-" and (tail_of(s) or "") + (follow[0].rstrip(SIGNS) if follow else "") in compounds
            cut = s.rfind(" ") + 1
            out.append(s[:cut].strip())
            held = s[cut:-1] + ("-" if compound else "")
            continue
        out.append(s)
    if held:
        out.append(held + next_token if next_token else held.rstrip("-") + "-")

    among = True  # words, where a 0 may be a letter

    def fix(m: re.Match) -> str:
        w = fixes.get(m[0].lower()) if among or m[0] != "0" else None
        return m[0] if w is None else w.upper() if m[0].isupper() and len(m[0]) > 1 else w.capitalize() if m[0][:1].isupper() else w

    texts = [" ".join(x.split()) for x in " ".join(out).split("\n")]
    low = "\n".join(texts).lower()
    hits = fixes.keys() & set(TOKEN.findall(low))
    for k, p in enumerate(texts if hits else ()):
        if any(h in p.lower() for h in hits):
            among = "0" not in hits or sum(map(str.isalpha, TOKEN.findall(p))) > 2
            texts[k] = TOKEN.sub(fix, p)
    return [p for k, p in enumerate(texts) if p or k == 0 and token]


PIECE = "page_id bigint, pdf_path string, page_no int, volume string, runs_on boolean, texts array<string>"


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            pages, of, texts, hits, turns = (b.column(c)[row].values for c in ("pages", "of", "texts", "hits", "turns"))
            told, own = _told(hits)
            fixes = {f.replace("\u0001", "").replace("\u0002", ""): p for f, p in told.items()}
            ids, paths, numbers = pages.to_pylist(), of.field("pdf_path").to_pylist(), of.field("page_no")
            n = len(ids)
            far, token, after, runs = [{} for _ in ids], [""] * n, [""] * n, [False] * n
            if turns is not None:
                place = {p: i for i, p in enumerate(ids)}
                fur = turns.field("fur").to_pylist()
                for i, f, t, a, on in zip((place[p] for p in turns.field("page_id").to_pylist()), fur, *(turns.field(c).to_pylist() for c in ("token", "next_token", "runs_on"))):
                    far[i], token[i], after[i], runs[i] = {x["line_no"]: x["kind"] for x in f or ()}, t or "", a or "", bool(on)
            got = [paragraphs(t, far[i], fixes, own, token[i], after[i]) for i, t in enumerate(texts.to_pylist())]
            volumes = [f"page {i}" if p is None else p for i, p in zip(ids, paths)]
            yield pa.RecordBatch.from_arrays([pages, of.field("pdf_path"), numbers, pa.array(volumes, pa.string()), pa.array(runs, pa.bool_()), pa.array(got, pa.list_(pa.string()))], names=["page_id", "pdf_path", "page_no", "volume", "runs_on", "texts"])


def _pieces(pages: DataFrame) -> DataFrame:
    """(page_id, pdf_path, page_no, volume, runs_on, texts) of every page with text."""
    pages = pages.where("raw_text IS NOT NULL").select("page_id", "pdf_path", "page_no", "raw_text")
    return _prepared(pages, True).mapInArrow(_paragraphs, PIECE)


def repaired_pages(pages: DataFrame) -> DataFrame:
    """(page_id, pdf_path, page_no, text): every page's text in readable paragraphs; pages without text stay null.

    A word divided over a page's end stands whole on the page where it begins.
    """
    done = _pieces(pages).select("page_id", "pdf_path", "page_no", F.array_join(F.filter("texts", lambda x: x != ""), "\n\n").alias("text"))
    return done.unionByName(pages.where("raw_text IS NULL").select("page_id", "pdf_path", "page_no", F.lit(None).cast("string").alias("text")))


def repaired_volumes(pages: DataFrame) -> DataFrame:
    """(pdf_path, page_no, page_id, pos, text): every volume's paragraphs, which run on over pages.

    A paragraph has the page on which it begins and its place there; by (page_no, page_id, pos) they stand in order.
    Paragraphs within a page stay where they are; only those at a page's edge are brought together, under the page
    on which they begin. A group is one paragraph of the result.
    """
    t = written(_pieces(pages).where("size(texts) > 0"), "pieces")
    page = F.coalesce("page_no", F.lit(0))
    begins = F.when(F.size("texts") > F.col("runs_on").cast("int"), F.struct(F.col("page_no").alias("no"), "page_id", (F.size("texts") - 1).alias("pos")))
    on = beside(t.select("volume", page.alias("page_no"), "page_id", F.col("runs_on"), begins.alias("begins")), F.col("begins"), F.lit(True)).where("runs_on AND prev IS NOT NULL").select("page_id", "prev")
    each = t.select("pdf_path", "page_no", page.alias("page"), "page_id", "runs_on", F.size("texts").alias("n"), F.posexplode("texts").alias("pos", "text"))
    edge = (F.col("pos") == F.col("n") - 1) | (F.col("pos") == 0) & F.col("runs_on")
    inner = each.where(~edge & (F.col("text") != "")).select("pdf_path", "page_no", "page_id", "pos", "text")
    own = F.struct(F.col("page_no").alias("no"), "page_id", "pos")
    outer_ = each.where(edge & (F.col("text") != "")).join(on, "page_id", "left").withColumn("at", F.when(F.col("pos") == 0, F.coalesce("prev", own)).otherwise(own))
    whole = outer_.groupBy("pdf_path", "at").agg(F.sort_array(F.collect_list(F.struct("page", "page_id", "pos", "text"))).alias("parts"))
    whole = whole.select("pdf_path", F.col("at")["no"].alias("page_no"), F.col("at")["page_id"].alias("page_id"), F.col("at")["pos"].alias("pos"), F.array_join(F.col("parts")["text"], " ").alias("text"))
    return whole.unionByName(inner)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy_lines(spread(table(spark, sf_dir, "pdf_pages")))


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_pages(spread(table(spark, sf_dir, "pdf_pages")))


def p1_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_volumes(spread(table(spark, sf_dir, "pdf_pages")))


def queries() -> dict:
    return {"p1_found": p1_found, "p1_repaired": p1_repaired, "p1_volumes": p1_volumes}


def oracle_sql() -> dict[str, str]:
    return {}
