"""Variant spellings of the names of bodies: which stored names mean the same one.

Only distinct stored names travel; the rows are aggregated to them first.

1. A name is read: acronym beside it, words put back in order ("X, Universidade de"), kind of body (full, shortened,
   misspelt or English) and the rest in normal form. Names of one field, kind and rest are one *form*.
2. Misspelt rests: every form is cut into ``2k+1`` segments and indexed by (field, kind, its size, segment's number,
   segment); every form looks up, for each size within ``k``, its substrings at positions shifted by at most ``k``.
   k edits, of which a swap of neighbours may touch two segments, leave one segment whole, so no pair is missed.
   A banded edit distance verifies. The form of more rows is the sound one: of twice as many, or of no fewer and more
   spellings. Two edits need four times as many and the same first letter (geologia isn't ecologia). The nearest
   sound form wins, and is followed to the end of its own chain.
3. Shortened rests ("Dire. Civil") meet full ones by their initials, verified word by word.
4. A bare acronym goes to the form that names it, or whose initials it is, where that is one form only.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.canonical import MOJIBAKE
from lavra.session import table, written

FIELDS = ("institution", "graduate_program", "department")
EDITS = 2
ROWS = {1: 2, 2: 4}  # a sound form stands in so many times the rows of one misspelt by so many edits, at least

# Kinds of bodies and the words that name them, without joining words.
KINDS = {
    "universidade federal": ["universidade federal", "federal", "federal university"],
    "universidade estadual": ["universidade estadual", "estadual", "state university"],
    "universidade catolica": ["universidade catolica", "catolica", "catholic university"],
    "universidade municipal": ["universidade municipal", "municipal university"],
    "universidade tecnologica": ["universidade tecnologica", "technological university"],
    "centro universitario": ["centro universitario", "university center", "university centre"],
    "escola superior": ["escola superior", "higher school"],
    "instituto superior": ["instituto superior", "higher institute"],
    "instituto federal": ["instituto federal", "federal institute"],
    "fundacao universitaria": ["fundacao universitaria", "university foundation"],
    "faculdade direito": ["faculdade direito", "law school"],
    "faculdade medicina": ["faculdade medicina", "medical school"],
    "programa": ["programa pos graduacao", "programa pos graduacao stricto sensu", "prog pos grad", "pos graduacao", "pos graduacao stricto sensu", "ppg", "p p g", "graduate program"],
    "departamento": ["departamento", "depto", "dpto", "dept", "dep", "department"],
}
# Words that tell an English name of a kind, which nobody shortens.
ENGLISH = {"university", "school", "institute", "foundation", "program", "department"}
# Words that only join others.
JOINING = {"de", "da", "do", "das", "dos", "em", "of", "the", "in", "d"}
ACRONYM = r"[A-ZÇ]{3,9}"
AROUND = (re.compile(rf"^({ACRONYM}) ?[-–—:] ?(.+)$"), re.compile(rf"^(.+?) ?[-–—] ?({ACRONYM})$"), re.compile(rf"^(.+?) ?\(({ACRONYM})\)$"))
WORD = re.compile(r"-?[^\W_]+\.?")


def plain(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))


def banded(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b, or ``most + 1`` where there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    far = most + 1
    two: list[int] = []
    one = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        row = [far] * (len(b) + 1)
        if i <= most:
            row[0] = i
        for j in range(lo, hi + 1):
            y = b[j - 1]
            v = min(one[j - 1] + (x != y), one[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row[j] = v if v < far else far
        if min(row) >= far:
            return far
        two, one = one, row
    return one[len(b)]


def _fits(word: str, token: str, shortened: bool, inner: bool) -> int | None:
    """Cost of reading a token as a word of a kind, null where it can't be; inner: a short word between others."""
    if token.rstrip(".") == word:
        return 0
    if shortened and token.endswith(".") and word.startswith(token[:-1]):
        return 1
    most = 2 if len(word) > 5 else 1
    if (len(token) >= 5 or inner and len(token) > 1) and (d := banded(token.rstrip("."), word, most)) <= most:
        return 1 + d
    return None


@lru_cache(maxsize=4096)
def _kind(tokens: tuple[str, ...], field: str) -> tuple[str, int] | None:
    """The kind that the first tokens name and the number of tokens it takes."""
    best = None
    for kind, ways in KINDS.items():
        for way in ways:
            words, at, cost = way.split(), 0, 0
            shortened = not ENGLISH & set(words)
            for k, w in enumerate(words):
                while at < len(tokens) and at and tokens[at] in JOINING:
                    at += 1
                c = _fits(w, tokens[at], shortened, 0 < k < len(words) - 1) if at < len(tokens) else None
                if c is None:
                    break
                at, cost = at + 1, cost + c
            else:
                # more words first, then fewer repairs; a single short word only where something follows
                if at < len(tokens) or field != "institution":
                    rank = (len(words), -cost)
                    if best is None or rank > best[0]:
                        best = (rank, kind, at)
    return best and (best[1], best[2])


def read_name(name: str, field: str) -> tuple[str, str, str, str, bool]:
    """(kind, rest, rest with its joining words, acronym, whether words of the rest are shortened)."""
    for bad, good in MOJIBAKE.items():
        name = name.replace(bad, good)
    s = " ".join(name.replace("&", " e ").replace("/", " e ").split()).strip(" ;,*\"'[]")
    s = re.sub(r"\.$", "", s) if not re.search(r"\b\w{1,4}\.$", s) or field == "institution" else s
    acronym = ""
    if re.fullmatch(ACRONYM, s) and s != "PPG":
        return "", "", "", s, False
    for k, p in enumerate(AROUND):
        if m := p.match(s):
            a, body = (m[1], m[2]) if k == 0 else (m[2], m[1])
            if a == "PPG":
                s = f"PPG em {body}"
            elif not (s.isupper() and k < 2 and " " not in body):
                acronym, s = a, body
            break
    s = plain(s)
    for p in (r"^(.+?) ?\((.+?)\)$", r"^(.+), ?(.+)$"):
        if m := re.match(p, s):
            turned = tuple(t.lstrip("-") for t in WORD.findall(m[2]))
            got = _kind(turned + ("x",), field)
            if got and all(t in JOINING for t in turned[got[1]:]):
                s = f"{m[2]} {m[1]}"
                break
    tokens = tuple(WORD.findall(s))
    got = _kind(tuple(t.lstrip("-") for t in tokens[:9]), field)
    kind, at = got or ("", 0)
    rest = []
    for t in tokens[at:]:  # a compound is one word
        if t.startswith("-") and rest:
            rest[-1] += t
        else:
            rest.append(t.lstrip("-"))
    while rest and rest[0] in JOINING:
        rest = rest[1:]
    if field != "institution":  # parts joined by "and" stand in any order
        parts = [[]]
        for t in rest:
            parts.append([]) if t == "e" else parts[-1].append(t)
        rest = [t for p in sorted(p for p in parts if p) for t in [*p, "e"]][:-1]
    short = any(t.endswith(".") for t in rest)
    full = " ".join(t.rstrip(".") if not short else t for t in rest)
    return kind, " ".join(t.replace("-", " ") for t in full.split() if t not in JOINING), full, acronym, short


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [read_name(n, f) for n, f in zip(b["name"], b["field"])]
        out = pd.DataFrame(got, columns=["kind", "rest", "full", "acr", "short"])
        yield pd.concat([b[["field", "name", "n"]].reset_index(drop=True), out], axis=1)


@F.pandas_udf(T.IntegerType())
def edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([banded(x, y, EDITS) for x, y in zip(a, b)], dtype="int32")


@F.pandas_udf(T.BooleanType())
def shortens(short: pd.Series, full: pd.Series) -> pd.Series:
    """Whether each word equals, or where it ends in a full stop begins, the word at its place."""

    def one(a: str, b: str) -> bool:
        x, y = a.split(), b.split()
        return len(x) == len(y) and all(q.startswith(p[:-1]) if p.endswith(".") else p == q for p, q in zip(x, y))

    return pd.Series([one(a, b) for a, b in zip(short, full)], dtype=bool)


def _initials(column: str) -> F.Column:
    return F.array_join(F.transform(F.split(column, " "), lambda w: F.substring(w, 1, 1)), "")


def name_classes(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(``field``, ``name``, ``n``, ``body``): every distinct stored name with its number of rows and its body.

    Null and blank values name no body and give no row; names are compared as stored, blanks included. ``body`` is
    the normal form of the class. Names that can't be read share a body only with names of equal normal form.
    Repeated rows count in ``n``; other columns are ignored; an empty table gives no rows.
    """
    stack = f"stack({len(fields)}, " + ", ".join(f"'{f}', `{f}`" for f in fields) + ") AS (field, name)"
    names = records.selectExpr(stack).where("name RLIKE '(?U)\\\\S'").groupBy("field", "name").agg(F.count("*").alias("n"))
    read = written(names.mapInPandas(_read, "field string, name string, n bigint, kind string, rest string, full string, acr string, short boolean"), "names")
    named = read.where("rest <> '' AND NOT short")
    forms = named.groupBy("field", "kind", "rest").agg(F.count("*").alias("ways"), F.sum("n").alias("n"), F.min("full").alias("full"))

    # misspelt forms
    cut = 2 * EDITS + 1
    def cuts(size: str) -> str:
        """Place and length of segment ``i`` of a name of that size."""
        base, more = f"int({size} / {cut})", f"{size} % {cut}"
        return f"struct(int(i * {base} + least(i, {more})) AS at, int({base} + int(i < {more})) AS l)"

    places = F.explode(F.sequence(F.lit(0), F.lit(cut - 1)))
    sound = (
        forms.withColumn("size", F.length("rest")).withColumn("i", places).withColumn("c", F.expr(cuts("size"))).where("c.l > 0")
        .selectExpr("field", "kind", "size", "i", "substring(rest, c.at + 1, c.l) AS seg", "rest AS to", "ways AS to_ways", "n AS to_n")
    )
    # each form as a name of any size within reach, with each segment where it may have been shifted to
    shifted = lambda c: F.explode(F.sequence(F.expr(c) - EDITS, F.expr(c) + EDITS))
    looked = (
        forms.where("length(rest) > 3")
        .withColumn("turned", F.explode(F.expr("array_distinct(array(rest, array_join(reverse(split(rest, ' e ')), ' e ')))")))
        .withColumn("size", shifted("length(rest)")).withColumn("i", places).withColumn("c", F.expr(cuts("size"))).where("c.l > 0")
        .withColumn("p", shifted("c.at")).where("p >= 0 AND p + c.l <= length(rest)")
        .selectExpr("field", "kind", "size", "i", "substring(turned, p + 1, c.l) AS seg", "rest", "turned", "ways", "n").distinct()
    )
    near = (
        looked.hint("merge").join(sound.hint("merge"), ["field", "kind", "size", "i", "seg"])  # larger than Spark thinks: no broadcast
        .where(f"rest <> to AND (to_n >= {ROWS[1]} * n OR to_n >= n AND to_ways > ways)")
        .select("field", "kind", "rest", "turned", "n", "to", "to_ways", "to_n").distinct()
        .withColumn("d", edits("turned", "to")).where(f"d <= {EDITS} AND d <= length(rest) / 4")
        .where(f"d <= 1 OR to_n >= {ROWS[2]} * n AND left(turned, 1) = left(to, 1)")
        .groupBy("field", "kind", "rest").agg(F.min_by("to", F.struct("d", -F.col("to_ways"), -F.col("to_n"), "to")).alias("to"))
    )
    target = written(near, "near")
    while True:  # each step of a chain has more rows, or as many and more spellings, so it ends
        step = target.select("field", "kind", F.col("rest").alias("to"), F.col("to").alias("last"))
        on = target.join(step, ["field", "kind", "to"], "left").select("field", "kind", "rest", F.coalesce("last", "to").alias("to"), F.col("last").isNotNull().alias("moved"))
        if on.where("moved").isEmpty():
            break
        target = written(on.drop("moved"), "near")
    rooted = forms.join(target, ["field", "kind", "rest"], "left").withColumn("root", F.coalesce("to", "rest"))
    bodies = written(rooted.select("field", "kind", "rest", "full", "ways", "n", "root"), "bodies")
    body = F.concat_ws("|", "kind", "root")
    roots = bodies.where("rest = root")

    # shortened forms
    full = roots.select("field", "kind", F.col("full").alias("full_to"), "root", F.col("n").alias("n_to"), _initials("full").alias("key"))
    short = read.where("rest <> '' AND short").select("field", "kind", "rest", "full").distinct().withColumn("key", _initials("full"))
    told = (
        short.join(full, ["field", "kind", "key"]).where(shortens("full", "full_to"))
        .groupBy("field", "kind", "rest").agg(F.max_by("root", F.struct("n_to", "root")).alias("root"))
    )

    # bare acronyms
    known = read.where("acr <> '' AND rest <> ''").join(bodies.select("field", "kind", "rest", "root"), ["field", "kind", "rest"]).groupBy("field", "acr", body.alias("body")).agg(F.count("*").alias("ways"))
    guess = roots.where("kind = 'programa'").select("field", F.concat(F.lit("PPG"), F.upper(F.array_join(F.transform(F.filter(F.split("rest", " "), lambda w: w != "e"), lambda w: F.substring(w, 1, 1)), ""))).alias("acr"), body.alias("body"))
    one = known.groupBy("field", "acr").agg(F.count("*").alias("bodies"), F.min("body").alias("body")).where("bodies = 1").select("field", "acr", "body")
    two = guess.join(known.select("field", "acr").distinct(), ["field", "acr"], "left_anti").join(one.select("field", "body"), ["field", "body"], "left_anti")
    two = two.groupBy("field", "acr").agg(F.count("*").alias("bodies"), F.min("body").alias("body")).where("bodies = 1").select("field", "acr", "body")
    spelt = one.unionByName(two)

    a = read.where("rest <> '' AND NOT short").join(bodies, ["field", "kind", "rest"]).select("field", "name", read["n"], body.alias("body"))
    b = read.where("rest <> '' AND short").join(told, ["field", "kind", "rest"], "left").select("field", "name", "n", F.concat_ws("|", "kind", F.coalesce("root", "rest")).alias("body"))
    c = read.where("rest = ''").join(spelt, ["field", "acr"], "left").select("field", "name", "n", F.coalesce("body", F.concat(F.lit("|"), F.when(F.col("acr") != "", F.col("acr")).otherwise(F.col("name")))).alias("body"))
    return a.unionByName(b).unionByName(c)


def linked_pairs(classes: DataFrame) -> DataFrame:
    """(``field``, ``name_a``, ``name_b``): all pairs of names of one body, ``name_a`` before ``name_b`` by code point.

    A body's names are its spellings, which don't grow with the rows, so the pairs stay few.
    """
    a = classes.select("field", "body", F.col("name").alias("name_a"))
    b = classes.select("field", "body", F.col("name").alias("name_b"))
    return a.join(b, ["field", "body"]).where("name_a < name_b").select("field", "name_a", "name_b")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_pairs(written(name_classes(table(spark, sf_dir, "records")), "classes"))


def p4_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_classes(table(spark, sf_dir, "records"))


def queries() -> dict:
    return {"p4_found": p4_found, "p4_bodies": p4_bodies}


def oracle_sql() -> dict[str, str]:
    return {}
