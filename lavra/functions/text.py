"""Text expressions: white space, lines, sections and labelled fields. All stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as the harvested metadata defines them.
SPACE = r"(?U)[\s\x1C-\x1F]+"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029]"
SECTION_START, SECTION_END = "detalhes bibliográficos", "metadados do item"

# Labels of the record page by field, as the catalogue prints them.
LABELS = {
    "year": ["Ano de defesa", "Ano de publicação"],
    "author": ["Autor(a) principal", "Autor principal", "Autor(a)", "Autor"],
    "advisor": ["Orientador(a)", "Orientador"],
    "document_type": ["Tipo de documento"],
    "access_type": ["Tipo de acesso"],
    "language": ["Idioma"],
    "institution": ["Instituição de defesa", "Instituição"],
    "graduate_program": ["Programa de Pós-Graduação"],
    "department": ["Departamento"],
    "country": ["País"],
    "access_url": ["Link de acesso"],
    "abstract": ["Resumo"],
}


def normalize_space(c: Column | str) -> Column:
    """White space runs become one blank, none at the ends; null and nothing left give null."""
    return F.nullif(F.trim(F.regexp_replace(c, SPACE, " ")), F.lit(""))


def body_lines(c: Column | str) -> Column:
    """The normalised lines with content; null stays null."""
    return F.filter(F.transform(F.split(c, LINE_END), normalize_space), lambda x: x.isNotNull())


def section(lines: Column, start: str = SECTION_START, end: str = SECTION_END) -> Column:
    """Lines after the first ``start`` up to the next ``end`` or the last; no start gives no lines."""
    low = F.transform(lines, F.lower)
    at = F.array_position(low, start)
    after = F.slice(lines, at + F.lit(1), F.greatest(F.size(lines), F.lit(1)))
    to = F.array_position(F.transform(after, F.lower), end)
    return F.when(F.coalesce(at, F.lit(0)) == 0, F.array().cast("array<string>")).when(to > 0, F.slice(after, F.lit(1), F.greatest(to - 1, F.lit(0)))).otherwise(after)


def label_pattern(labels: list[str]) -> str:
    return "(?iu)^(?:" + "|".join(re.escape(x).replace("\\ ", " ") for x in labels) + r")\s*:\s*(.*)$"


def labelled_field(lines: Column, labels: list[str]) -> Column:
    """Value behind the first label, or the line after a bare label whatever it says; null where neither is there."""
    p = label_pattern(labels)

    def hit(x: Column, i: Column) -> Column:
        v = F.when(x.rlike(p), F.regexp_extract(x, p, 1))
        return F.when(v == "", F.try_element_at(lines, i + 2)).otherwise(v)

    return F.try_element_at(F.filter(F.transform(lines, hit), lambda x: x.isNotNull()), F.lit(1))


def labelled_pairs(lines: Column, labels: dict[str, list[str]] | None = None) -> Column:
    """array<struct<label,value>> of all labelled lines: each normalised line is cut at its first colon, whatever the number of fields."""
    every = [x.lower() for xs in (labels or LABELS).values() for x in xs]

    def pair(x: Column, i: Column) -> Column:
        head = F.substring_index(x, ":", 1)  # no label holds a colon
        v = F.ltrim(F.substring(x, F.length(head) + 2, F.length(x)))
        label = F.lower(F.rtrim(head))
        return F.when(x.contains(":") & label.isin(every), F.struct(label.alias("label"), F.when(v == "", F.try_element_at(lines, i + 2)).otherwise(v).alias("value")))

    return F.filter(F.transform(lines, pair), lambda q: q["value"].isNotNull())


def field_of(pairs: Column, labels: list[str]) -> Column:
    """The first value under one of the labels."""
    return F.try_element_at(F.filter(pairs, lambda q: q["label"].isin([x.lower() for x in labels])), F.lit(1))["value"]


def record_id(url: Column | str) -> Column:
    """Last segment of the address without slashes at its end; query and fragment stay."""
    return F.substring_index(F.rtrim(F.col(url) if isinstance(url, str) else url, F.lit("/")), "/", -1)
