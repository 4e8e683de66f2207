"""Address expressions: building, resolving, splitting and testing."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import LINE_END

# How a PDF begins, and the patterns of addresses.
PDF_MAGIC = b"%PDF"
HTTP = r"^https?://"
IN_LINE = r"https?://\S+"
IN_HTML = r"https?://[^\s\"'<>]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def search_url(site: str, query: Column | str, page: Column | str) -> Column:
    """Address of a page of results; the query is form encoded."""
    q = F.replace(F.replace(F.url_encode(_c(query)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(f"{site}/vufind/Search/Results?lookfor="), q, F.lit("&type=AllFields&page="), _c(page).cast("string"))


def resolve(base: Column | str, href: Column | str) -> Column:
    """``href`` against ``base`` for addresses without dot segments; :func:`resolve_full` does all of them."""
    b, h = _c(base), _c(href)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    site = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(b, r"^([^?#]*)", 1)
    folder = F.when(F.length(path) == F.length(site), F.concat(site, F.lit("/"))).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    return (
        F.when(h == "", b)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | ~b.rlike(r"(?i)^(?:https?|ftp)://"), h)  # nothing is relative to other schemes
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(site, h))
        .when(h.startswith("?"), F.concat(path, h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, r"^([^#]*)", 1), h))
        .otherwise(F.concat(folder, h))
    )


@F.pandas_udf(T.StringType())
def resolve_full(base: pd.Series, href: pd.Series) -> pd.Series:
    """``href`` against ``base`` by RFC 3986; null where either is null or can't be parsed."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


def split_access_urls(value: Column | str) -> Column:
    """Addresses that make up a line each, in order, each once; null gives none. JSON lists count as lines."""
    v = _c(value)
    lines = F.coalesce(F.from_json(v, "array<string>"), F.split(v, LINE_END))
    kept = F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"^(?U)\s+|(?U)\s+$", ""))), lambda x: x.rlike(HTTP))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def inline_urls(value: Column | str) -> Column:
    """Addresses anywhere in the lines, in order, each once; null gives none."""
    return F.coalesce(F.array_distinct(F.regexp_extract_all(_c(value), F.lit(IN_LINE), F.lit(0))), F.array().cast("array<string>"))


def html_urls(html: Column | str) -> Column:
    """Bare addresses in HTML, in order, with the entity of the ampersand repaired."""
    return F.transform(F.regexp_extract_all(_c(html), F.lit(IN_HTML), F.lit(0)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))


def alternatives(url: Column | str) -> Column:
    """The address and, for http, its https twin."""
    u = _c(url)
    return F.array_compact(F.array(u, F.when(u.startswith("http://"), F.concat(F.lit("https://"), F.substring(u, 8, 1 << 30)))))


def direct_pdf(url: Column | str, variant: str = "B") -> Column:
    """Whether an address names a PDF: by its path's end (B), or '.pdf' anywhere (A)."""
    low = F.lower(_c(url))
    return low.contains(".pdf") if variant == "A" else F.substring_index(F.substring_index(low, "?", 1), "#", 1).endswith(".pdf")


def is_pdf(content: Column | str, content_type: Column | str | None = None, strict: bool = False) -> Column:
    """Content that begins as a PDF, or (not ``strict``) is called one by its type; null content counts as empty."""
    begins = F.coalesce(_c(content).startswith(F.lit(PDF_MAGIC)), F.lit(False))
    if strict or content_type is None:
        return begins
    return begins | F.contains(F.lower(F.coalesce(_c(content_type), F.lit(""))), F.lit("application/pdf"))
