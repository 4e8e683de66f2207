"""Rules as data: page classes, candidate scores and settings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions.text import SPACE

# Parts of addresses that never lead to a file.
IGNORED = ["bitstream-request-a-copy", "file-download-link", "item.edit.bitstreams", "item.page.filesection", "statistics.table", "submission.sections"]
# Phrases of restricted, guarded, missing and failing pages.
RESTRICTED = ["tipo de acesso: acesso embargado", "acesso embargado", "restricted access", "arquivo restrito", "acesso restrito"]
ANTI_BOT = {
    "A": ["client verifying", "checking your browser", "verify you are human", "verificando conexão", "captcha"],
    "B": ["client verifying", "safeline waf", "checking your browser", "captcha", "verificação de segurança", "verificacao de seguranca", "security detection"],
}
NOT_FOUND = ["404 not found", "page not found", "página não encontrada"]
UNAVAILABLE = ["service unavailable", "cannot connect to server"]
TERMINAL = ["restricted_or_embargo", "anti_bot"]
# Words that mean yes.
TRUE_WORDS = ["1", "true", "yes", "y", "sim"]


def any_of(text: Column, phrases: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def page_class(title: Column, body: Column, variant: str) -> Column:
    """Reason why a page can't be read further, null for an ordinary page; null texts count as empty."""
    low = F.lower(F.coalesce(body, F.lit("")))
    both = F.lower(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))))
    if variant == "A":
        return F.when(any_of(low, RESTRICTED), "restricted_or_embargo").when(any_of(low, ANTI_BOT["A"]), "anti_bot")
    return (
        F.when(any_of(both, ANTI_BOT["B"]), "anti_bot").when(any_of(low, RESTRICTED), "restricted_or_embargo")
        .when(any_of(both, NOT_FOUND), "not_found").when(any_of(both, UNAVAILABLE), "repository_unavailable")
    )


def invalid_candidate(url: Column) -> Column:
    return any_of(F.lower(url), IGNORED)


def score_a(url: Column) -> Column:
    """Variant A: hints add up; empty, null and ignored addresses score -100."""
    low = F.lower(url)
    # Hints and their weights.
    parts = [(".pdf", 50), ("/bitstream/", 30), ("/bitstreams/", 30), ("/download", 15), ("/content", 15)]
    total = reduce(lambda a, b: a + b, [F.when(F.contains(low, F.lit(p)), n).otherwise(0) for p, n in parts])
    return F.when(url.isNull() | (url == "") | invalid_candidate(url), -100).otherwise(total)


def score_b(url: Column, text: Column) -> Column:
    """Variant B: either bitstream form counts once, and the link's text counts; other schemes score -100."""
    low, said = F.lower(url), F.lower(F.coalesce(text, F.lit("")))
    # The weights 40, 30, 20 and 15 of the hints, -100 of what leads nowhere.
    bit = F.contains(low, F.lit("/bitstream/")) | F.contains(low, F.lit("/bitstreams/"))
    total = F.when(F.contains(low, F.lit(".pdf")), 40).otherwise(0) + F.when(bit, 30).otherwise(0) + F.when(F.contains(low, F.lit("download")), 20).otherwise(0) + F.when(any_of(said, ["pdf", "texto completo"]), 15).otherwise(0)
    http = F.coalesce(low.rlike("^https?://"), F.lit(False))
    return F.when(~http | any_of(low, IGNORED) | any_of(said, IGNORED), -100).otherwise(total)


def _stripped(value: Column) -> Column:
    return F.regexp_replace(value, rf"^{SPACE}|{SPACE}$", "")


def bool_setting(value: Column, default: bool) -> Column:
    """Null gives the default; any word that isn't a known yes is false."""
    return F.coalesce(F.lower(_stripped(value)).isin(TRUE_WORDS), F.lit(default))


def int_setting(value: Column, default: int) -> Column:
    """Null and what is no whole number of 32 bits give the default; single underlines may part digits."""
    v = _stripped(value)
    return F.coalesce(F.when(v.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(v, F.lit("_"), F.lit("")).try_cast("int")), F.lit(default))
