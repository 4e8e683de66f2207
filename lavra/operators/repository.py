"""What becomes of a repository address: both strategies over recorded responses, page visits and interface replies.

Inputs, each an ordinary table:

* ``addresses`` (id, url): what is to be tried, each row by itself;
* ``existing`` (id, path): outputs that are there already;
* ``responses`` (url, attempt, channel, status, content_type, body): recorded downloads;
* ``visits`` (url, ok, page_url, title, body, html): recorded page openings; an address without one can't be opened;
* ``files`` (item, pos, file_pos, bitstream): the PDF files of repository items (see ``sources.dspace``).

Every strategy is computed once for each distinct address and joined back; the first that applies decides. The result
of a row has (success, reason, source_url, pdf_url, path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.rules import page_class
from lavra.functions.urls import alternatives, direct_pdf, html_urls, is_pdf, resolve_full
from lavra.operators.attempts import CHANNELS, result
from lavra.operators.candidates import TRIED, candidates_a, candidates_b, ranked
from lavra.sources.dspace import item_uuid
from lavra.sources.html import read_page

# Fixed value: where the interface has a file's content.
CONTENT = "/server/api/core/bitstreams/"


def accepted(responses: DataFrame, most: int = 2) -> DataFrame:
    """(url, channel, attempt) of the first accepted attempt of each channel: below 400 and a PDF, among ``most``."""
    good = (F.col("status") < 400) & is_pdf("body", "content_type") & (F.col("attempt") <= most)
    return responses.where(good).groupBy("url", "channel").agg(F.min("attempt").alias("attempt"))


def downloads(urls: DataFrame, responses: DataFrame, most: int = 2) -> DataFrame:
    """(url, success, reason, pdf_url, channel): for each address and its https twin, the channels in their order.

    The first (alternative, channel) with an accepted response counts; addresses without one have ``not_pdf``.
    """
    tries = urls.select("url").distinct().select("url", F.posexplode(alternatives("url")).alias("alt", "pdf_url"))
    place = F.array_position(F.array(*map(F.lit, CHANNELS)), F.col("channel"))
    got = tries.join(accepted(responses, most).withColumnRenamed("url", "pdf_url"), "pdf_url").where(place > 0)
    best = got.groupBy("url").agg(F.min(F.struct("alt", place.alias("place"), "pdf_url", "channel")).alias("b"))
    out = urls.select("url").distinct().join(best, "url", "left")
    return out.select("url", F.col("b").isNotNull().alias("success"), F.when(F.col("b").isNull(), "not_pdf").alias("reason"), "b.pdf_url", "b.channel")


def page_candidates_a(visits: DataFrame) -> DataFrame:
    """(page, url, score) of what opened pages refer to, resolved against the page; each address once."""
    refs = visits.where("ok").select(F.col("url").alias("page"), "page_url", read_page("html").alias("p")).select("page", "page_url", F.explode("p.refs").alias("r"))
    return candidates_a(refs.select("page", resolve_full("page_url", "r.url").alias("url")), "page")


def page_candidates_b(visits: DataFrame) -> DataFrame:
    """(page, url, score, first): anchors with their text, resolved, then the bare addresses in the HTML."""
    p = visits.where("ok").select(F.col("url").alias("page"), "page_url", "html", read_page("html").alias("p"))
    linked = p.select("page", "page_url", F.explode("p.anchors").alias("a")).where("a.url <> ''").select("page", F.lit(0).alias("src"), "a.pos", resolve_full("page_url", "a.url").alias("url"), "a.text")
    bare = p.select("page", F.posexplode(html_urls("html")).alias("pos", "url")).select("page", F.lit(1).alias("src"), "pos", "url", F.lit("").alias("text"))
    return candidates_b(linked.unionByName(bare), "page")


def item_files(urls: DataFrame, files: DataFrame, responses: DataFrame, most: int = 2) -> DataFrame:
    """(url, pdf_url): of addresses that name an item, the first file in order that downloads."""
    site = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    items = urls.select("url").distinct().withColumn("item", item_uuid("url")).where("item IS NOT NULL").withColumn("site", site)
    offered = items.join(files, "item").withColumn("pdf_url", F.concat("site", F.lit(CONTENT), "bitstream", F.lit("/content")))
    got = accepted(responses.where("channel = 'requests'"), most).select(F.col("url").alias("pdf_url"))
    return offered.join(got, "pdf_url", "left_semi").groupBy("url").agg(F.min(F.struct("pos", "file_pos", "pdf_url")).alias("f")).select("url", F.col("f.pdf_url").alias("pdf_url"))


def _with_outputs(addresses: DataFrame, existing: DataFrame, urls: DataFrame, success: Column, reason: Column, pdf_url: Column, folder: str, reason_there: str | None) -> DataFrame:
    """The result of every row: an output that is there comes before all strategies."""
    there = existing.groupBy("id").agg(F.min("path").alias("there"))
    a = addresses.join(there, "id", "left").join(urls, "url", "left")
    old = F.col("there").isNotNull()
    path = F.when(old, F.col("there")).when(success, F.concat(F.lit(folder.rstrip("/") + "/"), "id", F.lit(".pdf")))
    r = result(old | success, F.when(old, F.lit(reason_there)).otherwise(reason), F.col("url"), F.when(~old, pdf_url), path)
    return a.select("id", r.alias("r")).select("id", "r.*")


def repository_results_a(addresses: DataFrame, existing: DataFrame, responses: DataFrame, visits: DataFrame, folder: str = "data/raw/pdf", most: int = 2) -> DataFrame:
    """(id, success, reason, source_url, pdf_url, path) by the first strategy of: there already; an address with .pdf
    that downloads; a page that can't be opened; a special page; the best candidate that downloads; nothing found.

    Candidates of equal score are tried in order of their addresses. Visits of one address twice count once.
    """
    got = accepted(responses, most).where(F.col("channel").isin(*CHANNELS)).select("url").distinct()
    urls = addresses.select("url").distinct()
    visits = visits.dropDuplicates(["url"]).join(urls, "url", "left_semi")
    direct = urls.where(direct_pdf("url", "A")).join(got, "url", "left_semi").select("url", F.lit(True).alias("direct"))
    opened = visits.select("url", "ok", page_class(F.lit(""), F.col("body"), "A").alias("special"))
    found = page_candidates_a(visits).join(got, "url", "left_semi").groupBy("page").agg(F.min(F.struct(-F.col("score"), "url"))["url"].alias("found")).withColumnRenamed("page", "url")
    u = urls.join(direct, "url", "left").join(opened, "url", "left").join(found, "url", "left")
    direct_, ok = F.coalesce("direct", F.lit(False)), F.coalesce("ok", F.lit(False))
    by_page = ok & F.col("special").isNull() & F.col("found").isNotNull()
    reason = F.when(direct_, F.lit(None)).when(~ok, "repository_unavailable").when(F.col("special").isNotNull(), F.col("special")).when(F.col("found").isNull(), "pdf_not_found")
    return _with_outputs(addresses, existing, u, direct_ | by_page, reason, F.when(direct_, F.col("url")).when(by_page, F.col("found")), folder, "already_exists")


def repository_results_b(addresses: DataFrame, existing: DataFrame, responses: DataFrame, visits: DataFrame, files: DataFrame, folder: str = "data/raw/pdf", most: int = 2) -> DataFrame:
    """(id, success, reason, source_url, pdf_url, path) by the first strategy of: there already; a path that ends in
    .pdf and downloads; the item's files; a page that neither the address nor its https twin opens; a special page;
    the files of the item that the page names; the first of ``TRIED`` candidates that downloads; nothing found.
    """
    urls = addresses.select("url").distinct()
    direct = downloads(urls.where(direct_pdf("url")), responses, most).where("success").select("url", F.col("pdf_url").alias("direct"))
    item = item_files(urls, files, responses, most).withColumnRenamed("pdf_url", "item_file")
    tries = urls.select("url", F.posexplode(alternatives("url")).alias("alt", "at"))
    v = visits.dropDuplicates(["url"])
    opened = tries.join(v.where("ok").select(F.col("url").alias("at"), "page_url", "title", "body", "html"), "at")
    opened = opened.groupBy("url").agg(F.min_by(F.struct("page_url", "title", "body", "html"), "alt").alias("v")).select("url", "v.*").withColumn("ok", F.lit(True))
    # the item that the opened page names, joined back by the page's address
    page_item = item_files(opened.select(F.col("page_url").alias("url")), files, responses, most).select(F.col("url").alias("page_url"), F.col("pdf_url").alias("page_file"))
    top = ranked(page_candidates_b(opened), "page", ["first", "url"], TRIED)
    got = downloads(top.select("url"), responses, most).where("success").select("url", "pdf_url")
    found = top.join(got, "url").groupBy("page").agg(F.min(F.struct("rank", "pdf_url"))["pdf_url"].alias("found")).withColumnRenamed("page", "url")
    told = opened.select("url", "ok", "page_url", page_class(F.col("title"), F.col("body"), "B").alias("special")).join(page_item, "page_url", "left").drop("page_url")
    u = urls.join(direct, "url", "left").join(item, "url", "left").join(told, "url", "left").join(found, "url", "left")
    ok, early = F.coalesce("ok", F.lit(False)), F.coalesce("direct", "item_file")
    late = F.when(ok & F.col("special").isNull(), F.coalesce("page_file", "found"))
    pdf = F.coalesce(early, late)
    reason = F.when(pdf.isNotNull(), F.lit(None)).when(~ok, "repository_unavailable").when(F.col("special").isNotNull(), F.col("special")).otherwise("pdf_not_found")
    return _with_outputs(addresses, existing, u, pdf.isNotNull(), reason, pdf, folder, None)
