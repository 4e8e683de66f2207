"""Queries of the harvest's operators on the project's tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import rules, text, urls
from lavra.operators import attempts, candidates, discovery, manifest, metadata, repository, stages
from lavra.session import scratch, table
from lavra.settings import job_settings
from lavra.sources import binary, dspace, fetch, html, json_io

SITE = "https://catalogo.teses.example"
WS = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NL = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
Q, S = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def norm(c: str) -> str:
    """White space normalisation in the SQL dialect."""
    return f"nullif(trim(regexp_replace({c}, '{WS}', ' ', 'g')), '')"


def _links(spark: SparkSession, d: str) -> DataFrame:
    """(source, query, collected_at, pos, href): the links of all envelopes."""
    return table(spark, d, "discovery").select("source", "query", F.coalesce("collected_at", F.lit("9999")).alias("collected_at"), F.posexplode("record_urls").alias("pos", "href"))


LINKS = "links AS (SELECT source, query, coalesce(collected_at, '9999') AS collected_at, unnest(range(len(record_urls)))::INT AS pos, unnest(record_urls) AS href FROM discovery)"


@query(f"""WITH {LINKS}, r AS (SELECT *, row_number() OVER (PARTITION BY href ORDER BY collected_at, source, query, pos) AS n FROM links WHERE href LIKE '%/vufind/Record/%')
    SELECT CASE WHEN href LIKE '/%' THEN '{SITE}' || href ELSE href END AS url, collected_at, source, query, pos FROM r WHERE n = 1""")
def record_links(spark, d):
    links = discovery.record_links(_links(spark, d), "href", SITE).select("url", "collected_at", "source", "query", "pos")
    return discovery.first_occurrences(links, "url", ["collected_at", "source", "query", "pos"]).select("url", "collected_at", "source", "query", "pos")


def _pages(spark, d) -> tuple[DataFrame, DataFrame]:
    """Envelopes of one search as its pages, in order of collection; a page without a time counts as failed."""
    links = _links(spark, d).withColumn("page_no", F.expr("collected_at"))
    pages = table(spark, d, "discovery").groupBy("source", "query", F.coalesce("collected_at", F.lit("9999")).alias("page_no")).agg(F.bool_and(F.col("collected_at").isNotNull()).alias("ok"))
    return links.select("source", "query", "page_no", "pos", F.col("href").alias("url")), pages


PAGED = f"""{LINKS}, once AS (SELECT source, query, collected_at AS page_no, href, min(pos) AS pos FROM links GROUP BY ALL),
    firsts AS (SELECT source, query, href, min(page_no) AS f FROM once GROUP BY ALL),
    per AS (SELECT o.source, o.query, o.page_no, count(*) AS n_found, count(*) FILTER (WHERE o.page_no = f.f) AS n_new FROM once o JOIN firsts f USING (source, query, href) GROUP BY ALL),
    pages AS (SELECT source, query, coalesce(collected_at, '9999') AS page_no, bool_and(collected_at IS NOT NULL) AS ok FROM discovery GROUP BY ALL),
    p AS (SELECT source, query, page_no, ok, coalesce(n_found, 0) AS n_found, coalesce(n_new, 0) AS n_new FROM pages LEFT JOIN per USING (source, query, page_no)),
    stops AS (SELECT source, query, min(page_no) AS stop FROM p WHERE NOT ok OR n_new = 0 GROUP BY ALL),
    counted AS (SELECT source, query, page_no, n_found, n_new, sum(n_new) OVER (PARTITION BY source, query ORDER BY page_no)::BIGINT AS n_total, stop IS NULL OR page_no < stop AS kept FROM p LEFT JOIN stops USING (source, query))"""


@query(f"WITH {PAGED} SELECT source, query, page_no, n_found, n_new, n_total, kept FROM counted")
def page_counters(spark, d):
    links, pages = _pages(spark, d)
    return discovery.stop_rule(links, pages, ["source", "query"])


@query(f"""WITH {PAGED}, kept AS (SELECT o.source, o.query, o.page_no, o.pos, o.href, row_number() OVER (PARTITION BY o.href ORDER BY o.page_no, o.source, o.query, o.pos) AS n
    FROM once o JOIN counted c USING (source, query, page_no) WHERE c.kept)
    SELECT href AS url, page_no, pos FROM kept WHERE n = 1 ORDER BY page_no, source, query, pos LIMIT 100""")
def paginated_discovery(spark, d):
    links, pages = _pages(spark, d)
    kept = discovery.stop_rule(links, pages, ["source", "query"]).where("kept").select("source", "query", "page_no")
    once = links.groupBy("source", "query", "page_no", "url").agg(F.min("pos").alias("pos")).join(kept, ["source", "query", "page_no"])
    first = discovery.first_occurrences(once, "url", ["page_no", "source", "query", "pos"])
    return discovery.limited(first, ["page_no", "source", "query", "pos"], 100).select("url", "page_no", "pos")


@query(f"""SELECT DISTINCT query, p::INT AS page_no, '{SITE}/vufind/Search/Results?lookfor=' || replace(url_encode(query || ' ação*~&'), '%20', '+') || '&type=AllFields&page=' || p AS url
    FROM discovery, (VALUES (1), (2), (3)) v(p) WHERE query IS NOT NULL""")
def search_urls(spark, d):
    q = table(spark, d, "discovery").select("query").where("query IS NOT NULL").distinct().withColumn("page_no", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    return q.select("query", "page_no", urls.search_url(SITE, F.concat("query", F.lit(" ação*~&")), "page_no").alias("url"))


@query(f"SELECT doc_id, {norm('text')} AS text FROM documents")
def normalize_space(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_space("text").alias("text"))


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '{NL}'), lambda x: {norm('x')}), lambda x: x IS NOT NULL) AS lines FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, len(lines)::INT AS n_lines, array_to_string(lines, ' | ') AS lines FROM l""")
def body_lines(spark, d):
    l = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", text.body_lines("text").alias("l"))
    return l.select("doc_id", F.size("l").alias("n_lines"), F.array_join("l", " | ").alias("lines"))


@query(f"""WITH {LINKS}, u AS (SELECT DISTINCT href AS url FROM links UNION SELECT record_url || '//' FROM records WHERE record_url IS NOT NULL)
    SELECT url, string_split(rtrim(url, '/'), '/')[-1] AS record_id FROM u""")
def record_ids(spark, d):
    u = _links(spark, d).select(F.col("href").alias("url")).union(table(spark, d, "records").where("record_url IS NOT NULL").select(F.concat("record_url", F.lit("//")))).distinct()
    return u.select("url", text.record_id("url").alias("record_id"))


@query("SELECT record_id, row_no, title, source FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY collected_at DESC NULLS LAST, row_no DESC) AS n FROM records) WHERE n = 1")
def last_wins(spark, d):
    r = table(spark, d, "records").select("record_id", "collected_at", "row_no", "title", "source")
    return manifest.last_wins(r, "record_id", ["collected_at", "row_no"]).select("record_id", "row_no", "title", "source")


@query("SELECT record_id, row_no, title, source FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY row_no) AS n FROM records) WHERE n = 1")
def keep_first(spark, d):
    r = table(spark, d, "records").select("record_id", "row_no", "title", "source")
    return manifest.keep_first(r, "record_id", ["row_no"]).select("record_id", "row_no", "title", "source")


#: A catalogue page rebuilt from a record: heading by h1, class or neither, then the labelled section.
BODY = [("Título", "title"), ("Ano de defesa", "year"), ("Autor(a) principal", "author"), ("ORIENTADOR(A)", "advisor"), ("Tipo de documento", "document_type"), ("Tipo de acesso", "access_type"), ("Idioma", "language"), ("Instituição de defesa", "institution"), ("Programa de Pós-Graduação", "graduate_program"), ("Departamento", "department"), ("PAÍS", "country"), ("Link de acesso", "access_url"), ("Resumo", "abstract")]


def _one_line(c: str) -> F.Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x1C-\x1F\u0085  ]+", " ")


def _body(alias: str = "body") -> F.Column:
    rows = [F.lit("Capa"), F.lit("  Detalhes   Bibliográficos ")]
    for i, (label, c) in enumerate(BODY):
        sep = "\n" if i % 3 == 2 else " "
        rows.append(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{label} :{sep}"), _one_line(c))))
    return F.concat_ws("\n", *rows, F.lit("Metadados do Item"), F.lit("Autor: outro")).alias(alias)


def _field_sql() -> str:
    """What the page must give back, from the columns: an empty value takes the next line, whatever it is."""
    lines = []
    for i, (label, c) in enumerate(BODY):
        value = norm(c)
        lines.append((label, c, value, i % 3 == 2))
    out = []
    for k, (label, c, value, _) in enumerate(lines):
        if c == "title":
            continue
        nxt = "NULL"  # the section ends behind the last label
        for l2, c2, v2, own in reversed(lines[k + 1 :]):
            line = f"'{l2} :'" if own else f"rtrim('{l2} : ' || coalesce({v2}, ''))"
            nxt = f"CASE WHEN {c2} IS NOT NULL THEN {line} ELSE {nxt} END"
        out.append(f"CASE WHEN {c} IS NOT NULL THEN coalesce({value}, {nxt}) END AS {c}")
    return ", ".join(out)


@query(f"SELECT row_no, {_field_sql()} FROM records")
def bibliographic_fields(spark, d):
    body = table(spark, d, "records").select("row_no", _body())
    lines = body.select("row_no", text.body_lines("body").alias("lines"))  # a step each: what is used often is computed once
    lines = lines.select("row_no", text.section(F.col("lines")).alias("lines"))
    pairs = lines.select("row_no", text.labelled_pairs(F.col("lines")).alias("pairs"))
    return pairs.select("row_no", *(text.field_of(F.col("pairs"), text.LABELS[c]).alias(c) for c in text.LABELS))


def _page(spark, d) -> DataFrame:
    title = F.coalesce(_one_line("title"), F.lit(""))
    safe = F.replace(F.replace(title, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    head = F.when(F.col("row_no") % 3 == 0, F.concat(F.lit("<h1> <b>"), safe, F.lit("</b></h1>"))).when(F.col("row_no") % 3 == 1, F.concat(F.lit('<div class="x title">'), safe, F.lit("</div>"))).otherwise(F.concat(F.lit("<p>"), safe, F.lit("</p><p>Detalhes bibliográficos</p>")))
    link = F.concat(F.lit("<a class='l' href='/vufind/Record/"), F.col("record_id"), F.lit("'>ver &amp; ler</a><iframe src=\"/bitstream/"), F.col("record_id"), F.lit('.pdf"></iframe>'))
    return table(spark, d, "records").select("row_no", "record_id", F.concat(F.lit("<html><head><title>t</title><script>var a='</p>';</script></head><body>"), head, F.coalesce(link, F.lit("")), F.lit("</body>")).alias("html"))


@query(f"SELECT row_no, {norm('title')} AS title FROM records")
def page_titles(spark, d):
    p = _page(spark, d).select("row_no", html.read_page("html").alias("p"))
    return p.select("row_no", html.page_title(F.col("p.titles"), F.col("p.text")).alias("title"))


@query("SELECT row_no, 0 AS pos, '/vufind/Record/' || record_id AS url, 'ver & ler' AS text, '/bitstream/' || record_id || '.pdf' AS file FROM records WHERE record_id IS NOT NULL")
def page_links(spark, d):
    """Pages without a record have neither link nor file."""
    p = _page(spark, d).select("row_no", html.read_page("html").alias("p"))
    return p.select("row_no", F.explode("p.anchors").alias("a"), F.try_element_at("p.refs", F.lit(2))["url"].alias("file")).select("row_no", "a.pos", "a.url", "a.text", "file")


def _safe(c: F.Column) -> F.Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query(f"""SELECT row_no, string_split(rtrim(record_url, '/'), '/')[-1] AS record_id, '{metadata.SOURCE}' AS source, record_url, coalesce({norm('title')}, 'Capa') AS title, {_field_sql()} FROM records""")
def metadata_rows(spark, d):
    """Record pages with a heading and labelled lines, back to the 16 columns; without a title the line before the section counts."""
    head = F.concat(F.lit("<html><head><title>t</title></head><body><div class='title'><div>"), _safe(F.coalesce(_one_line("title"), F.lit(""))), F.lit("</div></div>"))
    pages = table(spark, d, "records").withColumn("body", _body()).select("row_no", "record_url", F.concat(head, F.replace(_safe(F.col("body")), F.lit("\n"), F.lit("<br>")), F.lit("</body></html>")).alias("html"))
    return metadata.metadata_rows(pages, "record_url", keep=("row_no",))


@query(f"SELECT row_no::VARCHAR AS url, 't' AS title, left({norm('abstract')}, 5000) AS body FROM records WHERE abstract IS NOT NULL")
def inspection(spark, d):
    page = F.concat(F.lit("<html><head><title>t</title></head><body><p>"), _safe(_one_line("abstract")), F.lit("</p>"))
    pages = table(spark, d, "records").where("abstract IS NOT NULL").select(F.col("row_no").cast("string").alias("url"), page.alias("html"))
    return metadata.inspected(pages).withColumn("body", F.nullif("body", F.lit("")))


@query(f"""SELECT 'u' || doc_id AS url, doc_id % 4 <> 0 AS ok, CASE WHEN doc_id % 4 <> 0 THEN 'T' || doc_id END AS title, CASE WHEN doc_id % 4 <> 0 THEN 'x' || doc_id END AS href FROM documents""")
def opened_pages(spark, d):
    """Pages of recorded responses: the first attempt fails, the second does for three in four."""
    k = F.col("doc_id").cast("string")
    page = F.concat(F.lit("<title>T"), k, F.lit("</title><a href=x"), k, F.lit(">z</a>"))
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("u"), k).alias("url"), F.encode(page, "UTF-8").alias("body"))
    tries = docs.select("url", F.explode(F.array(F.struct(F.lit(1).alias("attempt"), F.lit(503).alias("status")), F.struct(F.lit(2).alias("attempt"), F.when(F.col("doc_id") % 4 != 0, 200).otherwise(404).alias("status")))).alias("t"), "body").select("url", "t.attempt", F.lit("requests").alias("channel"), "t.status", F.lit("text/html").alias("content_type"), "body")
    return fetch.opened(docs, tries).select("url", "ok", "title", F.try_element_at("anchors", F.lit(1))["url"].alias("href"))


@query("SELECT unnest([" + ", ".join(f"'{x}'" for x in stages.LAYERS) + "]) AS layer, true AS there")
def layout(spark, d):
    return stages.create_layout(spark, scratch(spark, "data"))


def _phrase(k: str, phrases: list[str]) -> F.Column:
    c = F.when(F.col(k) % 29 == 0, F.lit(phrases[0]))
    for i, p in enumerate(phrases[1:], 1):
        c = c.when(F.col(k) % 29 == i, F.lit(p))
    return c.otherwise(F.lit(""))


PHRASES = ["Tipo de Acesso: Acesso Embargado", "CAPTCHA", "404 Not Found", "Service unavailable", "SafeLine WAF", "arquivo restrito captcha", "verificando conexão", "Página não encontrada", "checking your browser acesso restrito"]


def _phrase_sql(k: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} % 29 = {i} THEN '{p}'" for i, p in enumerate(PHRASES)) + " ELSE '' END"


def _has(c: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{p}')" for p in phrases) + ")"


@query(f"""WITH p AS (SELECT doc_id, lower(coalesce(text, '') || ' ' || {_phrase_sql('doc_id')}) AS b, lower({_phrase_sql('(doc_id + 3)')}) AS t FROM documents), c AS (SELECT doc_id, b, t || chr(10) || b AS x FROM p)
    SELECT doc_id, CASE WHEN {_has('b', rules.RESTRICTED)} THEN 'restricted_or_embargo' WHEN {_has('b', rules.ANTI_BOT['A'])} THEN 'anti_bot' END AS class_a,
    CASE WHEN {_has('x', rules.ANTI_BOT['B'])} THEN 'anti_bot' WHEN {_has('b', rules.RESTRICTED)} THEN 'restricted_or_embargo' WHEN {_has('x', rules.NOT_FOUND)} THEN 'not_found' WHEN {_has('x', rules.UNAVAILABLE)} THEN 'repository_unavailable' END AS class_b FROM c""")
def page_classes(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.concat_ws(" ", F.coalesce("text", F.lit("")), _phrase("doc_id", PHRASES)).alias("body"), _phrase2().alias("title"))
    return p.select("doc_id", rules.page_class(F.lit(""), F.col("body"), "A").alias("class_a"), rules.page_class(F.col("title"), F.col("body"), "B").alias("class_b"))


def _phrase2() -> F.Column:
    k = (F.col("doc_id") + 3) % 29
    c = F.when(k == 0, F.lit(PHRASES[0]))
    for i, p in enumerate(PHRASES[1:], 1):
        c = c.when(k == i, F.lit(p))
    return c.otherwise(F.lit(""))


#: Candidates of a record: its download addresses, its packed addresses' links and some that lead nowhere.
CAND = """cand AS (SELECT record_id AS page, 0 AS src, run_no AS pos, source_url AS url, coalesce(reason, 'Texto completo') AS text FROM manifest WHERE source_url IS NOT NULL
    UNION ALL SELECT record_id, 0, run_no + 100000000, source_url || '/download/content', 'PDF' FROM manifest WHERE source_url IS NOT NULL
    UNION ALL SELECT record_id, 0, run_no + 200000000, source_url || '/submission.sections', '' FROM manifest WHERE source_url IS NOT NULL
    UNION ALL SELECT record_id, 1, run_no, pdf_url, '' FROM manifest WHERE pdf_url IS NOT NULL)"""
IGN = rules.IGNORED
SCORE_A = f"""CASE WHEN url IS NULL OR url = '' OR {_has('lower(url)', IGN)} THEN -100 ELSE (CASE WHEN contains(lower(url), '.pdf') THEN 50 ELSE 0 END + CASE WHEN contains(lower(url), '/bitstream/') THEN 30 ELSE 0 END
    + CASE WHEN contains(lower(url), '/bitstreams/') THEN 30 ELSE 0 END + CASE WHEN contains(lower(url), '/download') THEN 15 ELSE 0 END + CASE WHEN contains(lower(url), '/content') THEN 15 ELSE 0 END) END"""
SCORE_B = f"""CASE WHEN NOT regexp_matches(lower(url), '^https?://') OR {_has('lower(url)', IGN)} OR {_has('lower(text)', IGN)} THEN -100 ELSE (CASE WHEN contains(lower(url), '.pdf') THEN 40 ELSE 0 END
    + CASE WHEN contains(lower(url), '/bitstream/') OR contains(lower(url), '/bitstreams/') THEN 30 ELSE 0 END + CASE WHEN contains(lower(url), 'download') THEN 20 ELSE 0 END + CASE WHEN contains(lower(text), 'pdf') OR contains(lower(text), 'texto completo') THEN 15 ELSE 0 END) END"""


def _candidates(spark, d) -> DataFrame:
    m = table(spark, d, "manifest").select("record_id", "run_no", "source_url", "pdf_url", "reason")
    kinds = [(0, 0, F.col("source_url"), F.coalesce("reason", F.lit("Texto completo"))), (0, 100000000, F.concat("source_url", F.lit("/download/content")), F.lit("PDF")), (0, 200000000, F.concat("source_url", F.lit("/submission.sections")), F.lit("")), (1, 0, F.col("pdf_url"), F.lit(""))]
    one = F.array(*(F.struct(F.lit(s).alias("src"), (F.col("run_no") + n).alias("pos"), u.alias("url"), t.alias("text")) for s, n, u, t in kinds))
    return m.select(F.col("record_id").alias("page"), F.inline(one)).where("url IS NOT NULL")


@query(f"WITH {CAND} SELECT DISTINCT url, text, ({SCORE_A})::INT AS score_a, ({SCORE_B})::INT AS score_b FROM cand")
def candidate_scores(spark, d):
    return _candidates(spark, d).select("url", "text").distinct().select("url", "text", rules.score_a(F.col("url")).alias("score_a"), rules.score_b(F.col("url"), F.col("text")).alias("score_b"))


@query(f"""WITH {CAND}, s AS (SELECT page, url, max(({SCORE_A})::INT) AS score FROM cand WHERE {SCORE_A} > 0 GROUP BY ALL)
    SELECT page, url, score, row_number() OVER (PARTITION BY page ORDER BY score DESC, url)::INT AS rank FROM s""")
def ranked_candidates_a(spark, d):
    return candidates.ranked(candidates.candidates_a(_candidates(spark, d), "page"), "page", ["url"])


@query(f"""WITH {CAND}, s AS (SELECT page, url, max(({SCORE_B})::INT) AS score, min((src, pos)) AS f FROM cand WHERE {SCORE_B} > 0 GROUP BY ALL)
    SELECT page, url, score, rank FROM (SELECT page, url, score, row_number() OVER (PARTITION BY page ORDER BY score DESC, f, url)::INT AS rank FROM s) WHERE rank <= 15""")
def ranked_candidates_b(spark, d):
    return candidates.ranked(candidates.candidates_b(_candidates(spark, d), "page"), "page", ["first", "url"], candidates.TRIED).select("page", "url", "score", "rank")


@query("""WITH p AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '%PDF-1.7' ELSE '' END || coalesce(text, '') AS body, CASE WHEN doc_id % 5 = 0 THEN 'Application/PDF; x' WHEN doc_id % 5 = 1 THEN 'text/html' END AS kind FROM documents)
    SELECT doc_id, starts_with(body, '%PDF') OR contains(lower(coalesce(kind, '')), 'application/pdf') AS is_pdf, starts_with(body, '%PDF') AS valid FROM p""")
def pdf_sniff(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.encode(F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-1.7").otherwise(""), F.coalesce("text", F.lit(""))), "UTF-8").alias("body"), F.when(F.col("doc_id") % 5 == 0, "Application/PDF; x").when(F.col("doc_id") % 5 == 1, "text/html").alias("kind"))
    return p.select("doc_id", urls.is_pdf("body", "kind").alias("is_pdf"), urls.is_pdf("body", strict=True).alias("valid"))


#: Distinct in order, in SQL: the elements whose first place is their own.
def _distinct(l: str) -> str:
    return f"list_filter({l}, lambda x, i: list_position({l}, x) = i)"


@query()
def split_urls(spark, d):
    r = table(spark, d, "records").where("access_url IS NOT NULL").select("row_no", urls.split_access_urls("access_url").alias("l"))
    return r.select("row_no", F.array_join("l", " ").alias("urls"))


S["split_urls"] = f"""WITH v AS (SELECT row_no, list_filter(list_transform(regexp_split_to_array(access_url, '{NL}'), lambda x: regexp_replace(x, '^{WS}|{WS}$', '', 'g')), lambda x: regexp_matches(x, '^https?://')) AS l FROM records WHERE access_url IS NOT NULL AND NOT regexp_matches(access_url, '^\\s*\\[')),
    j AS (SELECT row_no, list_filter(list_transform(from_json(access_url, '["VARCHAR"]'), lambda x: trim(x)), lambda x: regexp_matches(x, '^https?://')) AS l FROM records WHERE regexp_matches(access_url, '^\\s*\\[.*\\]\\s*$') AND json_valid(access_url)),
    o AS (SELECT row_no, CAST([] AS VARCHAR[]) AS l FROM records WHERE regexp_matches(access_url, '^\\s*\\[') AND NOT (regexp_matches(access_url, '^\\s*\\[.*\\]\\s*$') AND json_valid(access_url))),
    a AS (SELECT * FROM v UNION ALL SELECT * FROM j UNION ALL SELECT * FROM o)
    SELECT row_no, array_to_string({_distinct('l')}, ' ') AS urls FROM a"""


@query(f"""WITH v AS (SELECT row_no, regexp_extract_all(access_url, 'https?://[^\\s]+') AS l FROM records WHERE access_url IS NOT NULL) SELECT row_no, array_to_string({_distinct('l')}, ' ') AS urls FROM v""")
def inline_urls(spark, d):
    return table(spark, d, "records").where("access_url IS NOT NULL").select("row_no", F.array_join(urls.inline_urls("access_url"), " ").alias("urls"))


@query("""SELECT DISTINCT source_url AS url, CASE WHEN starts_with(source_url, 'http://') THEN source_url || ' https://' || substr(source_url, 8) ELSE source_url END AS tries, contains(lower(source_url), '.pdf') AS direct_a,
    ends_with(string_split(string_split(lower(source_url), '?')[1], '#')[1], '.pdf') AS direct_b FROM manifest WHERE source_url IS NOT NULL""")
def address_tests(spark, d):
    u = table(spark, d, "manifest").where("source_url IS NOT NULL").select(F.col("source_url").alias("url")).distinct()
    return u.select("url", F.array_join(urls.alternatives("url"), " ").alias("tries"), urls.direct_pdf("url", "A").alias("direct_a"), urls.direct_pdf("url").alias("direct_b"))


_SITE, _PATH = "regexp_extract(source_url, '^(https?://[^/?#]*)', 1)", "regexp_extract(source_url, '^([^?#]*)', 1)"
_FOLDER = f"CASE WHEN {_PATH} = {_SITE} THEN {_SITE} || '/' ELSE regexp_extract({_PATH}, '^(.*/)', 1) END"


@query(f"""WITH u AS (SELECT DISTINCT source_url, unnest(['', 'a.pdf', '/b/c', '//h.example/x', '?q=1', '#t', '../up.pdf', 'https://o.example/z']) AS href FROM manifest WHERE source_url IS NOT NULL)
    SELECT source_url, href, CASE WHEN href = '' THEN source_url WHEN starts_with(href, 'https:') OR NOT regexp_matches(source_url, '^https?://') THEN href WHEN starts_with(href, '//') THEN regexp_extract(source_url, '^(https?:)', 1) || href WHEN starts_with(href, '/') THEN {_SITE} || href
        WHEN starts_with(href, '?') THEN {_PATH} || href WHEN starts_with(href, '#') THEN regexp_extract(source_url, '^([^#]*)', 1) || href ELSE {_FOLDER} || href END AS url,
        CASE WHEN href <> '../up.pdf' OR NOT regexp_matches(source_url, '^https?://') THEN url WHEN {_FOLDER} = {_SITE} || '/' THEN {_SITE} || '/up.pdf' ELSE regexp_replace({_FOLDER}, '[^/]*/$', '') || 'up.pdf' END AS url_full FROM u""")
def resolved_urls(spark, d):
    """Both forms of resolution on addresses of all kinds; only one takes dot segments."""
    u = table(spark, d, "manifest").where("source_url IS NOT NULL").select("source_url", F.explode(F.array(*map(F.lit, ("", "a.pdf", "/b/c", "//h.example/x", "?q=1", "#t", "../up.pdf", "https://o.example/z")))).alias("href")).distinct()
    return u.select("source_url", "href", urls.resolve("source_url", "href").alias("url"), urls.resolve_full("source_url", "href").alias("url_full"))


@query("""WITH e AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), t AS (SELECT * FROM e WHERE n <= 5)
    SELECT user_id, coalesce(min(n) FILTER (WHERE event_type = 'purchase'), max(n)) AS n_attempts, count(*) FILTER (WHERE event_type = 'purchase') > 0 AS ok, arg_min(event_id, n) FILTER (WHERE event_type = 'purchase') AS event_id FROM t GROUP BY user_id""")
def retry_fold(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").select("user_id", "event_type", "event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("n"))
    return attempts.first_accepted(e, ["user_id"], "n", F.col("event_type") == "purchase", 5, ["event_id"])


@query("""WITH r AS (SELECT user_id, event_id AS attempt, CASE event_type WHEN 'purchase' THEN 'requests' WHEN 'signup' THEN 'browser' ELSE 'other' END AS channel FROM events WHERE event_type IN ('purchase', 'signup') AND value > 20)
    SELECT user_id, channel, attempt AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE channel WHEN 'requests' THEN 0 ELSE 1 END, attempt) AS n FROM r) WHERE n = 1""")
def channel_fallback(spark, d):
    e = table(spark, d, "events").where("event_type IN ('purchase', 'signup')")
    r = e.select("user_id", F.col("event_id").alias("attempt"), F.when(F.col("event_type") == "purchase", "requests").otherwise("browser").alias("channel"), "value", "event_id")
    return attempts.by_channel(r, ["user_id"], F.col("value") > 20, ["requests", "browser"], ["event_id"])


ATT = "att AS (SELECT record_id, run_no, status = 'downloaded' AS success, reason, source_url, pdf_url, pdf_path AS path FROM manifest)"
CHOSEN = f"""{ATT}, t AS (SELECT *, coalesce(success, false) OR coalesce(reason IN ('restricted_or_embargo', 'anti_bot'), false) AS term FROM att),
    chosen AS (SELECT record_id, run_no, success, reason, source_url, pdf_url, path FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY term DESC, CASE WHEN term THEN run_no ELSE -run_no END) AS n FROM t) WHERE n = 1)"""


def _attempts(spark, d) -> DataFrame:
    return table(spark, d, "manifest").select("record_id", "run_no", (F.col("status") == "downloaded").alias("success"), "reason", "source_url", "pdf_url", F.col("pdf_path").alias("path"))


@query(f"WITH {CHOSEN} SELECT record_id, run_no, success FROM chosen")
def attempt_fold(spark, d):
    return attempts.terminal_or_last(_attempts(spark, d), ["record_id"], "run_no").select("record_id", "run_no", "success")


MAN = f"""{CHOSEN}, recs AS (SELECT DISTINCT record_id FROM records), addr AS (SELECT record_id, max(access_url) AS access_url FROM records GROUP BY record_id),
    urls AS (SELECT record_id, regexp_extract_all(access_url, 'https?://[^\\s]+') AS urls FROM addr), old AS (SELECT record_id, min(pdf_path) AS old FROM manifest WHERE run_no <= 0 AND pdf_path IS NOT NULL GROUP BY record_id),
    j AS (SELECT r.record_id, o.old, c.*, u.urls, coalesce(len(u.urls), 0) = 0 AS none, coalesce(c.success, false) AS done FROM recs r LEFT JOIN old o ON o.record_id = r.record_id LEFT JOIN chosen c ON c.record_id = r.record_id LEFT JOIN urls u ON u.record_id = r.record_id),
    m AS (SELECT record_id, CASE WHEN old IS NOT NULL THEN 'already_exists' WHEN NOT none AND done THEN 'downloaded' ELSE 'failed' END AS status,
        CASE WHEN old IS NOT NULL THEN NULL WHEN none THEN 'no_access_url' WHEN done THEN reason ELSE coalesce(reason, 'pdf_not_found') END AS reason,
        CASE WHEN old IS NULL AND NOT none THEN coalesce(source_url, {_distinct('urls')}[-1]) END AS source_url, pdf_url, path, old FROM j),
    man AS (SELECT record_id, status, reason, source_url, CASE WHEN status = 'downloaded' THEN pdf_url END AS pdf_url, CASE WHEN old IS NOT NULL THEN old WHEN status = 'downloaded' THEN path END AS pdf_path FROM m)"""


def _manifest(spark, d) -> DataFrame:
    chosen = attempts.terminal_or_last(_attempts(spark, d).groupBy("record_id", "run_no").agg(F.min(F.struct("success", "reason", "source_url", "pdf_url", "path")).alias("s")).select("record_id", "run_no", "s.*"), ["record_id"], "run_no", keep=["source_url", "pdf_url", "path"]).drop("run_no")
    recs = table(spark, d, "records").groupBy("record_id").agg(F.max("access_url").alias("access_url")).select("record_id", urls.inline_urls("access_url").alias("urls"))
    old = table(spark, d, "manifest").where("run_no <= 0 AND pdf_path IS NOT NULL").select("record_id", "pdf_path")
    return manifest.build_manifest(recs, old, chosen)


@query(f"WITH {MAN} SELECT record_id, status, reason, source_url, pdf_url, pdf_path FROM man")
def manifest_rows(spark, d):
    return _manifest(spark, d)


@query(f"WITH {MAN} SELECT record_id, reason, source_url FROM man WHERE status = 'failed'")
def failures(spark, d):
    return manifest.failures(_manifest(spark, d)).select("record_id", "reason", "source_url")


@query(f"WITH {MAN} SELECT count(*) FILTER (WHERE status = 'downloaded') AS downloaded_now, count(*) FILTER (WHERE status = 'already_exists') AS already_existing, count(*) FILTER (WHERE status = 'failed') AS failures, count(*) FILTER (WHERE status <> 'failed') AS total_pdfs FROM man")
def run_summary(spark, d):
    return manifest.run_summary(_manifest(spark, d))


@query("SELECT count(*) FILTER (WHERE title IS NOT NULL) AS succeeded, count(*) FILTER (WHERE title IS NULL) AS errors FROM records")
def extraction_summary(spark, d):
    return manifest.extraction_summary(table(spark, d, "records").select(F.col("title").isNotNull().alias("ok")), "ok")


@query("SELECT DISTINCT record_id FROM records WHERE record_id NOT IN (SELECT record_id FROM manifest WHERE pdf_path IS NOT NULL AND record_id IS NOT NULL)")
def incremental_skip(spark, d):
    have = table(spark, d, "manifest").where("pdf_path IS NOT NULL")
    return manifest.not_yet_fetched(table(spark, d, "records").select("record_id").distinct(), have)


@query("SELECT count(*) AS n_pdfs FROM (SELECT DISTINCT pdf_path FROM manifest WHERE pdf_path LIKE '%.pdf')")
def pdf_count(spark, d):
    return table(spark, d, "manifest").where(F.col("pdf_path").endswith(".pdf")).agg(F.countDistinct("pdf_path").alias("n_pdfs"))


@query(f"WITH {LINKS} SELECT source, query, collected_at, pos, href AS url FROM links WHERE pos >= 0 GROUP BY ALL")
def json_envelope(spark, d):
    """Envelopes written as JSON text and read again, bare lists among them."""
    e = table(spark, d, "discovery").select("source", "query", F.coalesce("collected_at", F.lit("9999")).alias("collected_at"), "record_urls", "search_type")
    as_text = F.when(F.col("collected_at") < "2023-06", F.to_json("record_urls")).otherwise(json_io.envelope(F.col("source"), F.col("query"), F.col("search_type"), F.col("collected_at"), F.col("record_urls")))
    return e.select("source", "query", "collected_at", F.posexplode(json_io.urls_of_envelope(as_text)).alias("pos", "url")).distinct()


@query("SELECT source, query, i::INT AS pos, url, count(*) AS n FROM (SELECT source, query, unnest(range(len(record_urls))) AS i, unnest(record_urls) AS url FROM discovery) GROUP BY ALL")
def envelope_files(spark, d):
    """All envelopes as files of their own, read again with the source and query that each names."""
    path = scratch(spark, "envelopes")
    json_io.write_envelopes(table(spark, d, "discovery"), path, apart=True)
    links = json_io.read_envelopes(spark, path)
    named = spark.read.schema("source string, query string").option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("file"), "source", "query")
    return links.join(named, "file").groupBy("source", "query", "pos", "url").agg(F.count("*").alias("n"))


@query("SELECT record_id, title, year, access_url FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY collected_at DESC NULLS LAST, row_no DESC) AS n FROM records WHERE record_id IS NOT NULL AND record_id <> '') WHERE n = 1")
def record_files(spark, d):
    """One file a record, the last collection of each, read again."""
    path = scratch(spark, "records")
    json_io.write_records(table(spark, d, "records").where("record_id <> ''"), path, ["collected_at", "row_no"], apart=True)
    return json_io.read_records(spark, path)[0].select("record_id", "title", "year", "access_url")


@query("SELECT count(*) AS n_files, count(*) FILTER (WHERE doc_id % 3 = 0) AS n_valid FROM documents")
def pdf_files(spark, d):
    """Every document as a file, a third of them PDFs, written twice, listed and probed."""
    path = scratch(spark, "pdf")
    p = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("record_id"), F.encode(F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-1.7").otherwise("<html>"), F.coalesce("text", F.lit(""))), "UTF-8").alias("content"))
    binary.write_pdfs(p, path)
    binary.write_pdfs(p.withColumn("content", F.when(F.col("record_id") % 3 == 0, F.encode(F.lit("no"), "UTF-8")).otherwise(F.col("content"))), path)  # valid files stay
    listed = binary.list_pdfs(spark, path).agg(F.count("*").alias("n_files"))
    return listed.crossJoin(F.broadcast(binary.valid_pdfs(spark, path).agg(F.count_if("valid").alias("n_valid"))))  # one row each


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, 'b' || l_partkey AS bundle FROM i WHERE l_partkey % 2 = 0)
    SELECT l_orderkey AS item, arg_min('f' || l_linenumber || '-' || bundle, (l_linenumber, bundle)) AS bitstream FROM b WHERE l_orderkey % 3 <> 0 GROUP BY l_orderkey""")
def dspace_files(spark, d):
    """Replies as the interface gives them, built from lineitem: the first .pdf of the first ORIGINAL bundle."""
    i = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    one = F.struct("l_linenumber", F.concat(F.lit("b"), "l_partkey").alias("uuid"), F.when(F.col("l_partkey") % 2 == 0, "Original").otherwise("TEXT").alias("name"))
    replies = i.groupBy(F.col("l_orderkey").alias("item")).agg(F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(one)).alias("bundles")).alias("_embedded"))).alias("reply"))
    b = dspace.original_bundles(replies, "item", "reply")
    name = F.when(F.col("item") % 3 == 0, "a.txt").otherwise("A.PDF")
    n = F.transform(F.from_json("reply", "_embedded struct<bundles: array<struct<l_linenumber: int, uuid: string>>>")["_embedded"]["bundles"], lambda x: x["l_linenumber"])
    files = replies.select("item", n.alias("n")).join(b, "item").select("item", "pos", "bundle", F.to_json(F.struct(F.struct(F.array(F.struct(F.concat(F.lit("f"), F.try_element_at("n", F.col("pos") + 1), F.lit("-"), "bundle").alias("uuid"), name.alias("name"))).alias("bitstreams")).alias("_embedded"))).alias("reply"))
    return dspace.first_file(dspace.pdf_bitstreams(files, ["item", "pos"], "reply"), "item")


@query("""SELECT row_no, CASE WHEN access_type IS NULL THEN true ELSE lower(trim(access_type)) IN ('1', 'true', 'yes', 'y', 'sim') END AS flag, CASE WHEN regexp_matches(trim(year), '^[+-]?[0-9]{1,9}$') THEN CAST(trim(year) AS INT) ELSE 100 END AS n
    FROM (SELECT row_no, regexp_replace(access_type || CASE row_no % 3 WHEN 0 THEN chr(10) ELSE '' END, '^\\s+|\\s+$', '', 'g') AS access_type, regexp_replace(chr(9) || year, '^\\s+|\\s+$', '', 'g') AS year FROM records)""")
def settings(spark, d):
    access = F.concat("access_type", F.when(F.col("row_no") % 3 == 0, F.lit("\n")).otherwise(F.lit("")))
    return table(spark, d, "records").select("row_no", rules.bool_setting(access, True).alias("flag"), rules.int_setting(F.concat(F.lit("\t"), "year"), 100).alias("n"))


@query("""SELECT row_no AS job, coalesce(title, 'Direito') AS query, CASE WHEN regexp_matches(trim(year), '^[+-]?[0-9]{1,9}$') THEN CAST(trim(year) AS INT) ELSE 100 END AS max_records,
    CASE WHEN access_type IS NULL THEN false ELSE lower(trim(access_type)) IN ('1', 'true', 'yes', 'y', 'sim') END AS headless, (row_no % 7)::INT AS request_timeout, 30000 AS page_timeout, 2 AS max_retries FROM records""")
def settings_of_jobs(spark, d):
    r = table(spark, d, "records").select("row_no", "title", "year", "access_type", (F.col("row_no") % 7).cast("string").alias("t"))
    rows = r.select(F.col("row_no").alias("job"), F.expr("stack(5, 'QUERY', title, 'MAX_RECORDS', year, 'HEADLESS', access_type, 'REQUEST_TIMEOUT', t, 'OTHER', 'x') AS (key, value)"))
    return job_settings(rows)


#: Recorded states of the manifest's addresses, told by the least run_no (k) of each.
def _recorded(spark, d) -> dict[str, DataFrame]:
    m = table(spark, d, "manifest").where("source_url IS NOT NULL")
    u = m.groupBy(F.col("source_url").alias("url")).agg(F.min("run_no").alias("k"))
    site, folder = F.regexp_extract("url", r"^(https?://[^/?#]*)", 1), F.regexp_extract("url", r"^(https?://[^?#]*/)", 1)
    k = F.col("k").cast("string")
    row = lambda when, url, attempt, channel, status, kind, body: F.when(when, F.struct(url.alias("url"), F.lit(attempt).alias("attempt"), F.lit(channel).alias("channel"), F.lit(status).alias("status"), F.lit(kind).cast("string").alias("content_type"), F.encode(F.lit(body), "UTF-8").alias("body")))
    some = F.array_compact(F.array(
        row(F.lit(True), F.col("url"), 1, "requests", 200, "text/html", "<html>"), row(F.col("k") % 6 == 0, F.col("url"), 2, "requests", 200, None, "%PDF"), row(F.col("k") % 6 == 1, F.col("url"), 3, "requests", 200, None, "%PDF"),
        row(F.col("k") % 6 == 3, F.regexp_replace("url", "^http://", "https://"), 1, "browser", 200, "application/pdf", "x"), row(F.col("k") % 3 == 1, F.concat(site, F.lit("/bitstream/"), k, F.lit("/f.pdf")), 1, "requests", 200, None, "%PDF"),
        row(F.col("k") % 4 == 2, F.concat(folder, F.lit("x"), k, F.lit(".pdf")), 1, "browser", 404, None, "%PDF"), row(F.col("k") % 4 == 3, F.concat(folder, F.lit("x"), k, F.lit(".pdf")), 1, "browser", 200, None, "%PDF"),
        row(F.col("k") % 5 == 4, F.concat(F.lit("https://z.example/download/"), k, F.lit(".pdf?a&b")), 2, "requests", 200, None, "%PDF"), row(F.col("k") % 2 == 0, F.concat(site, F.lit(repository.CONTENT + "b"), F.col("url").substr(-5, 5), F.lit("/content")), 1, "requests", 200, None, "%PDF"),
    ))
    page = F.concat(F.lit("<html><body><p>Texto</p><a data-href='/no' href='x"), k, F.lit(".pdf'>Texto completo</a><a href=/bitstream/"), k, F.lit("/f.pdf>ler</a><a href='z'>z</a><iframe src='https://z.example/download/"), k, F.lit(".pdf?a&amp;b'></iframe></body></html>"))
    visits = u.select("url", (F.col("k") % 7 != 0).alias("ok"), F.col("url").alias("page_url"), F.when(F.col("k") % 11 == 0, "CAPTCHA").otherwise("t").alias("title"), F.when(F.col("k") % 13 == 0, "Acesso restrito").when(F.col("k") % 17 == 0, "captcha").otherwise("Texto").alias("body"), page.alias("html"))
    items = u.withColumn("item", dspace.item_uuid("url")).where("item IS NOT NULL")
    return {
        "addresses": m.select(F.col("run_no").alias("id"), F.col("source_url").alias("url")), "existing": m.where("run_no % 19 = 0").select(F.col("run_no").alias("id"), F.concat(F.lit("old/"), F.col("run_no")).alias("path")),
        "responses": u.select(F.inline(some)), "visits": visits, "files": items.select("item", F.lit(0).alias("pos"), F.lit(0).alias("file_pos"), F.concat(F.lit("b"), F.col("url").substr(-5, 5)).alias("bitstream")),
    }


SITE_SQL, FOLDER_SQL = "regexp_extract(url, '^(https?://[^/?#]*)', 1)", "regexp_extract(url, '^(https?://[^?#]*/)', 1)"
RECORDED = f"""u AS (SELECT source_url AS url, min(run_no) AS k FROM manifest WHERE source_url IS NOT NULL GROUP BY 1),
    got AS (SELECT DISTINCT url, channel FROM (SELECT url, 'requests' AS channel FROM u WHERE k % 6 = 0
        UNION ALL SELECT regexp_replace(url, '^http://', 'https://'), 'browser' FROM u WHERE k % 6 = 3
        UNION ALL SELECT {SITE_SQL} || '/bitstream/' || k || '/f.pdf', 'requests' FROM u WHERE k % 3 = 1
        UNION ALL SELECT {FOLDER_SQL} || 'x' || k || '.pdf', 'browser' FROM u WHERE k % 4 = 3
        UNION ALL SELECT 'https://z.example/download/' || k || '.pdf?a&b', 'requests' FROM u WHERE k % 5 = 4
        UNION ALL SELECT {SITE_SQL} || '{repository.CONTENT}b' || right(url, 5) || '/content', 'requests' FROM u WHERE k % 2 = 0)),
    tries AS (SELECT url AS wanted, url AS pdf_url, 0 AS alt FROM u UNION ALL SELECT url, 'https://' || substr(url, 8), 1 FROM u WHERE starts_with(url, 'http://')),
    direct AS (SELECT wanted AS url, pdf_url, channel FROM (SELECT t.*, channel, row_number() OVER (PARTITION BY wanted ORDER BY alt, channel = 'browser') AS n FROM tries t JOIN got g ON g.url = t.pdf_url) WHERE n = 1),
    offered AS (SELECT url AS page, {FOLDER_SQL} || 'x' || k || '.pdf' AS url, 'Texto completo' AS text, 0 AS src, 0 AS pos, k FROM u
        UNION ALL SELECT url, {SITE_SQL} || '/bitstream/' || k || '/f.pdf', 'ler', 0, 1, k FROM u UNION ALL SELECT url, {FOLDER_SQL} || 'z', 'z', 0, 2, k FROM u
        UNION ALL SELECT url, 'https://z.example/download/' || k || '.pdf?a&b', '', 1, 0, k FROM u),
    item AS (SELECT url, {SITE_SQL} || '{repository.CONTENT}b' || right(url, 5) || '/content' AS pdf_url FROM u WHERE regexp_matches(url, '/items/[0-9a-fA-F-]{{36}}') AND k % 2 = 0),
    m AS (SELECT run_no AS id, source_url AS url, run_no % 19 = 0 AS there FROM manifest WHERE source_url IS NOT NULL)"""


def _result_sql(there: str) -> str:
    return f"""SELECT m.id, there OR s AS success, CASE WHEN there THEN {there} ELSE r END AS reason, url AS source_url, CASE WHEN NOT there AND s THEN p END AS pdf_url,
        CASE WHEN there THEN 'old/' || id WHEN s THEN 'data/raw/pdf/' || id || '.pdf' END AS path FROM m JOIN done USING (url)"""


@query(f"WITH {RECORDED} SELECT u.url, pdf_url IS NOT NULL AS success, CASE WHEN pdf_url IS NULL THEN 'not_pdf' END AS reason, pdf_url, channel FROM u LEFT JOIN direct USING (url)")
def alternative_downloads(spark, d):
    r = _recorded(spark, d)
    return repository.downloads(r["addresses"], r["responses"])


@query(f"""WITH {RECORDED}, c AS (SELECT page, url, max(({SCORE_A})::INT) AS score FROM offered WHERE k % 7 <> 0 AND {SCORE_A} > 0 GROUP BY ALL) SELECT page, url, score FROM c""")
def html_candidates_a(spark, d):
    return repository.page_candidates_a(_recorded(spark, d)["visits"])


@query(f"""WITH {RECORDED}, c AS (SELECT page, url, max(({SCORE_B})::INT) AS score, min(src * 100 + pos)::INT AS place FROM offered WHERE k % 7 <> 0 AND {SCORE_B} > 0 GROUP BY ALL) SELECT page, url, score, place FROM c""")
def html_candidates_b(spark, d):
    c = repository.page_candidates_b(_recorded(spark, d)["visits"])
    return c.select("page", "url", "score", (F.col("first.src") * 100 + F.col("first.pos")).cast("int").alias("place"))


@query(f"""WITH {RECORDED}, best AS (SELECT page, url AS found FROM (SELECT page, o.url, row_number() OVER (PARTITION BY page ORDER BY score DESC, o.url) AS n FROM (SELECT page, url, ({SCORE_A}) AS score FROM offered) o JOIN (SELECT DISTINCT url FROM got) USING (url) WHERE score > 0) WHERE n = 1),
    hows AS (SELECT u.url, found, CASE WHEN contains(lower(u.url), '.pdf') AND g.url IS NOT NULL THEN 'direct' WHEN k % 7 = 0 THEN 'repository_unavailable' WHEN k % 13 = 0 THEN 'restricted_or_embargo' WHEN k % 17 = 0 THEN 'anti_bot' WHEN found IS NULL THEN 'pdf_not_found' ELSE 'page' END AS how
        FROM u LEFT JOIN best ON page = u.url LEFT JOIN (SELECT DISTINCT url FROM got) g ON g.url = u.url),
    done AS (SELECT url, how IN ('direct', 'page') AS s, CASE WHEN NOT how IN ('direct', 'page') THEN how END AS r, CASE how WHEN 'direct' THEN url ELSE found END AS p FROM hows)
    {_result_sql("'already_exists'")}""")
def repository_results_a(spark, d):
    r = _recorded(spark, d)
    return repository.repository_results_a(r["addresses"], r["existing"], r["responses"], r["visits"])


@query(f"""WITH {RECORDED}, opened AS (SELECT wanted AS url, u.k, row_number() OVER (PARTITION BY wanted ORDER BY alt) AS n FROM tries t JOIN u ON u.url = t.pdf_url WHERE k % 7 <> 0),
    o AS (SELECT opened.url, u.url AS page_url, opened.k FROM opened JOIN u ON u.k = opened.k AND (u.url = opened.url OR u.url = 'https://' || substr(opened.url, 8)) WHERE n = 1),
    cand AS (SELECT o.url AS page, f.url, ({SCORE_B.replace('(url)', '(f.url)').replace('(text)', '(f.text)')}) AS score, src, pos FROM o JOIN offered f ON f.page = o.page_url),
    top AS (SELECT page, url, row_number() OVER (PARTITION BY page ORDER BY score DESC, src, pos, url) AS rank FROM cand WHERE score > 0),
    found AS (SELECT page AS url, found FROM (SELECT t.page, g.url AS found, row_number() OVER (PARTITION BY t.page ORDER BY rank) AS n FROM top t JOIN got g ON g.url = t.url) WHERE n = 1),
    done AS (SELECT u.url, CASE WHEN ends_with(string_split(string_split(lower(u.url), '?')[1], '#')[1], '.pdf') THEN direct.pdf_url END AS a, coalesce(a, i.pdf_url) AS early, o.k IS NOT NULL AS ok,
        CASE WHEN o.k % 11 = 0 OR (o.k % 17 = 0 AND o.k % 13 <> 0) THEN 'anti_bot' WHEN o.k % 13 = 0 THEN 'restricted_or_embargo' END AS special, CASE WHEN ok AND special IS NULL THEN coalesce(j.pdf_url, f.found) END AS late,
        coalesce(early, late) AS p, p IS NOT NULL AS s, CASE WHEN s THEN NULL WHEN NOT ok THEN 'repository_unavailable' ELSE coalesce(special, 'pdf_not_found') END AS r
        FROM u LEFT JOIN direct USING (url) LEFT JOIN item i ON i.url = u.url LEFT JOIN o ON o.url = u.url LEFT JOIN item j ON j.url = o.page_url LEFT JOIN found f ON f.url = u.url)
    {_result_sql("NULL")}""")
def repository_results_b(spark, d):
    r = _recorded(spark, d)
    return repository.repository_results_b(r["addresses"], r["existing"], r["responses"], r["visits"], r["files"])


@query("SELECT run_no AS id, success, reason, source_url, pdf_url, path FROM (SELECT run_no, coalesce(status = 'downloaded', false) AS success, reason, source_url, pdf_url, pdf_path AS path FROM manifest)")
def parser_results(spark, d):
    m = table(spark, d, "manifest")
    return m.select(F.col("run_no").alias("id"), attempts.result(F.coalesce(F.col("status") == "downloaded", F.lit(False)), F.col("reason"), F.col("source_url"), F.col("pdf_url"), F.col("pdf_path")).alias("r")).select("id", "r.*")


@query("SELECT row_no, CASE WHEN record_id IS NULL OR row_no % 5 = 0 THEN 'f' || row_no ELSE record_id END AS record_id FROM records")
def record_keys(spark, d):
    r = table(spark, d, "records").select("row_no", F.when(F.col("row_no") % 5 != 0, F.col("record_id")).when(F.col("row_no") % 2 == 0, F.lit("")).alias("record_id"), F.concat(F.lit("/a/b.c/f"), F.col("row_no"), F.lit(".json")).alias("file"))
    return r.select("row_no", manifest.record_key("record_id", "file").alias("record_id"))


@query("SELECT row_no, 'https://a.example/' || row_no || '?x&y https://b.example/z' AS urls FROM records")
def bare_addresses(spark, d):
    page = F.concat(F.lit("<a href=\"https://a.example/"), F.col("row_no"), F.lit("?x&amp;y\">z</a> <i>https://b.example/z</i>"))
    return table(spark, d, "records").select("row_no", F.array_join(urls.html_urls(page), " ").alias("urls"))


@query("""SELECT row_no, nullif(trim(record_id, ' '), '') AS record_id, nullif(trim(language, ' '), '') AS language, CASE WHEN regexp_matches(year, '^\\s*[0-9]{4}\\s*$') AND CAST(trim(year) AS INT) BETWEEN 1500 AND 2100 THEN CAST(trim(year) AS INT) END AS year FROM records""")
def standardised(spark, d):
    return stages.standardised(table(spark, d, "records")).select("row_no", "record_id", "language", "year")


@query(f"SELECT row_no, {norm('title')} AS title, {norm('abstract')} AS abstract FROM records")
def normalised(spark, d):
    return stages.normalised(table(spark, d, "records").select("row_no", "title", "abstract"))


@query("SELECT record_id, row_no FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY collected_at DESC NULLS LAST, row_no DESC) AS n FROM records) WHERE n = 1")
def deduplicated(spark, d):
    return stages.deduplicated(table(spark, d, "records").select("record_id", "collected_at", "row_no"), ["collected_at", "row_no"]).select("record_id", "row_no")


@query(r"""WITH t AS (SELECT row_no, coalesce(abstract, '') || ' ' || CASE row_no % 4 WHEN 0 THEN 'a.b@c.example' WHEN 1 THEN '123.456.789-00' WHEN 2 THEN '(11) 91234-5678' ELSE '' END AS abstract FROM records)
    SELECT row_no, regexp_replace(regexp_replace(regexp_replace(abstract, '[\w.+-]+@[\w-]+(?:\.[\w-]+)+', '[EMAIL]', 'g'), '\b\d{3}\.?\d{3}\.?\d{3}-\d{2}\b', '[CPF]', 'g'), '(?:\+?55 ?)?\(?\b\d{2}\)?[ -]?9?\d{4}-\d{4}\b', '[FONE]', 'g') AS abstract FROM t""")
def anonymised(spark, d):
    k = F.col("row_no") % 4
    extra = F.when(k == 0, "a.b@c.example").when(k == 1, "123.456.789-00").when(k == 2, "(11) 91234-5678").otherwise("")
    return stages.anonymised(table(spark, d, "records").select("row_no", F.concat_ws(" ", F.coalesce("abstract", F.lit("")), extra).alias("abstract")))


@query(f"SELECT row_no, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(title, '') || chr(10) || 'fim', '{NL}'), lambda x: {norm('x')}), lambda x: x IS NOT NULL), chr(10)) AS text FROM records")
def extracted_texts(spark, d):
    page = F.concat(F.lit("<html><head><style>p</style></head><body><p>"), _safe(F.coalesce("title", F.lit(""))), F.lit("</p><div>fim"))
    return stages.extracted(table(spark, d, "records").select("row_no", page.alias("html")), "row_no", "html")


TEXTS = f"t AS (SELECT doc_id, text, {norm('text')} AS p FROM documents), f AS (SELECT min(doc_id) AS doc_id, count(*) AS n FROM t WHERE p IS NOT NULL GROUP BY lower(p)), once AS (SELECT doc_id, text, p, n FROM t JOIN f USING (doc_id))"


@query(f"WITH {TEXTS} SELECT doc_id, text, n FROM once")
def distinct_texts(spark, d):
    return stages.distinct_texts(table(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {TEXTS} SELECT doc_id, p AS text FROM once WHERE length(p) >= 200")
def pretraining(spark, d):
    return stages.pretraining(table(spark, d, "documents"))


@query(f"SELECT row_no, 'user' AS asks, {norm('title')} AS ask, 'assistant' AS answers, {norm('abstract')} AS answer FROM records WHERE {norm('title')} IS NOT NULL AND {norm('abstract')} IS NOT NULL")
def finetuning(spark, d):
    m = stages.finetuning(table(spark, d, "records"))
    at = lambda i, c: F.col("messages")[i][c]
    return m.select("row_no", at(0, "role").alias("asks"), at(0, "content").alias("ask"), at(1, "role").alias("answers"), at(1, "content").alias("answer"))


@query(f"WITH t AS (SELECT doc_id, {norm('text')} AS p FROM documents), c AS (SELECT doc_id, p, unnest(range(0, ceil(greatest(length(p) - 1000, 0) / 800.0)::INT + 1))::INT AS chunk_no FROM t WHERE p IS NOT NULL) SELECT doc_id, chunk_no, substr(p, chunk_no * 800 + 1, 1000) AS chunk FROM c")
def rag_chunks(spark, d):
    return stages.chunks(table(spark, d, "documents"))


@query(f"WITH {TEXTS} SELECT doc_id, text, n FROM once WHERE ('0x' || substr(md5(lower(p)), 1, 6))::BIGINT % 100 < 5")
def benchmark_texts(spark, d):
    return stages.held_out(table(spark, d, "documents"))


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(S)
