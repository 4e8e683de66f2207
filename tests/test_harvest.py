"""The harvest's operators: literal cases, their SQL on the smallest tables, and random models."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lavra.functions import rules, text, urls
from lavra.operators import attempts, discovery, manifest, metadata, repository, stages
from lavra.plans import core
from lavra.sources import binary, dspace, fetch, html, json_io
from lavra.streaming import ingest

DATA = "/root/testdata/sf0.001"


def one(spark, col, **values):
    row = {k: v for k, v in values.items()}
    schema = ", ".join(f"{k} {'binary' if isinstance(v, bytes) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema).select(col.alias("x")).first()["x"]


def test_urls_in_lines(spark):
    v = "https://example.org/item\ntexto https://example.org/file.pdf https://example.org/item"
    assert one(spark, urls.inline_urls("v"), v=v) == ["https://example.org/item", "https://example.org/file.pdf"]
    assert one(spark, urls.split_access_urls("v"), v=v) == ["https://example.org/item"]
    assert one(spark, urls.split_access_urls("v"), v='["https://a.example/1", "x", "https://a.example/1"]') == ["https://a.example/1"]
    assert one(spark, urls.split_access_urls("v"), v=None) == []


@pytest.mark.parametrize(("content", "kind", "want"), [(b"%PDF-1.7", None, True), (b"binary", "application/pdf; charset=binary", True), (b"<html>", "text/html", False), (None, None, False)])
def test_pdf_sniff(spark, content, kind, want):
    df = spark.createDataFrame([(content, kind)], "c binary, t string")
    assert df.select(urls.is_pdf("c", "t")).first()[0] is want


def test_record_id(spark):
    assert one(spark, text.record_id("v"), v="https://x.example/vufind/Record/PUC_SP-1_abc-123") == "PUC_SP-1_abc-123"
    assert one(spark, text.record_id("v"), v="https://x.example/Record/X///") == "X"


def test_special_pages(spark):
    c = rules.page_class(F.col("t"), F.col("b"), "B")
    assert one(spark, c, t="Documento", b="Tipo de Acesso: Acesso Embargado") == "restricted_or_embargo"
    assert one(spark, c, t="captcha", b="acesso restrito") == "anti_bot"
    assert one(spark, rules.page_class(F.col("t"), F.col("b"), "A"), t="captcha", b="acesso restrito captcha") == "restricted_or_embargo"
    assert one(spark, c, t=None, b=None) is None


def test_scores(spark):
    assert one(spark, rules.score_b(F.col("u"), F.col("t")), u="https://repo.example/item.edit.bitstreams", t="") < 0
    assert one(spark, rules.score_b(F.col("u"), F.col("t")), u=None, t=None) == -100
    assert one(spark, rules.score_a(F.col("u")), u="https://r.example/bitstreams/1/download") == 45


def test_white_space_and_lines(spark):
    assert one(spark, text.normalize_space("v"), v=" a  b\x1c\n c ") == "a b c"
    assert one(spark, text.normalize_space("v"), v=" 　 ") is None
    assert one(spark, text.body_lines(F.col("v")), v="a\r\nb  \n\x0bc") == ["a", "b", "c"]


def _model_fields(lines, labels):
    """Independent reading of a labelled field."""
    low = [x.lower() for x in lines]
    if "detalhes bibliográficos" not in low:
        return None
    at = low.index("detalhes bibliográficos") + 1
    end = low.index("metadados do item", at) if "metadados do item" in low[at:] else len(lines)
    part = lines[at:end]
    for i, line in enumerate(part):
        for label in labels:
            head, sep, tail = line.partition(":")
            if sep and head.strip().lower() == label.lower():
                if tail.strip():
                    return tail.strip()
                if i + 1 < len(part):
                    return part[i + 1]
    return None


def test_fields_against_model(spark):
    r = random.Random(1)
    pool = ["Detalhes bibliográficos", "DETALHES BIBLIOGRÁFICOS", "Metadados do item", "Autor(a): Ana", "Autor:", "autor principal : Bia", "País:", "PAÍS: Brasil", "texto", "Idioma : pt", "Autora: não", "Resumo:"]
    rows = [(i, [r.choice(pool) for _ in range(r.randint(0, 9))]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, l array<string>").select("i", "l", text.section(F.col("l")).alias("s"))
    df = df.select("i", "l", "s", text.labelled_pairs(F.col("s")).alias("p"))
    for f in ("author", "country", "language", "abstract"):
        got = {x["i"]: (x["v"], x["w"]) for x in df.select("i", text.labelled_field(F.col("s"), text.LABELS[f]).alias("v"), text.field_of(F.col("p"), text.LABELS[f]).alias("w")).collect()}
        for i, l in rows:
            assert got[i] == (_model_fields(l, text.LABELS[f]),) * 2, (f, l)


def test_resolution_against_standard_library(spark):
    from urllib.parse import urljoin

    bases = ["https://a.example/b/c?d=1#e", "http://a.example", "https://a.example/b/"]
    hrefs = ["", "x.pdf", "/y", "//h.example/z", "?q", "#t", "../up", "https://o.example/"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs] + [(None, "x")], "b string, h string")
    for x in df.select("b", "h", urls.resolve("b", "h").alias("u"), urls.resolve_full("b", "h").alias("f")).collect():
        want = None if x["b"] is None else urljoin(x["b"], x["h"])
        assert x["f"] == want
        if x["h"] != "../up":
            assert x["u"] == want, (x["b"], x["h"])


def test_stop_rule_against_model(spark):
    r = random.Random(2)
    links, pages, want = [], [], {}
    for s in range(60):
        seen, kept, going = set(), [], True
        for p in range(r.randint(1, 6)):
            ok, got = r.random() > 0.1, [f"u{r.randint(0, 8)}" for _ in range(r.randint(0, 4))]
            pages.append((str(s), p, ok))
            links += [(str(s), p, i, u) for i, u in enumerate(got)]
            new = {u for u in got if u not in seen}
            going = going and ok and bool(new)
            kept.append(going)
            seen |= set(got)
        want[str(s)] = kept
    l = spark.createDataFrame(links, "s string, page_no int, pos int, url string")
    p = spark.createDataFrame(pages, "s string, page_no int, ok boolean")
    for x in discovery.stop_rule(l, p, ["s"]).collect():
        assert x["kept"] == want[x["s"]][x["page_no"]]


def test_attempt_fold_against_model(spark):
    r = random.Random(3)
    rows, want = [], {}
    for k in range(100):
        tries = [(str(k), n, r.random() < 0.2, r.choice(["anti_bot", "pdf_not_found", None])) for n in range(r.randint(1, 5))]
        stop = next((t for t in tries if t[2] or t[3] == "anti_bot"), tries[-1])
        want[str(k)] = stop[1]
        rows += tries
    df = spark.createDataFrame(rows, "k string, n int, success boolean, reason string")
    assert {x["k"]: x["n"] for x in attempts.terminal_or_last(df, ["k"], "n").collect()} == want


def test_limit_zero_and_empty(spark):
    df = spark.createDataFrame([], "url string, a int")
    assert discovery.first_occurrences(df, "url", ["a"]).count() == 0
    assert discovery.limited(spark.range(5), ["id"], 0).count() == 0
    m = spark.createDataFrame([], "record_id string, status string")
    assert tuple(manifest.run_summary(m).first()) == (0, 0, 0, 0)


def test_json_round_trip(spark, tmp_path):
    recs = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), (None, "3", 3)], "record_id string, title string, n int")
    full = recs.select("*", *[F.lit(None).cast("string").alias(c) for c in json_io.RECORD.fieldNames() if c not in ("record_id", "title")])
    json_io.write_records(full.where("record_id IS NOT NULL").coalesce(1), str(tmp_path / "r"), ["n"])
    (tmp_path / "r" / "broken.json").write_text("{no")
    (tmp_path / "r" / "stem.json").write_text('{"title": "3"}')
    good, bad = json_io.read_records(spark, str(tmp_path / "r"))
    assert {(x["record_id"], x["title"]) for x in good.collect()} == {("a", "2"), ("stem", "3")}
    assert bad.count() == 1
    for name, content in (("three", "3"), ("null", "null"), ("blank", " \n"), ("list", '[{"title": "a"}, {"title": "b"}]'), ("lines", '{\n"title": "c",\n"access_url": ["u", "v"]}')):
        (tmp_path / "r" / f"{name}.json").write_text(content)
    good, bad = json_io.read_records(spark, str(tmp_path / "r"))
    assert {(x["record_id"], x["title"], x["access_url"]) for x in good.collect()} == {("a", "2", None), ("stem", "3", None), ("lines", "c", '["u","v"]')}
    assert sorted(x["file"].rsplit("/", 1)[-1] for x in bad.collect()) == ["blank.json", "broken.json", "list.json", "null.json", "three.json"]
    files = [x["file"] for x in json_io.metadata_files(spark, str(tmp_path / "r")).collect()]
    assert files == sorted(files) and len(files) == 8
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.json").write_text('{"record_urls": ["u1", "u2"]}')
    (tmp_path / "e" / "y.json").write_text('["u3"]')
    (tmp_path / "e" / "z.json").write_text("{}")
    assert sorted(x["url"] for x in json_io.read_envelopes(spark, str(tmp_path / "e")).collect()) == ["u1", "u2", "u3"]
    for text_ in ('{"record_urls": 3}', '{"record_urls": null}', "3", "null", '["a"', ""):
        with pytest.raises(Exception, match="no list"):
            spark.createDataFrame([(text_,)], "t string").select(json_io.urls_of_envelope(F.col("t"))).collect()
    assert one(spark, json_io.urls_of_envelope(F.col("t")), t='\n {"record_urls": ["u"]}') == ["u"]
    e = spark.createDataFrame([("s", None)], "s string, q string").select(json_io.envelope(F.col("s"), F.col("q"), F.lit("AllFields"), F.lit(None).cast("string"), F.array(F.lit("u"))).alias("x")).first()["x"]
    assert e == '{"source":"s","query":null,"search_type":"AllFields","collected_at":null,"total_collected":1,"record_urls":["u"]}'


def test_files_apart(spark, tmp_path):
    ids = ["PUC_SP-1", "a/b", "../c", ".d", "_e", "%2Fa", "á b", "x" * 300, "x" * 299 + "y", None]
    recs = spark.createDataFrame([(i, f"{k} é\n\"", n) for n in (1, 2) for k, i in enumerate(ids)], "record_id string, title string, n int")
    full = recs.select("*", *[F.lit(None).cast("string").alias(c) for c in json_io.RECORD.fieldNames() if c not in ("record_id", "title")])
    at, lines = tmp_path / "a b%20" / "r", tmp_path / "lines"
    json_io.write_records(full.withColumn("record_id", F.concat("record_id", F.lit("-old"))), str(at), ["n"], apart=True)
    json_io.write_records(full, str(at), ["n"], apart=True)  # overwrites
    files = [x for x in at.rglob("*") if x.suffix == ".json"]
    assert len(files) == len(ids) and {"PUC_SP-1.json", "a%2Fb.json", "%252Fa.json"} <= {x.name for x in files}
    assert all(x.name[0] not in "._" for x in files) and [x.name for x in at.parent.iterdir()] == ["r"]
    json_io.write_records(full, str(lines), ["n"])
    assert sorted(x.read_bytes() for x in files) == sorted(x + b"\n" for y in lines.glob("*.json") for x in y.read_bytes().splitlines())
    good, bad = json_io.read_records(spark, str(at))
    got = {x["record_id"]: (x["title"], x["file"]) for x in good.collect()}
    assert {k: v[0] for k, v in got.items()} == {i or "%null": f"{k} é\n\"" for k, i in enumerate(ids)} and bad.count() == 0
    assert {v[1].removeprefix("file:") for v in got.values()} == {str(x) for x in files} == {x["file"].removeprefix("file:") for x in json_io.metadata_files(spark, str(at)).collect()}
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1  # the text is read once, not once a field
    assert [x["record"]["record_id"] for x in json_io.read_files(spark, str(at / "*" / "PUC*.json")).collect()] == ["PUC_SP-1"]
    (at / "empty.json").write_text("")
    (at / "old").mkdir()
    (at / "old" / "x.json").write_text("{}")
    assert json_io.read_files(spark, str(at)).count() == len(ids)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        json_io.read_files(spark, str(tmp_path / "none"))
    json_io.write_records(full.limit(0), str(at), ["n"], apart=True)
    assert json_io.read_files(spark, str(at)).count() == 0


def test_pdf_files(spark, tmp_path):
    folder = str(tmp_path / "pdf")
    binary.write_pdfs(spark.createDataFrame([("a", b"%PDF-1"), ("b", b"<html>")], "record_id string, content binary"), folder)
    binary.write_pdfs(spark.createDataFrame([("a", b"%PDF-2"), ("b", b"%PDF-3")], "record_id string, content binary"), folder)
    assert binary.count_pdfs(spark, folder) == 2
    assert (tmp_path / "pdf" / "a.pdf").read_bytes() == b"%PDF-1"  # a valid file stays
    assert {x["record_id"]: x["valid"] for x in binary.valid_pdfs(spark, folder).collect()} == {"a": True, "b": True}


def test_html(spark):
    page = "<html><head><title>t</title></head><body><script>x='</p>'</script><p>Um <b>dois</p><div class='a title'> O  t&iacute;tulo </div>Detalhes bibliográficos<br>x"
    x = spark.createDataFrame([(page,), (None,)], "h string").select(html.read_page("h").alias("p")).select(html.page_title(F.col("p.titles"), F.col("p.text")).alias("t"), F.col("p.text").alias("x")).collect()
    assert x[0]["t"] == "O título" and "dois" in x[0]["x"] and "x='" not in x[0]["x"]
    assert x[1]["t"] is None


def test_titles_links_and_references(spark):
    def title(page):
        return spark.createDataFrame([(page,)], "h string").select(html.read_page("h").alias("p")).select(html.page_title(F.col("p.titles"), F.col("p.text"))).first()[0]

    assert title('<div class="title"><div>Parte</div> resto</div>') == "Parte resto"
    assert title("<p>Detalhes bibliográficos</p><p>Antes</p><p>detalhes Bibliográficos</p>") == "Antes"
    assert title("<p>Detalhes bibliográficos</p><p>x</p>") is None
    assert title("<h1> </h1><p class='record-title'>Dois</p>") == "Dois"
    page = "<a data-href='/bad' HREF=/good>um <b>dois</b></a><a name=x>z</a><a href='a?b&amp;c'>aberto<iframe src=\"f.pdf\"></iframe><object data=o></object><embed src=e>"
    p = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(html.read_page("h").alias("p")).select("p.*").collect()
    assert [tuple(a) for a in p[0]["anchors"]] == [(0, "/good", "um dois"), (1, "a?b&c", "aberto")]
    assert [r["url"] for r in p[0]["refs"]] == ["/good", "a?b&c", "f.pdf", "e", "o"]
    assert p[1]["text"] is None and p[1]["anchors"] == [] and p[2]["refs"] == []


def test_metadata_row(spark):
    page = "<title>t</title><h1>Um título</h1><p>Detalhes bibliográficos</p><p>Ano de defesa: 2001</p><p>Autor:</p><p>Ana</p><p>Idioma: por</p><p>Metadados do item</p><p>País: x</p>"
    df = spark.createDataFrame([("https://c.example/Record/A_1/", page, 1), (None, None, 2)], "url string, html string, title int")
    rows = metadata.metadata_rows(df).collect()
    assert len(rows[0]) == 16 and rows[0]["record_id"] == "A_1" and rows[0]["title"] == "Um título" and rows[0]["year"] == "2001" and rows[0]["author"] == "Ana" and rows[0]["country"] is None
    assert rows[1]["record_url"] is None and rows[1]["title"] is None
    assert metadata.metadata_rows(df.limit(0)).count() == 0


def _model_a(url, there, got, visit):
    """Independent reading of strategy A for one address; ``visit`` is (ok, body, [candidate])."""
    if there:
        return True, "already_exists", None
    if ".pdf" in url.lower() and url in got:
        return True, None, url
    ok, body, found = visit
    if not ok:
        return False, "repository_unavailable", None
    if "acesso restrito" in body:
        return False, "restricted_or_embargo", None
    for c in sorted(found, key=lambda x: (-(50 if ".pdf" in x else 0) - (30 if "/bitstream/" in x else 0), x)):
        if c in got:
            return True, None, c
    return False, "pdf_not_found", None


def test_strategies(spark):
    r = random.Random(11)
    addresses, existing, responses, visits, want = [], [], [], [], {}
    for i in range(120):
        url = f"http://r{i % 40}.example/{r.choice(['x.pdf', 'item', 'items/00003a8b-16d5-49cd-890f-0000571fba49'])}"
        addresses.append((i, url))
        if r.random() < 0.1:
            existing.append((i, f"old/{i}"))
    urls_ = sorted({u for _, u in addresses})
    seen, got = {}, set()
    for u in urls_:
        host = u.split("/item")[0].split("/x.pdf")[0]
        body, ok, found = r.choice(["acesso restrito", "texto", "texto"]), r.random() < 0.8, [f"{host}/a.pdf", f"{host}/bitstream/b.pdf", f"{host}/c.pdf"]
        seen[u] = (ok, body, found)
        visits.append((u, ok, u, "t", body, "".join(f"<a href='{c}'>x</a>" for c in found)))
        for c in [u, *found]:
            if r.random() < 0.3:
                got.add(c)
                responses.append((c, r.choice([1, 2]), r.choice(["requests", "browser"]), 200, None, b"%PDF"))
            else:
                responses.append((c, 3, "requests", 200, None, b"%PDF"))  # beyond the attempts
                responses.append((c, 1, "requests", 404, None, b"%PDF"))
    old = {i for i, _ in existing}
    want = {i: _model_a(u, i in old, got, seen[u]) for i, u in addresses}
    kinds = ("id int, url string", "id int, path string", "url string, attempt int, channel string, status int, content_type string, body binary", "url string, ok boolean, page_url string, title string, body string, html string")
    a, e, s, v = (spark.createDataFrame(x, k) for x, k in zip((addresses, existing, responses, visits), kinds))
    out = repository.repository_results_a(a, e, s, v, "d").collect()
    assert len(out) == 120 and {x["id"]: (x["success"], x["reason"], x["pdf_url"]) for x in out} == want
    assert all(x["path"] == (f"old/{x['id']}" if x["id"] in old else f"d/{x['id']}.pdf" if x["success"] else None) for x in out)
    # strategy B: the http address fails, its twin opens an item whose second file downloads
    item = "00003a8b-16d5-49cd-890f-0000571fba49"
    a = spark.createDataFrame([(1, "http://h.example/p"), (2, "http://h.example/items/" + item), (3, "http://n.example/p"), (4, "http://d.example/x.pdf?y")], kinds[0])
    v = spark.createDataFrame([("http://h.example/p", False, None, None, None, None), ("https://h.example/p", True, f"https://h.example/items/{item}", "t", "b", ""), ("https://n.example/p", True, "https://n.example/p", "t", "404 Not Found", "")], kinds[3])
    f = spark.createDataFrame([(item, 0, 0, "u1"), (item, 0, 1, "u2")], "item string, pos int, file_pos int, bitstream string")
    s = spark.createDataFrame([(f"https://h.example{repository.CONTENT}u2/content", 1, "requests", 200, None, b"%PDF"), ("https://d.example/x.pdf?y", 1, "browser", 200, None, b"%PDF")], kinds[2])
    got = {x["id"]: x for x in repository.repository_results_b(a, e.limit(0), s, v, f, "d").collect()}
    assert got[1]["pdf_url"] == f"https://h.example{repository.CONTENT}u2/content" and got[1]["success"]
    assert not got[2]["success"] and got[2]["reason"] == "repository_unavailable"
    assert got[3]["reason"] == "not_found" and got[4]["pdf_url"] == "https://d.example/x.pdf?y"
    d = {x["url"]: tuple(x)[1:] for x in repository.downloads(a, s).collect()}
    assert d["http://d.example/x.pdf?y"] == (True, None, "https://d.example/x.pdf?y", "browser") and d["http://n.example/p"] == (False, "not_pdf", None, None)


def test_opened_pages(spark):
    df = spark.createDataFrame([("u",), ("w",), (None,)], "url string")
    r = spark.createDataFrame([("u", 1, "requests", 500, None, b"no"), ("u", 2, "requests", 200, "text/html", "<title>T</title><p>olá <a href='/x'>y</a>".encode())], "url string, attempt int, channel string, status int, content_type string, body binary")
    got = {x["url"]: x for x in fetch.opened(df, r).collect()}
    assert got["u"]["ok"] and got["u"]["title"] == "T" and "olá" in got["u"]["body"] and got["u"]["anchors"][0]["url"] == "/x"
    assert not got["w"]["ok"] and got["w"]["html"] is None


def test_settings(spark):
    from lavra.settings import Settings, job_settings

    assert Settings.of({}) == Settings() and Settings().max_records == 100
    got = Settings.of({"X_MAX_RECORDS": " 7 ", "X_HEADLESS": "\tYES\n", "X_MAX_RETRIES": "x", "X_REQUEST_TIMEOUT": "1_000"}, "X_")
    assert (got.max_records, got.headless, got.max_retries, got.request_timeout) == (7, True, 2, 1000)
    df = spark.createDataFrame([("a", "MAX_RECORDS", " 7 "), ("a", "HEADLESS", "\tYES\n"), ("a", "REQUEST_TIMEOUT", "1_000"), ("b", "MAX_RETRIES", "x"), ("b", None, None)], "job string, key string, value string")
    rows = {x["job"]: x for x in job_settings(df).collect()}
    assert (rows["a"]["max_records"], rows["a"]["headless"], rows["a"]["request_timeout"], rows["a"]["query"]) == (7, True, 1000, "Direito") and rows["b"]["max_retries"] == 2 and rows["b"]["headless"] is False
    assert one(spark, rules.bool_setting(F.col("v"), True), v="\tno\n") is False


def test_curated(spark):
    docs = spark.createDataFrame([(1, "A  b"), (2, "a B"), (3, None), (4, " "), (5, "x" * 2500)], "doc_id bigint, text string")
    assert {(x["doc_id"], x["n"]) for x in stages.distinct_texts(docs, "doc_id", "text").collect()} == {(1, 2), (5, 1)}
    assert [x["doc_id"] for x in stages.pretraining(docs).collect()] == [5]
    assert sorted((x["doc_id"], x["chunk_no"], len(x["chunk"])) for x in stages.chunks(docs).collect()) == [(1, 0, 3), (2, 0, 3), (5, 0, 1000), (5, 1, 1000), (5, 2, 900)]
    recs = spark.createDataFrame([(1, "t", "a "), (2, None, "a"), (3, "t", " ")], "row_no bigint, title string, abstract string")
    assert [[tuple(m) for m in x["messages"]] for x in stages.finetuning(recs).collect()] == [[("user", "t"), ("assistant", "a")]]
    assert stages.held_out(docs, share=100).count() == 2 and stages.held_out(docs, share=0).count() == 0
    assert [x["text"] for x in stages.extracted(spark.createDataFrame([(1, "<p> a <p>b<script>c</script>"), (2, None)], "k int, h string"), "k", "h").orderBy("k").collect()] == ["a\nb", None]
    assert stages.normalised(spark.createDataFrame([("e\u0301 ",)], "title string")).first()["title"] == "é"


def test_dspace(spark):
    assert one(spark, dspace.item_uuid("u"), u="https://r.example/items/00003a8b-16d5-49cd-890f-0000571fba49/x") == "00003a8b-16d5-49cd-890f-0000571fba49"
    df = spark.createDataFrame([("k", '{"_embedded": {"bundles": [{"name": "TEXT", "uuid": "1"}, {"name": "original", "uuid": "2"}, {"name": "ORIGINAL"}]}}'), ("l", "no json")], "k string, r string")
    assert [tuple(x) for x in dspace.original_bundles(df, "k", "r").collect()] == [("k", 1, "2")]


def test_fetch_keeps_errors(spark):
    fetch.register(spark)
    rows = spark.read.format("lavra_fetch").option("urls", "http://127.0.0.1:9/x").option("timeout", "1").load().collect()
    assert [(x["attempt"], x["status"]) for x in rows] == [(1, None), (2, None)]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, us in enumerate((["u1", "u2"], ["u2", "u3"])):
        (src / f"{i}.json").write_text('{"source": "s", "query": "q", "collected_at": "2024-01-0%dT00:00:00+00:00", "record_urls": ["%s"]}' % (i + 1, '", "'.join(us)))
    q = ingest.to_table(ingest.first_seen(ingest.envelope_stream(spark, str(src)), "10 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert sorted(x["url"] for x in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u1", "u2", "u3"]


def test_stream_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = '{"source": "s", "query": "q", "collected_at": "2024-01-01T%02d:30:00+00:00", "record_urls": ["u1", "u2"]}'
    for h in (1, 1, 2, 9):
        (src / f"{len(list(src.iterdir()))}.json").write_text(line % h)
    q = ingest.to_table(ingest.counts(ingest.envelope_stream(spark, str(src)), "1 hour", "2 hours"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    (src / "later.json").write_text(line % 15)  # moves the watermark past the first hours
    ingest.to_table(ingest.counts(ingest.envelope_stream(spark, str(src)), "1 hour", "2 hours"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted((x["start"].hour, x["n_links"]) for x in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 4), (2, 2), (9, 2)]


def test_browser_channel_and_layout(spark, tmp_path):
    rows = list(fetch.browse("http://127.0.0.1:9/x", 1))
    assert len(rows) == 1 and rows[0][2:4] == ("browser", None)
    assert fetch.fetched(spark.createDataFrame([("http://127.0.0.1:9/x",)], "url string"), channel="browser").first()["status"] is None
    for _ in range(2):
        assert all(x["there"] for x in stages.create_layout(spark, str(tmp_path)).collect())
    assert (tmp_path / "curated" / "rag").is_dir()


def test_stages(spark):
    r = spark.createDataFrame([(" a ", "1999", "x@y.example 123.456.789-00"), ("", "99", None)], "record_id string, year string, abstract string")
    assert [(x["record_id"], x["year"]) for x in stages.standardised(r).collect()] == [("a", 1999), (None, None)]
    assert stages.anonymised(r).first()["abstract"] == "[EMAIL] [CPF]"
    assert stages.layer("/d/", "staging") == "/d/staging"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("discovery", "records", "manifest", "documents", "events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = core.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(x[c]) for c in cols) for x in df.collect()), key=repr)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({core.oracle_sql()[name]})").fetchall()
    assert got == sorted((tuple(map(_norm, x)) for x in want), key=repr)
