"""The text operators on small tables: their rules, and nulls, empty and long texts, ties, repeats and empty tables."""

import base64
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lavra.llm import canonical, encoding, language, mixing, names, plans, quality, scans, subjects, truncation

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("records", "canon_values", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = plans.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({plans.oracle_sql()[name]})").fetchall()
    rounded = lambda rows: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in rows), key=repr)
    assert rounded(tuple(x[c] for c in cols) for x in df.collect()) == rounded(want)


# problem 3
def test_canonical_edges(spark):
    canon = spark.read.parquet(f"{DATA}/canon_values.parquet")
    vals = ["Português", " ", "", None, "PORTUGUES", "Portugeus", "pt_BR", "x" * 100_000, "Esperanto", "PortuguÃªs", "Português"]
    df = spark.createDataFrame([(i, v, None, "f") for i, v in enumerate(vals)], "row_no bigint, language string, code string, field string")
    df = df.withColumns({"document_type": F.lit(None).cast("string"), "access_type": F.lit("info:eu-repo/semantics/openAccess")})
    got = {(x["row_no"], x["field"]): x["entry"] for x in canonical.canonical_values(df, canon).collect()}
    assert [got.get((i, "language")) for i in range(11)] == [None, None, None, None, "por", "por", "por", "none", "none", "por", None]
    assert got[(0, "access_type")] == "abe"
    assert canonical.canonical_values(df.limit(0), canon).count() == 0


# problem 8
@pytest.fixture(scope="module")
def odd_texts():
    r = random.Random(5)
    return ["", None, "a", "Olá, mundo!\n\n  it's 12 345", " \t \n", "日本語 emoji 🙂🙂", "x" * 20_000, "<|endoftext|> we'll", "a" + " " * 50 + "b", "".join(chr(r.choice([32, 97, 227, 10, 48, 46, 0x1F600, 0x2028])) for _ in range(3000)), "a"]


def test_ids_equal_the_tokenizer(spark, odd_texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id bigint, text string").withColumn("block", F.lit(1))
    got = {x["doc_id"]: x["ids"] for x in encoding.encode_corpus(df).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(odd_texts)}
    n = {x["doc_id"]: x["n_tokens"] for x in encoding.count_tokens(df).collect()}
    assert n == {i: len(v) for i, v in got.items()}
    back = encoding.decode(encoding.encode_corpus(df), encoding.token_bytes(spark))
    assert {x["doc_id"]: x["text"] for x in back.collect()} == {i: x or "" for i, x in enumerate(odd_texts)}
    assert encoding.encode_corpus(df.limit(0)).count() == 0
    assert encoding.rank_table("byte_bpe_50k")[base64.b64decode("IQ==")] == 0


# problem 4
def test_banded_distance_against_brute_force():
    def full(a, b):
        d = {(i, j): max(i, j) for i in range(-1, len(a) + 1) for j in range(-1, len(b) + 1) if min(i, j) <= 0}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    r = random.Random(6)
    for _ in range(3000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 7))) for _ in range(2))
        assert names.banded(a, b, 2) == min(full(a, b), 3), (a, b)


def test_names_of_bodies(spark):
    same = ["Universidade Federal de Lipalha", "UNIVERSIDADE FEDERAL DE LIPALHA", "Lipalha, Universidade Federal de", "Lipalha (Universidade Federal de)", "Univ. Fed. Lipalha", "Univerisdade Federal de Lipahla", "Universidade Federal de Lipalha - UFLI", "UFLI", "Federal University of Lipalha", " Universidade Federal  de Lipalha"]
    other = ["Universidade Estadual de Lipalha", "Universidade Federal de Lipalha do Sul", "F. Univ. Lipalha"]
    df = spark.createDataFrame([(v,) for v in [*same, *other, same[0], None, " "]], "institution string").withColumns({"graduate_program": F.lit("Prog. de Pós-Graduação em Dire. Civil"), "department": F.lit(None).cast("string")})
    full = spark.createDataFrame([("Programa de Pós-Graduação em Direito Civil",), ("PPGDC",), ("PPG em Direito Civil",), ("Programa de Pós-Graduação em Direito Penal",)], "graduate_program string").withColumns({"institution": F.lit(None).cast("string"), "department": F.lit(None).cast("string")})
    pairs = {tuple(x) for x in names.linked_pairs(names.name_classes(df.unionByName(full))).collect()}
    want = {("institution", a, b) for a in same for b in same if a < b}
    p = ["Prog. de Pós-Graduação em Dire. Civil", "Programa de Pós-Graduação em Direito Civil", "PPGDC", "PPG em Direito Civil"]
    assert pairs == want | {("graduate_program", a, b) for a in p for b in p if a < b}
    assert names.name_classes(df.limit(0)).count() == 0


def test_misspelt_names_of_any_number_of_spellings(spark):
    p = "Programa de Pós-Graduação em "
    rows = [(p + "Economia do Trabalho", 14), ("Programa de Pós Graduação em Enonomia do Trabalho", 1)]  # one spelling each
    rows += [(w + "Horticultura", 60) for w in (p, p.upper(), "PPG em ", "Prog. de Pós-Graduação em ", "Pós-Graduação em ")]
    rows += [(w + "Horticultra", 9) for w in (p, p.upper(), "PPG em ", "Pós-Graduação em ")]  # four spellings
    rows += [(p + "Horticltra", 2)]  # two edits
    rows += [(p + "Ecologia", 116), (p + "Geologia", 4), (p + "Oncologia", 1)]
    rows += [(p + w, n) for w, n in (("Abcdefghijkl", 64), ("Abcdefghijlk", 32), ("Abcdefghjilk", 16), ("Abcdefhgjilk", 8), ("Abcdfehgjilk", 4))]  # a chain
    df = spark.createDataFrame([(n,) for n, c in rows for _ in range(c)], "graduate_program string").withColumns({"institution": F.lit(None).cast("string"), "department": F.lit(None).cast("string")})
    got = {}
    for x in names.name_classes(df).collect():
        got.setdefault(x["body"], set()).add(x["name"])
    all_ = [n for n, _ in rows]
    assert sorted(got.values(), key=min) == sorted([set(all_[:2]), set(all_[2:12]), {all_[12]}, {all_[13]}, {all_[14]}, set(all_[15:])], key=min)


# problem 5
def test_gradients_by_differences():
    net = language.Network(["a", "b", "c"], units=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(2)
    codes = r.integers(0, 256, (7, 3)).astype(np.int16)
    codes[5:, 1] = 256
    labels, w = np.array([0, 2, 1]), np.array([1.0, 0.5, 2.0], np.float32)
    _, g = net.gradients(codes, labels, w)
    for k in ("uf", "ub", "o", "c"):
        for _ in range(6):
            i = tuple(r.integers(0, n) for n in net.p[k].shape)
            old = net.p[k][i]
            net.p[k][i] = old + 1e-3
            up = net.gradients(codes, labels, w)[0]
            net.p[k][i] = old - 1e-3
            down = net.gradients(codes, labels, w)[0]
            net.p[k][i] = old
            assert abs((up - down) / 2e-3 - g[k][i]) < 2e-3


def test_weights_are_the_mean_of_the_last_steps():
    net, seen = language.Network(["a", "b"], units=4), []
    gradients = net.gradients
    net.gradients = lambda *x: (seen.append({k: v.copy() for k, v in net.p.items()}), gradients(*x))[1]
    language._fit(net, [(b"uma tese de direito", 0), (b"the thesis of law", 1)] * 100, np.ones(2), 10, 1)
    for k, v in net.p.items():  # the weights after steps 7, 8 and 9 are seen; so the mean tells those after step 10
        last = 4 * v - sum(s[k] for s in seen[7:])
        assert np.abs(last - seen[9][k]).max() < 0.01


def test_scores_are_those_of_the_trained_states():
    net, texts = language.Network(["a", "b", "c"], units=4, seed=5), [b"uma tese", b"", b"x", "é o estudo do direito".encode()]
    net.p["xf"] *= 6  # so that gates close and contents reach their bounds
    for text, got in zip(texts, net.score(texts)):
        if text:
            states = net.run(np.frombuffer(text, np.uint8).astype(np.int16)[:, None])[0]
            y = np.concatenate([states[1:, 0], states[:0:-1, 1]], 2)[:, 0] @ net.p["o"] + net.p["c"]
            assert got == pytest.approx((y - np.log(np.exp(y).sum(1, keepdims=True))).mean(0), abs=1e-4)
        else:
            assert not got.any()


def test_sentences_are_scored_together(monkeypatch):
    calls, score = [], language.Network.score
    monkeypatch.setattr(language.Network, "score", lambda net, texts: (calls.append(len(texts)), score(net, texts))[1])
    texts = [("Uma tese de direito. A prova.", "por"), ("The thesis of law. The proof.", "eng")] * 20
    net = language.train(texts, {"por": 0.5, "eng": 0.5}, (3, 3))
    language.tempered(net, [*texts, ("", "eng")], {"por": 0.5, "eng": 0.5})
    assert calls == [80, 80, 80]


def test_best_path_against_all_paths():
    import itertools

    r = np.random.default_rng(3)
    for _ in range(50):
        s = r.normal(0, 8, (4, 3))
        value = lambda p: sum(s[i, c] for i, c in enumerate(p)) - 5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=4), key=value)
        assert value(language.best_path(s, 5.0)) == pytest.approx(value(best))


def test_languages_learned(spark):
    rows = duckdb.sql(f"SELECT r.row_no, c.code, r.abstract, r.title AS lang FROM '/root/testdata/sf0.01/records.parquet' r JOIN '{DATA}/canon_values.parquet' c ON c.field = 'language' AND c.label = r.language WHERE c.code IN ('por', 'eng', 'spa', 'fra')").fetchall()
    df = spark.createDataFrame(rows, "row_no bigint, code string, abstract string, lang string")
    nouns, verbs = "Arbeit Schule Richter Gericht Stadt Quelle Lehrer Krankheit Wirtschaft Geschichte".split(), "untersucht beschreibt vergleicht beleuchtet erörtert".split()
    r = random.Random(12)
    german = lambda: " ".join(f"Die {r.choice(nouns)} {r.choice(verbs)} die {r.choice(nouns)} zwischen {r.randint(2, 90)} Jahren und der {r.choice(nouns)}." for _ in range(5))
    rare = spark.createDataFrame([(10**6 + i, "deu", german()) for i in range(25)], "row_no bigint, code string, abstract string")  # a rare language is a class too
    wrong = spark.createDataFrame([(2 * 10**6 + i, "lat", rows[i][2]) for i in range(25) if rows[i][2]], "row_no bigint, code string, abstract string")  # a label without texts of its own is none
    net = language.fit_languages(df.select("row_no", "code", "abstract").unionByName(rare).unionByName(wrong), "row_no", "abstract", "code", sample=60)
    assert "deu" in net.classes and language.segments(net, [german()])[0][0][0] == "deu" and "lat" in net.dropped
    text = {"eng": "The research discusses judicial review within the legal order.", "por": "A pesquisa descreve o dano moral nos tribunais estaduais, e a coleta ocorreu em duas etapas.", "spa": "Este trabajo analiza la deserción escolar en los primeros grados de las escuelas."}
    mixed = f"Resumo: {text['por']} {text['por']} Palavras-chave: dano moral; prova. Abstract: {text['eng']}"
    odd = [(1, mixed), (2, None), (3, " "), (4, text["spa"] * 2000), (5, "Palavras-chave: dano moral"), (6, "."), (1, text["spa"])]
    got = {}
    for x in language.language_segments(spark.createDataFrame(odd, "k bigint, t string").withColumn("lang", F.lit("z")), net, "k", "t").orderBy("seg_no").collect():
        got.setdefault((x["k"], x["n_segments"]), []).append(x["lang"])
    assert got[(1, 2)] == ["por", "eng"] and got[(1, 1)] == ["spa"] and got[(4, 1)] == ["spa"]
    assert not {k for k, _ in got} & {2, 3} and len(got[(5, 1)]) == 1
    held = [(i, c, a) for i, c, a, _ in rows if a and i % 7 == 0][:200]
    best = [max(s, key=lambda q: q[2]) if s else (c, 1.0, 0) for s, (_, c, _) in zip(language.segments(net, [a for _, _, a in held]), held)]
    right = np.mean([s[0] == c for s, (_, c, _) in zip(best, held)])
    assert right > 0.85  # some labels are wrong
    assert abs(np.mean([s[1] for s in best]) - right) < 0.08  # and the confidence knows
    heading = "A tese trata do dano moral nos tribunais estaduais"
    for mark in ("Abstract. The thesis", "Abstract- The thesis", "ABSTRACT The thesis", "Keywords: x"):
        assert language.sentences(f"{heading} {mark}") == [heading, mark]
    assert language.sentences(f"{heading}. Palavras-chave. dano, prova") == [f"{heading}.", "Palavras-chave. dano, prova"]


# problem 6
def test_cut_lengths_and_endings(spark):
    r = random.Random(8)
    words = ["prova", "ilicita", "estado", "escola", "rural", "tese", "texto", "campo"]
    rows = []
    for i in range(3000):
        t = " ".join(" ".join(r.choice(words) for _ in range(r.randint(4, 9))) + " no codigo vigente." for _ in range(r.randint(3, 9)))
        rows.append((i, "s" if i % 2 else "u", t))
    cut = [(i, s, t[:200] if s == "s" and len(t) > 200 else t) for i, s, t in rows]
    extra = [(9001, "u", "A tese foi feita no codigo vigente. A prova no codigo vig"), (9002, "u", "A tese no codigo vigente. Texto do campo no codigo vigente"), (9003, "u", "A prova no codigo vigente. O texto da tese no codigo vigente..."), (9004, "u", None), (9005, "u", " "), (9006, None, "Texto no codigo vigente. A escola &"), (9006, None, "Texto no codigo vigente. A escola &")]
    df = spark.createDataFrame(cut + extra, "row_no bigint, source string, abstract string").withColumn("length", F.lit(1))
    got = [x["row_no"] for x in truncation.truncated(df).collect()]
    assert {9001} <= set(got) and got.count(9006) == 2 and not set(got) & {9002, 9003, 9004, 9005}
    true = {i for i, s, t in cut if s == "s" and len(t) == 200 and not t.rstrip().endswith(".")}
    small = {i for i in got if i < 9000}
    assert true <= small and len(small - true) <= 5
    assert truncation.truncated(df.limit(0)).count() == 0


def test_cuts_beside_a_stronger_cut(spark):
    n = {k: 20 for k in range(300, 500)} | {398: 700, 399: 250, 400: 2000}
    hill = {k: 20 for k in range(300, 500)} | {397: 500, 398: 700, 399: 800, 400: 700, 401: 500}
    df = spark.createDataFrame([(s, "chars", k, v) for s, d in (("s", n), ("u", hill)) for k, v in d.items()] + [(s, "chars", 900, 9000) for s in "su"], "source string, measure string, length int, n bigint")
    got = {(x["source"], x["length"]) for x in truncation.cut_lengths(df).collect() if x["length"] < 500}
    assert got == {("s", 398), ("s", 399), ("s", 400)}


def test_keyword_lists_with_any_sign(spark):
    r = random.Random(3)
    t = [f"O texto {r.choice('abc')} do codigo vigente. A prova do estado no codigo vigente. Palavras-chave. dano moral; prova ilicita; {w}." for w in ("tribunal de justica", "ordem publica") for _ in range(20)]
    cut = ["O texto do codigo vigente. Palavras-chave - dano moral; tribunal de jus", "O texto do codigo vigente. Palavras-chave. dano moral; ordem publica"]
    df = spark.createDataFrame([(i, "s", x) for i, x in enumerate(t + cut)], "row_no bigint, source string, abstract string")
    assert [(x["row_no"], x["kind"]) for x in truncation.truncated(df).collect()] == [(40, "ending")]


# problem 7
def test_tree_without_labels(spark):
    r = random.Random(4)
    own = {a: [f"{x}{y}{a}bcd" for x in "kmnp" for y in "aeiou"] for a in "xyz"}
    rows = [(i, " ".join(r.choice(own["xyz"[i % 3]]) for _ in range(12)) + ".") for i in range(600)]
    blocks = subjects.coded_texts(spark.createDataFrame(rows, "k bigint, t string").repartition(3), "k", "t")
    n = blocks.select(F.sum(F.size("keys"))).first()[0]
    space = subjects.Space(blocks.select(F.inline("df")).groupBy("place").agg(F.sum("d").alias("d")).toPandas(), n)
    tree = subjects.grow(blocks, space, leaves=3)
    leaf = {x["k"]: x["leaf"] for x in subjects._leaf_of(blocks, space, tree, "k").collect()}
    assert n == 600 and len(set(leaf.values())) == 3
    assert all(len({leaf[i] for i in range(600) if i % 3 == a}) == 1 for a in range(3))


def test_subjects(spark):
    r = random.Random(9)
    own = {a: [f"{a}{x}{y}" for x in "aeiou" for y in "lmnr"] for a in ("dir", "sau")}
    rows, sample = [], []
    for i in range(400):
        a = "dir" if i % 2 else "sau"
        s = [f"O texto trata de {r.choice(own[a])} e de {r.choice(own[a])} no ano." for _ in range(4)]
        rows.append((i, f"Programa de Pós-Graduação em {'Direito' if a == 'dir' else 'Medicina'}", " ".join(s)))
        if i % 10 < 2:
            sample.append((i, a))
    rows += [(1000, "PPG em Direito", None), (1001, None, None), (1002, "Programa de Pós-Graduação em Medicina", ""), (1003, None, "O texto trata de diral e de direm. A obra trata de saual e de sauem. O ano foi longo."), (1004, None, "xyz")]
    recs = spark.createDataFrame(rows, "row_no bigint, graduate_program string, abstract string").withColumn("area", F.lit("?"))
    areas = spark.createDataFrame([("dir", "Direito", "tribunais"), ("sau", "Saúde", "hospitais")], "area string, area_name string, scope_note string")
    samp = spark.createDataFrame(sample, "row_no bigint, area string")
    got = {}
    for x in subjects.record_areas(recs, samp, areas).collect():
        got.setdefault(x["row_no"], set()).add(x["area"])
    assert all(got[i] == {"dir" if i % 2 else "sau"} for i in range(400))
    assert got[1000] == {"dir"} and got[1002] == {"sau"} and got[1003] == {"dir", "sau"} and not {1001, 1004} & set(got)
    assert subjects.record_areas(recs.limit(0), samp, areas).count() == 0
    assert subjects.record_areas(recs.limit(3), samp, areas).count() == 0  # no term is evidence
    assert subjects.record_areas(recs, samp, areas.limit(0)).count() == 0
    assert subjects.record_areas(recs.limit(60), samp.limit(0), areas).count() >= 0  # only the notes name leaves


# problem 9
def test_mixture(spark):
    r = random.Random(10)
    sizes = [(i, r.choice(["a", "a", "a", "b", "c"]), r.randint(0, 900)) for i in range(4000)] + [(9000, None, 10), (9001, "z", 10)]
    df = spark.createDataFrame(sizes, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.2, 3), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    plan = mixing.solve(df, targets)
    m = mixing.mixture(df, plan).cache()
    cap = {"a": 1, "b": 2, "c": 3}
    rows = m.collect()
    assert len(rows) == len(sizes)
    assert all(0 <= x["copies"] <= cap.get(x["source"], 0) and abs(x["copies"] - x["rate"]) < 1 + 1e-6 for x in rows)
    got = {x["source"]: x["actual_share"] for x in mixing.shares(m, plan).collect()}
    assert abs(got["a"] - 0.4) < 0.005 and abs(got["b"] - 0.4) < 0.005 and abs(got["c"] - 0.2) < 0.005
    assert mixing.mixture(df.limit(0), mixing.solve(df.limit(0), targets)).count() == 0
    with pytest.raises(ValueError, match="no multipliers"):
        mixing.solve(df, targets, steps=1)
    with pytest.raises(ValueError, match="two targets"):
        mixing.solve(df, targets.union(targets))


# problem 10
def test_kinds(spark):
    rows, want = [], {}
    for k, texts in quality.EXAMPLES.items():
        for j, t in enumerate(texts):
            for n in range(6):
                rows.append((len(rows), t + ("\n" if "\n" in t else " ") * (n > 2) + (t if n > 2 else "")))
                want[len(rows) - 1] = k
    base = len(rows)
    rows += [(base, None), (base + 1, " \n"), (base + 2, "a" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digits", F.lit(1))
    stats = quality.text_statistics(df).cache()
    got = {x["doc_id"]: x["kind"] for x in quality.document_kinds(stats, quality.fit_mixture(stats)).collect()}
    assert base not in got and base + 1 not in got and got[base + 2] == "junk"
    assert np.mean([got[i] == k for i, k in want.items()]) > 0.9
    signs = [(1, "que, de; (não) para"), (2, "que\tde\tnão\tpara"), (3, "que de não para"), (4, "bcdf, xyz"), (5, "casa\u00a0azul")]
    x = {y["doc_id"]: y for y in quality.text_statistics(spark.createDataFrame(signs, "doc_id bigint, text string")).collect()}
    assert x[1]["common"] == x[2]["common"] == x[3]["common"] == 1 and x[4]["vowelless"] == 0.5 or x[4]["vowelless"] == 1
    one = stats.where(f"doc_id = {base}").first()
    assert one["n_words"] == 0 and one["n_lines"] == 0 and one["word_len"] is None
    assert quality.document_kinds(stats.limit(0), quality.fit_mixture(stats.limit(0))).count() == 0


# problem 1
def test_scanned_pages(spark):
    text = ["A dissertação descreve a prova ilícita nas relações de", "consumo e retoma o contrato de adesão na jurisprudência", "recente. A pesquisa discute o dano moral com destaque", "para o período posterior. Discutem-se os bem-estar no campo."]
    own = lambda i, k: "".join("bcdfglmnpr"[int(d)] + v for d, v in zip(f"{i * 7 + k:04d}", "aeio"))
    rows = [(i, "v.pdf", i, "\n".join(["FACULDADE DE DIREITO", f"Um {own(i, 0)} de", *text, f"com {own(i, 1)} e de", f"por {own(i, 2)} ou por", f"- {i} -"])) for i in range(1, 41)]
    bad = "FACULDAD3 DE DIREITO\r\nA dissertação dcscreve a prova ilí-\r\ncita nas relaçõe5 de consumo. Discutem-\r\nse os bem-\r\nestar no carnpo.\r\n\r\n- 41 -"
    rows += [(41, "v.pdf", 41, bad), (42, "w.pdf", 1, None), (43, None, None, ""), (44, "x.pdf", 1, "palavra " * 50_000)]
    df = spark.createDataFrame(rows, "page_id bigint, pdf_path string, page_no int, raw_text string").withColumn("form", F.lit("x"))
    got = {(x["page_id"], x["line_no"], x["kind"]) for x in scans.noisy_lines(df).collect()}
    assert {x for x in got if x[0] == 1} == {(1, 1, "running"), (1, 9, "page_number")}
    assert {x for x in got if x[0] == 41} - {(41, 1, "running")} == {(41, 2, "split_word"), (41, 2, "misread"), (41, 3, "misread"), (41, 5, "misread"), (41, 7, "page_number")}
    assert not {x for x in got if x[0] > 41}
    fixed = {x["page_id"]: x["text"] for x in scans.repaired_pages(df).collect()}
    assert fixed[41].endswith("A dissertação descreve a prova ilícita nas relações de consumo. Discutem-se os bem-estar no campo.")
    assert fixed[42] is None and fixed[43] == ""
    assert scans.noisy_lines(df.limit(0)).count() == 0


def test_keys_of_long_words():
    long = "".join(random.Random(2).choice("abcdefghij") for _ in range(90))
    read = long[:10] + "rn" + long[10:70] + "0" + long[71:]
    assert scans.index_keys(long) & scans.lookups(read) and not scans.index_keys(long) & scans.lookups("z" * 90)
    word = "m" * 45 + "extenso"
    assert scans.weighted(word, word.replace("ext", "cxt")) == scans.COST and scans.weighted("a" * 500 + "m", "a" * 500 + "rn") == scans.COST
    assert max(map(len, (scans.index_keys("x" * 100_000), scans.lookups("rn" * 50_000)))) < 200


def test_hot_words(spark):
    from lavra.llm import blocks

    r = random.Random(1)
    rows = [(b, "de") for b in range(400)] + [(b, f"w{r.randint(0, 300)}") for b in range(400)]
    words = spark.createDataFrame(rows, "block int, word string").distinct()
    table = spark.createDataFrame([("de", 1), ("w7", 2), ("absent", 3)], "word string, id int")
    counts = words.groupBy("word").agg(F.count("*").alias("blocks"))
    hot = blocks.often(counts, "word", 400)
    assert [x["word"] for x in hot.collect()] == ["de"]
    got = blocks.join_words(words, table, "word", hot)
    assert sorted(map(tuple, got.select("block", "word", "id").collect())) == sorted(map(tuple, words.join(table, "word").select("block", "word", "id").collect()))


def test_weighted_distance():
    assert scans.weighted("campo", "carnpo") == scans.COST
    assert scans.weighted("ilícita", "lícita") > 1
    assert scans.weighted("relações", "relaçõe5") == scans.COST
    assert scans.number_of("xiv") == 14 and scans.number_of("l5") == 15 and scans.number_of("texto") is None


def _volume(pages: list[list[str]], path: str | None = "v.pdf", first: int = 1):
    return [(first + i, path, i + 1, "\n".join(lines)) for i, lines in enumerate(pages)]


def test_divided_words_over_a_page_end(spark):
    text = ["A dissertação descreve a prova ilícita e o campo do bem-estar nas relações de", "consumo e retoma o contrato de adesão na jurisprudência com alguma frequência"]
    rows = _volume([[*text, "bemol bemvindo."] for _ in range(30)], "w.pdf", 100)
    rows += _volume([["    Discute-se nesta volta a prova ilí-", "", "- 7 -"], ["- 8 -", "", "cita e o outro bem-", "- 8 -"], ["estar nas rela\xad"], ["çõe5 de consumo e de", ""], ["- 11 -"], ["adesão. Fim."], ["    Outro parágrafo do jurispru-"]])
    rows += _volume([["Descreve a prova ilí-"]], None, 50) + _volume([["cita que nada tem com ela."]], None, 60)
    df = spark.createDataFrame(rows, "page_id bigint, pdf_path string, page_no int, raw_text string")
    got = {(x["page_id"], x["line_no"], x["kind"]) for x in scans.noisy_lines(df).collect() if x["page_id"] < 100}
    # bem-estar is a compound broken at its own hyphen; relaçõe5 is misread on the page of its wrong letter
    assert {x for x in got if x[2] in ("split_word", "misread")} == {(1, 1, "split_word"), (3, 1, "split_word"), (4, 1, "misread"), (7, 1, "split_word"), (50, 1, "split_word")}
    fixed = {x["page_id"]: x["text"] for x in scans.repaired_pages(df).collect()}
    assert fixed[1].endswith("a prova ilícita") and fixed[2].endswith("o outro bem-estar") and fixed[3] == "nas relações" and fixed[4] == "de consumo e de"
    out = sorted(scans.repaired_volumes(df).where("pdf_path = 'v.pdf'").collect(), key=lambda x: (x["page_no"], x["page_id"], x["pos"]))
    assert [(x["page_no"], x["pos"], x["text"]) for x in out] == [(1, 0, "Discute-se nesta volta a prova ilícita e o outro bem-estar nas relações de consumo e de adesão. Fim."), (7, 0, "Outro parágrafo do jurispru-")]
    assert scans.repaired_volumes(df.where("pdf_path IS NULL")).count() == 2 and scans.repaired_volumes(df.limit(0)).count() == 0


def test_neighbours_beyond_a_block(spark):
    n = scans.WINDOW * 3
    df = spark.range(n).selectExpr("'v' AS volume", "int(id) AS page_no", "id AS page_id", f"IF(id < 3 OR id = {n - 2}, id, NULL) AS x").where(f"id < 5 OR id >= {n - 2}")
    got = {x["page_id"]: (x["prev"], x["next"]) for x in scans.beside(df, F.col("x"), F.col("page_id")).collect()}
    assert got == {0: (None, 1), 1: (0, 2), 2: (1, 3), 3: (2, 4), 4: (2, n - 2), n - 2: (2, n - 1), n - 1: (n - 2, None)}
