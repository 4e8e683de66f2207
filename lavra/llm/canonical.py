"""Free-entered values to the closest entry of a reference list, in SQL only.

Steps, each one SQL statement over the distinct normalised values (never over the rows):

1. normalise: repair doubly encoded letters, lower case, plain letters, everything else to single blanks;
2. exact matches with labels and with known other names of an entry (``ALIASES``);
3. pigeonhole join: a label that allows k edits is cut into k+1 segments; a value within k edits holds one of
   them unchanged, shifted by at most k places, so an equality join on (field, segment) finds every candidate;
   built-in ``levenshtein`` verifies, the nearest label wins;
4. values without a candidate come from an anti-join and get the entry ``none``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lavra.session import table

FIELDS = ("language", "document_type", "access_type")

# Other names of the entries, normalised (lower case, plain letters, blanks for other signs).
ALIASES = {
    ("language", "por"): ["pt", "por", "port", "pt br", "pt pt", "ptbr", "portuguese", "lingua portuguesa", "lingua portugues", "portugues do brasil", "portugues brasil", "portugues brasileiro", "portugues portugal", "brazilian portuguese", "portugais"],
    ("language", "eng"): ["en", "eng", "ing", "ingl", "en us", "en gb", "english", "lingua inglesa", "ingles britanico", "ingles americano", "anglais"],
    ("language", "spa"): ["es", "spa", "esp", "es es", "espanol", "spanish", "castelhano", "castellano", "espanhol castelhano", "lingua espanhola", "espagnol"],
    ("language", "fra"): ["fr", "fra", "fre", "franc", "fr fr", "french", "francais", "lingua francesa", "frances franca"],
    ("language", "ita"): ["it", "ita", "ital", "it it", "italian", "lingua italiana", "italiano italia"],
    ("language", "deu"): ["de", "deu", "ger", "alem", "de de", "german", "deutsch", "lingua alema", "alemao alemanha"],
    ("language", "lat"): ["la", "lat", "latin", "lingua latina", "latim classico"],
    ("language", "glg"): ["gl", "glg", "gal", "galician", "gallego", "galego galiza", "lingua galega"],
    ("language", "cat"): ["ca", "cat", "catalan", "catala", "lingua catala", "catalao catalunha"],
    ("language", "jpn"): ["ja", "jp", "jpn", "jap", "japanese", "lingua japonesa", "nihongo", "日本語"],
    ("language", "rus"): ["ru", "rus", "russian", "lingua russa", "русский"],
    ("language", "ara"): ["ar", "ara", "arab", "arabic", "lingua arabe", "العربية"],
    ("language", "zho"): ["zh", "zho", "chi", "chin", "chinese", "mandarim", "lingua chinesa", "chines mandarim", "中文"],
    ("language", "nld"): ["nl", "nld", "dut", "hol", "dutch", "nederlands", "neerlandes", "lingua holandesa", "flamengo"],
    ("document_type", "tes"): ["tese de doutorado", "tese doutorado", "tese de doutoramento", "tese dout", "tese doc", "doutorado tese", "doctoral thesis", "doctoralthesis", "doctoral dissertation", "phd thesis", "tesis doctoral", "tese doutoral"],
    ("document_type", "dis"): ["dissertacao de mestrado", "dissertacao mestrado", "dissert mestr", "dissert", "mestrado dissertacao", "masterthesis", "master thesis", "master s thesis", "master s dissertation", "masters dissertation", "dissertacao de mestrado profissional"],
    ("document_type", "tcc"): ["tcc", "t c c", "tcc graduacao", "tcc graduacao", "trabalho conclusao curso", "trab de concl de curso", "trab concl curso", "bachelorthesis", "bachelor thesis", "trabalho de conclusao", "undergraduate thesis"],
    ("document_type", "art"): ["art", "article", "artigo cientifico", "artigo de periodico", "journal article", "artigo periodico"],
    ("document_type", "liv"): ["book", "livro impresso", "livro obra completa", "liv", "livro completo"],
    ("document_type", "cap"): ["capitulo", "cap de livro", "book chapter", "bookpart", "livro capitulo", "cap livro", "cap", "bookchapter"],
    ("document_type", "rel"): ["relatorio", "rel tecnico", "report", "technical report", "rel tec", "relatorio tec", "technicalreport"],
    ("document_type", "mem"): ["memorial", "mem acad", "memorial descritivo academico", "memorial descritivo", "academic memorial", "mem academico"],
    ("document_type", "pro"): ["projeto", "proj pesquisa", "research project", "proj de pesquisa", "pesquisa projeto", "projeto pesquisa"],
    ("document_type", "eve"): ["comunicacao em evento", "trabalho em evento", "trab apres em evento", "conference paper", "conferencepaper", "trabalho evento", "conferenceobject", "apresentacao em evento", "trabalho de evento"],
    ("access_type", "abe"): ["aberto", "openaccess", "open access", "livre", "acesso livre", "ac aberto", "acesso publico", "publico", "info eu repo semantics openaccess", "eu repo semantics openaccess", "abertoacesso", "aberto acesso"],
    ("access_type", "res"): ["restrito", "restrictedaccess", "restricted access", "ac restrito", "closed access", "closedaccess", "info eu repo semantics restrictedaccess", "info eu repo semantics closedaccess", "acesso fechado", "restrito acesso", "restritoacesso"],
    ("access_type", "emb"): ["embargado", "embargo", "embargoedaccess", "embargoed access", "under embargo", "ac embargado", "embargado ate", "acesso embargado meses", "acesso embargado ate", "info eu repo semantics embargoedaccess", "em embargo", "embargado acesso", "embargadoacesso"],
    ("access_type", "met"): ["metadados", "so metadados", "apenas metadados", "metadata only", "metadataonly", "metadadossomente", "metadados somente", "metadataonlyaccess", "info eu repo semantics metadataonlyaccess", "somente os metadados"],
    ("access_type", "loc"): ["local", "consulta no local", "somente consulta local", "on site only", "onsite only", "consulta in loco", "consulta presencial", "localconsulta", "local consulta", "in loco"],
}

# UTF-8 letters read as Latin-1 or Windows-1252, and what they stand for.
MOJIBAKE = {"Ã¡": "á", "Ã ": "à", "Ã¢": "â", "Ã£": "ã", "Ã¤": "ä", "Ã©": "é", "Ã¨": "è", "Ãª": "ê", "Ã­": "í", "Ã³": "ó", "Ã´": "ô", "Ãµ": "õ", "Ã¶": "ö", "Ãº": "ú", "Ã¼": "ü", "Ã§": "ç", "Ã±": "ñ", "Ã‡": "Ç", "Ã‰": "É", "Ãƒ": "Ã", "Ãš": "Ú", "Ã“": "Ó", "ÃŠ": "Ê", "Ã•": "Õ"}
# Accented letters and their plain forms, place by place.
ACCENTED, PLAIN = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"


def normal_sql(column: str) -> str:
    """The normal form of a column; the same text is valid in Spark SQL and DuckDB but for regexp_replace's 'g'."""
    out = column
    for bad, good in MOJIBAKE.items():
        out = f"replace({out}, '{bad}', '{good}')"
    return f"trim(regexp_replace(translate(lower({out}), '{ACCENTED}', '{PLAIN}'), '[^\\\\pL]+', ' '))"


def edits_sql(length: str) -> str:
    """Edits allowed for a label of that length."""
    return f"CASE WHEN {length} < 4 THEN 0 WHEN {length} < 6 THEN 2 WHEN {length} < 9 THEN 3 ELSE 4 END"


def alias_rows() -> str:
    """The known other names as the rows of a VALUES clause."""
    return ", ".join(f"('{f}', '{c}', '{a}')" for (f, c), names in ALIASES.items() for a in dict.fromkeys(names))


def canonical_values(records: DataFrame, canon: DataFrame, key: str = "row_no", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(``key``, ``field``, ``entry``) for each non-blank value of ``fields`` that isn't a label as it stands.

    ``entry`` is the code of the entry meant or ``none``. Null and blank values give no row; texts too long for any
    label go to ``none`` unread beyond their normal form. Equal distances are settled by the share of the label
    edited, then by the code. Repeated rows each give their row; other columns are ignored. The rows are scanned
    once for their distinct values (aggregated before the shuffle) and once to attach the result.
    """
    spark = records.sparkSession
    stack = f"stack({len(fields)}, " + ", ".join(f"'{f}', {f}" for f in fields) + ") AS (field, v)"
    typed = spark.sql(
        f"""SELECT k, t.field, t.v, {normal_sql("t.v")} AS n
            FROM (SELECT {key} AS k, {stack} FROM {{records}}) t
            LEFT ANTI JOIN {{canon}} c ON c.field = t.field AND c.label = t.v
            WHERE t.v IS NOT NULL AND t.v RLIKE '(?U)\\\\S'""",
        records=records,
        canon=canon,
    )
    names = spark.sql(f"SELECT field, code, {normal_sql('label')} AS r FROM {{canon}}", canon=canon)
    segments = spark.sql(
        f"""SELECT field, code, r, k, i, i * base + least(i, more) AS at, substring(r, int(i * base + least(i, more) + 1), int(base + int(i < more))) AS seg
            FROM (SELECT *, int(length(r) / (k + 1)) AS base, length(r) % (k + 1) AS more, explode(sequence(0, k)) AS i
                  FROM (SELECT *, {edits_sql("length(r)")} AS k FROM {{names}}))""",
        names=names,
    )
    values = spark.sql("SELECT DISTINCT field, n FROM {typed}", typed=typed)
    exact = spark.sql(
        f"""SELECT field, n, min(code) AS code
            FROM {{values}} JOIN (SELECT field, code, r AS n FROM {{names}}
                                  UNION SELECT * FROM VALUES {alias_rows()} AS a(field, code, n)) USING (field, n)
            GROUP BY field, n""",
        values=values,
        names=names,
    )
    rest = spark.sql("SELECT * FROM {values} LEFT ANTI JOIN {exact} USING (field, n)", values=values, exact=exact)
    near = spark.sql(
        """WITH wide AS (SELECT field, max(length(r) + k) AS most FROM {segments} GROUP BY field),
                sizes AS (SELECT DISTINCT field, length(seg) AS l FROM {segments}),
                places AS (SELECT rest.field, n, l, explode(sequence(1, length(n) - l + 1)) AS p
                           FROM {rest} rest JOIN sizes USING (field) JOIN wide USING (field)
                           WHERE length(n) BETWEEN l AND most),
                found AS (SELECT DISTINCT s.field, n, s.code, s.r, s.k
                          FROM (SELECT field, n, p, substring(n, p, l) AS seg FROM places) v
                          JOIN {segments} s ON s.field = v.field AND s.seg = v.seg
                          WHERE abs(v.p - 1 - s.at) <= s.k AND abs(length(v.n) - length(s.r)) <= s.k)
           SELECT field, n, min_by(code, (d, d / length(r), code)) AS code
           FROM (SELECT *, levenshtein(n, r) AS d FROM found) WHERE d <= k GROUP BY field, n""",
        segments=segments,
        rest=rest,
    )
    known = spark.sql("SELECT * FROM {exact} UNION ALL SELECT * FROM {near}", exact=exact, near=near)
    entries = spark.sql("SELECT field, n, coalesce(code, 'none') AS entry FROM {values} LEFT JOIN {known} USING (field, n)", values=values, known=known)
    return spark.sql(f"SELECT t.k AS {key}, t.field, e.entry FROM {{typed}} t JOIN {{entries}} e ON e.field = t.field AND e.n = t.n", typed=typed, entries=entries)


def unmatched_report(records: DataFrame, canon: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(``field``, ``value``, ``n_rows``): the values that mean no entry, with their number of rows."""
    found = canonical_values(records, canon, fields=fields)
    stack = f"stack({len(fields)}, " + ", ".join(f"'{f}', {f}" for f in fields) + ") AS (field, value)"
    return records.sparkSession.sql(
        f"""SELECT field, value, count(*) AS n_rows
            FROM (SELECT row_no, {stack} FROM {{records}}) JOIN {{found}} f USING (row_no, field)
            WHERE f.entry = 'none' GROUP BY field, value""",
        records=records,
        found=found,
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_values(table(spark, sf_dir, "records"), table(spark, sf_dir, "canon_values"))


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_report(table(spark, sf_dir, "records"), table(spark, sf_dir, "canon_values"))


def _duck_normal(column: str) -> str:
    return normal_sql(column).replace("\\\\pL", "\\pL").replace("+', ' ')", "+', ' ', 'g')")


def _found_cte() -> str:
    stacked = " UNION ALL ".join(f"SELECT row_no, '{f}' AS field, {f} AS v FROM records" for f in FIELDS)
    return f"""typed AS (SELECT row_no, field, v, {_duck_normal("v")} AS n FROM ({stacked}) t
                 WHERE v IS NOT NULL AND regexp_matches(v, '[^\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]')
                   AND NOT EXISTS (SELECT 1 FROM canon_values c WHERE c.field = t.field AND c.label = t.v)),
        names AS (SELECT field, code, {_duck_normal("label")} AS r FROM canon_values),
        vals AS (SELECT DISTINCT field, n FROM typed),
        exact AS (SELECT field, n, min(code) AS code FROM vals
                  JOIN (SELECT field, code, r AS n FROM names UNION SELECT * FROM (VALUES {alias_rows()}) a(field, code, n)) USING (field, n) GROUP BY field, n),
        near AS (SELECT field, n, code, row_number() OVER (PARTITION BY field, n ORDER BY d, d / length(r), code) AS best
                 FROM (SELECT field, n, code, r, levenshtein(n, r) AS d FROM vals JOIN names USING (field)
                       WHERE (field, n) NOT IN (SELECT (field, n) FROM exact))
                 WHERE d <= {edits_sql("length(r)")}),
        entries AS (SELECT field, n, coalesce(e.code, k.code, 'none') AS entry FROM vals LEFT JOIN exact e USING (field, n)
                    LEFT JOIN (SELECT * FROM near WHERE best = 1) k USING (field, n)),
        found AS (SELECT row_no, field, v, n, entry FROM typed JOIN entries USING (field, n))"""


def queries() -> dict:
    return {"p3_found": p3_found, "p3_unmatched": p3_unmatched}


def oracle_sql() -> dict[str, str]:
    """Brute force: every distinct value against every label."""
    return {
        "p3_found": f"WITH {_found_cte()} SELECT row_no, field, entry FROM found",
        "p3_unmatched": f"WITH {_found_cte()} SELECT field, v AS value, count(*) AS n_rows FROM found WHERE entry = 'none' GROUP BY field, v",
    }
