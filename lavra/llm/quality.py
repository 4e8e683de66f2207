"""Text statistics of documents, and their kind by a Gaussian mixture.

1. Statistics of every document (one scan, no shuffle).
2. A Gaussian mixture with diagonal covariances is fitted to the standardised statistics of *all* documents by
   expectation-maximisation: each step sums responsibilities, first and second moments per component inside the
   partitions and then over them; only these sums (components x statistics) reach the driver.
3. Components start at the statistics of inspected examples and take the kind of the examples that they claim.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.session import spread, table, written

# Frequent function words of the five languages of the corpus.
COMMON = "a à ao aos as às o os e de da do das dos em na no nas nos um uma por para com que se não como entre foi são the of and to in is that this by with for are was were on we at from has el la los las y en del un una por para con que se su es le les des du et une dans pour par sur est que qui ne au aux il lo gli di della dello dei delle nel nella per con si che è una sono ha al".split()

_COMMON = set(COMMON)

# Names of the statistics, in order.
STATS = ("word_len", "symbols", "digits", "upper", "common", "stops", "line_stops", "semicolons", "bullets", "labels", "leaders", "cells", "numbers", "garbled", "vowelless", "longest", "repeats", "references")

# Inspected examples by kind: how texts of the corpus look, shortened.
EXAMPLES = {
    "prose": [
        "A tese defende uma leitura renovada sobre a prova ilícita nas relações de consumo. O método adotado foi comparativo, com análise documental e revisão sistemática. Os resultados foram organizados em cinco blocos. Para isso, foram reunidos 36 registros que envolvem o desmatamento.\n\nCabe registrar que as limitações do estudo não invalidam as conclusões. A coleta ocorreu em duas etapas, ambas descritas no apêndice.",
        "Por fim, propõe-se um roteiro para acompanhar o controle judicial nas\nrelações de consumo. Nesse quadro, o recorte temporal vai de 1995 até\nos dias atuais. Para isso, foram examinados 178 casos que envolvem a\nexecução fiscal na jurisprudência recente. Conclui-se que ainda há\nespaço para novas perguntas sobre o tema.\n\nA coleta ocorreu em três etapas, detalhadas\nno anexo final.",
        "POR FIM, PROPÕE-SE UMA AGENDA PARA ACOMPANHAR O AQUECIMENTO ARTICULAR APÓS SESSÕES INTENSAS. O RECORTE TEMPORAL VAI DE 1987 ATÉ OS DIAS ATUAIS. CONCLUI-SE QUE AINDA HÁ ESPAÇO PARA NOVAS PERGUNTAS SOBRE O TEMA.",
        "The findings show that food inflation has become more relevant under high interest rates since 1974. The research addresses rural credit in the retail sector, with special attention to the years after 2018. It was observed that bank concentration depends on factors rarely described.",
        "O texto examina a adubação orgânica sob seca prolongada. Os dados indicam que o regime de chuvas ganhou relevância desde 1990 (FABELO, 1975, p. 184). A amostra foi composta por 29 participantes:\n1. O plantio direto;\n2. A mata ciliar;\n3. A erosão do solo.\nEm seguida, a discussão permanece aberta, e o texto indica caminhos possíveis. Verificou-se, em 12 por cento das situações, que a hipertensão teve papel secundário no desfecho.",
        "Las entrevistas duraron 241 minutos en promedio y fueron transcritas. En el 93 por ciento de las situaciones, la evaluación del aprendizaje tuvo un papel menor. Este trabajo analiza la deserción escolar en los primeros grados.",
        "Nous étudions comment la détention provisoire se rapporte aux changements observés selon le code en vigueur. La thèse soutient que le contrôle du juge et la preuve illicite ne peuvent pas être séparés.",
        "Il campione era composto da 262 partecipanti scelti per convenienza. Questo studio esamina la dispersione scolastica tra i nuovi docenti. La ricerca affronta il nuoto agonistico nei giovani atleti.",
        "O recorte temporal vai de 2019 até os dias atuais.",
        "Utilizou-se um questionário com 68 perguntas fechadas.",
        "This is a descriptive study carried out in 2018.",
        "Se trata de un estudio exploratorio realizado en 1995.",
        "Il s'agit d'une étude exploratoire menée en 1995.",
    ],
    "list": [
        "tutela coletiva; habeas corpus; inquérito policial; sentença condenatória; responsabilidade civil; usucapião urbana; prova ilícita; dano moral; controle judicial; prisão preventiva; acordo de arbitragem",
        "Palavras-chave: mata ciliar, plantio direto, erosão do solo, regime de chuvas, sequestro de carbono, controle de pragas, adubação orgânica, fauna ribeirinha, qualidade da água",
        "Autor: Trefanes\nTítulo: a formação docente\nFolhas: 179\nFormato: 30 cm\nAssunto: a leitura em voz alta\nAssunto: a avaliação da aprendizagem\nAssunto: a sala multisseriada\nAssunto: o currículo escolar",
        "1. O projeto pedagógico em escolas rurais\n2. A sala multisseriada\n3. O livro didático no ensino médio\n4. A formação docente;\n5. A educação inclusiva\n6. A evasão escolar;\n7. O estágio supervisionado",
        "1) Student reading;\n2) Inclusive education\n3) Student reading in the early grades\n4) The school curriculum in the early grades\n5) Classroom assessment;\n6) Textbook use",
        "* a alfabetização tardia em escolas rurais\n* o estágio supervisionado na pós-graduação\n* a formação docente entre professores recém-formados\n* a leitura em voz alta em turmas noturnas",
        "- o plantio direto\n- a mata ciliar em bacias hidrográficas\n- a erosão do solo;\n- o regime de chuvas\n- a fauna ribeirinha",
        "SUMÁRIO\n1.2 A fauna ribeirinha _____________ 15\n1.3 O plantio direto ................................. 21\n1.4 O sequestro de carbono . . . . . . . . . 34\n2.3 O regime de chuvas ............................ 56\n2.4 O manejo da irrigação ............. 57",
        "REFERÊNCIAS\nFABELO, J. A prova ilícita. Revista de Direito, v. 12, n. 3, p. 14-29, 1987.\nPANEM, T. A mata ciliar em pomares. São Zeta: Editora Norte, 1975. 230 p.\nSIRAILO, R.; LADOTI, M. O livro didático. 2. ed. Porto: Campo, 2018.",
    ],
    "table": [
        "| Item | N | % | Grupo | Total | Valor |\n| acordo de arbitragem | 615,3 | 132,2 | 1088 | 111,6 | 274 |\n| execução fiscal | 138,8 | 842,6 | 1900 | 33,1 | 12 |\n| Grupo 3 | 1277 | 844,2 | 110,0 | 5 | 6 |",
        "Item\tGrupo\tMédia\nGrupo 0\t11,7\t52\nsentença condenatória\t71,8\t278,8\nexecução fiscal\t878,9\t1611\nGrupo 3\t1165\t47\ninquérito policial\t1010\t662,2",
        "Item                                    Grupo          N      Média\nhabeas corpus                             202        677      765,0\nGrupo 1                                   536        584        939\nexecução fiscal                         582,3      162,6      159,1",
        "1515 128,0\n739 881,8\n889,9 605,0\n1632 1051\n701 1495\n700,9 1155\n145,4 600,6\n949 857\n139,8 36,9",
        "Item;Valor;Total\nGrupo 0;481,8;896,3\ndano moral;725,6;137,1\nGrupo 2;1638;1687\nprova ilícita;49,0;209,9",
    ],
    "junk": [
        "xXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxXxX",
        "vgkmnh cn rcrxtgp dgwkmxjmh dttsglp ftrz gzb fpvfdjxb mhmwwg qgsdtfz qqcgtrdg nqpwtmjvj hpwrfnhgp ndpxdx htlhjg wvmxwrv kxnxwbl",
        "â€œr â€x Â r Â x ï¿½r Â l Ã³r Ã³r Â  â€r â€x ï¿½r Ã³ Ã§Ã£r Â l â€r â€l Ã© Â l â€ â€œl Ã§Ã£r ï¿½l Ã§Ã£l Ã© Ã³ Ã³r",
        "|@}~;=+#~e{I>@<;0a]{/ .=l\\/%~0#*~\n;\\ '{_*\\<\\,_>/\n&#;a<.<0,=;e~'^>:{0]_] ~l[a>[+#|\n{e=<%. |1\n[a>~| {]a>[}I#@|_\\^_'=#0_*<&>}{;:&*,",
        "e e e p l t l t r l d l e i i o e l a d n a l d i i n   n d o d p e e n     o   e p l d e e t e p t e t e r e o a o e l t e o n",
        "WyzG3NBn0lIBknwlG8innBlpfWR06ydVPQNh0A2fvZjYKF49nEWp4wPXxwjgzdSHMLUniCUppAI/WGxZNZ+BnTS6ewxKBcFWT3Ybw+Gwio7hCcWHV+O4Fd8S",
        "__________________________________________________________________________________________________________",
        "........................................................................................................",
        "Início | Sobre | Ajuda | Entrar\nNavegar  Comunidades  Coleções  Autores  Títulos\nInício | Sobre | Ajuda | Entrar\n« Anterior 1 2 3 4 5 Próximo »\nNavegar  Comunidades  Coleções  Autores  Títulos\nInício | Sobre | Ajuda | Entrar",
        "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Lorem ipsum dolor sit amet, consectetur adipiscing elit.",
    ],
}

# The blanks of Unicode, the plain ones, signs that prose has, and what letters become in a wrong encoding.
BLANKS = set("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | set(map(chr, range(0x2000, 0x200B)))
PLAIN, SIGNS, GARBLED = set(" \t\n\x0b\x0c\r"), set(".,;:()'-–—/“”"), set("ÃÂâï€\ufffd¿½œ")
PAGE = "\x03"
WORD, VOWELLESS = re.compile(r"[^\W_]+|\x03"), re.compile(r"[b-df-hj-np-tv-z]{3,}")
STOP = re.compile(r"""[.!?…](?=\s|$)(?:(?<=[^\W\d_]{2}.)|(?<=\d.)|(?<=[^\W_][)”"].))""")
LINE_STOP = re.compile(r"""[.!?…][)”"]?$""")
# What lines of lists, cards, contents, tables and references look like.
LINES = {
    "bullets": re.compile(r"\s*(?:\d{1,3}[.)]|\d{1,3} ?[-–]|[-*•–·]|[a-z]\)|[ivx]{1,4}[.)])\s+\S"),
    "labels": re.compile(r"\s*[^\W\d_](?:[^\W\d_]|[ \-]){1,24}:\s+\S.{0,90}$"),
    "leaders": re.compile(r".*?(?:\.{4}|_{4}|(?:\. ){3}|……|-{4}).*\d\s*$"),
    "cells": re.compile(r"(?=.*\d)(?:.*\t.*\t.*|.*\t[\d.,%\- ]+|.*\|.*\|.*|\s*[^|\t\n]*\S {2,}[\d.,%\-]+(?: {2,}[\d.,%\-]+)+\s*|[^;\n]+(?:;[\d.,%\- ]+)+)$"),
    "numbers": re.compile(r"[\d.,%+\- ]*\d[\d.,%+\- ]*$"),
    "references": re.compile(r"\s*[^\W\d_a-z][^\W\d_a-z'\-]+, .*\d{4}"),
}
CELL = re.compile(r";\d")
LEADER = re.compile(r"\.{4}|_{4}|(?:\. ){3}|……|-{4}")


def _between(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags stand between each end and the one before."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[ends])


def _line_kinds(line: str) -> list[str]:
    """Which of the statistics of lines a line counts for."""
    out = []
    if LINES["bullets"].match(line):
        out.append("bullets")
    if ":" in line and LINES["labels"].match(line):
        out.append("labels")
    if line[-1:].isdigit() or line[-1:].isspace():
        if LEADER.search(line) and LINES["leaders"].match(line):
            out.append("leaders")
    if ("\t" in line or "|" in line or "  " in line or ";" in line and CELL.search(line)) and LINES["cells"].match(line):
        out.append("cells")
    if LINES["numbers"].match(line):
        out.append("numbers")
    if ", " in line and LINES["references"].match(line):
        out.append("references")
    return out


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    """``n_words``, ``n_lines`` and ``STATS`` of texts: signs by their code points, words by their distinct forms, lines
    by patterns."""
    texts = [t.replace("\r\n", "\n").replace("\r", "\n") if "\r" in t else t for t in texts]
    n = len(texts)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.zeros((6, int(points.max()) + 1 if len(points) else 1), bool)
    for c in np.flatnonzero(np.bincount(points)).tolist() if len(points) else ():
        x = chr(c)
        category = unicodedata.category(x)
        kinds[:, c] = x not in BLANKS, x not in PLAIN, category[0] in "LN" or x in SIGNS, category[0] == "N", category == "Lu", x in GARBLED
    full = kinds[0][points]
    m = _between(full, ends).astype(float)
    known, digits, upper, garbled = (_between(kinds[i][points] & full, ends) for i in (2, 3, 4, 5))
    # words between blanks
    solid = kinds[1][points]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[ends[:-1][ends[:-1] < len(points)]] = solid[ends[:-1][ends[:-1] < len(points)]]
    w = _between(begins, ends).astype(float)
    at = np.flatnonzero(begins)
    size = _between(solid, np.append(at, len(points))) if len(at) else np.zeros(0, np.int64)
    long = np.bincount(np.searchsorted(ends, at, side="right") - 1, np.where(size > 30, size, 0), n)[:n] if len(at) else np.zeros(n)
    # words without the signs around them
    tokens = pa.array(WORD.findall(PAGE.join(t.replace(PAGE, " ") for t in texts).lower()), pa.string()).dictionary_encode()
    code, forms = tokens.indices.to_numpy(), tokens.dictionary.to_pylist()
    flags = np.array([[f == PAGE, f in _COMMON, VOWELLESS.fullmatch(f) is not None] for f in forms], bool).reshape(-1, 3)
    page = flags[code, 0] if len(code) else np.zeros(0, bool)
    doc = np.cumsum(page)
    words = np.maximum(np.bincount(doc[~page], minlength=n), 1)
    common, vowelless = (np.bincount(doc[flags[code, i]], minlength=n) if len(code) else np.zeros(n) for i in (1, 2))
    # lines
    breaks = points == 10
    line_ends = np.sort(np.concatenate([ends, np.flatnonzero(breaks) + 1]))
    line_ends = line_ends[np.diff(line_ends, prepend=-1) != 0]
    filled = _between(full, line_ends)
    owner = np.searchsorted(ends, line_ends[:-1], side="right") - 1
    lines = np.bincount(owner[filled > 0], minlength=n).astype(float)
    of = {k: np.zeros(n) for k in LINES}
    stops, line_stops, repeats = np.zeros(n), np.zeros(n), np.zeros(n)
    place = 0
    for i, t in enumerate(texts):
        stops[i] = len(STOP.findall(t))
        own = t.split("\n")
        repeats[i] = 1 - len(set(own)) / len(own)
        for k, line in enumerate(own):
            if line or k + 1 < len(own):  # an end without text is no line of the block
                count = filled[place]
                place += 1
                if count:
                    for kind in _line_kinds(line):
                        of[kind][i] += count
                    if LINE_STOP.search(line.rstrip()):
                        line_stops[i] += 1
    some, per = np.maximum(m, 1), np.maximum(w, 1)
    semicolons = _between(points == 59, ends)
    out = {
        "word_len": np.minimum(np.sqrt(m / per), 12), "symbols": known / some, "digits": digits / some, "upper": upper / some, "common": common / words, "stops": np.minimum(stops / per * 8, 1.5),
        "line_stops": line_stops / np.maximum(lines, 1), "semicolons": np.minimum(semicolons / per * 4, 1.5), **{k: v / some for k, v in of.items()}, "garbled": garbled / some, "vowelless": vowelless / words,
        "longest": np.minimum(long / some, 1), "repeats": repeats,
    }
    return {"n_words": w, "n_lines": lines} | {c: np.where(m > 0, out[c], np.nan) for c in STATS}


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``n_words``, ``n_lines`` and ``STATS``) of every document.

    Null and blank texts get 0 words, 0 lines and null statistics. Shares are between 0 and 1, of characters other
    than blanks unless the name says lines or words. Words are what stands between blanks; for the common and the
    vowelless ones their letters and digits count, whatever signs are around them. Whole texts are read; a text of one
    enormous line is one line. Other columns of ``docs`` are ignored. No shuffle; on Arrow batches, as twenty patterns
    over every text take three times as long in the JVM (measured).
    """
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                got = statistics([t or "" for t in part.column("t").to_pylist()])
                counts = [pa.array(got[c].astype(np.int32)) for c in ("n_words", "n_lines")]
                yield pa.RecordBatch.from_arrays([part.column("k"), *counts, *(pa.array(got[c], pa.float64(), from_pandas=True) for c in STATS)], names=[key, "n_words", "n_lines", *STATS])

    stats = ", ".join(f"{c} double" for c in STATS)
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"{key} {kind.simpleString()}, n_words int, n_lines int, {stats}")


class Mixture:
    """Weights, means and variances of the components in standardised statistics, and the kind of each."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, means: np.ndarray, floor: float = 0.05) -> None:
        self.centre, self.scale, self.floor = centre, scale, floor
        self.means = (means - centre) / scale
        self.var = np.full_like(self.means, 0.5)
        self.weight = np.full(len(means), 1 / len(means))
        self.kinds: list[str] = []

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale

    def responsibilities(self, z: np.ndarray) -> np.ndarray:
        """One row for each row of standardised statistics, summing to 1 over the components."""
        inv = 1 / self.var
        log = -0.5 * ((z**2) @ inv.T - 2 * z @ (self.means * inv).T + (self.means**2 * inv).sum(1) + np.log(self.var).sum(1)) + np.log(self.weight)
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        return p / p.sum(1, keepdims=True)

    def step(self, sums: dict[int, np.ndarray], n: float) -> float:
        """The maximisation; returns how far the means moved."""
        old, d = self.means.copy(), self.means.shape[1]
        for c, s in sums.items():
            if s[0] < 1e-6:
                continue
            self.weight[c] = s[0] / n
            self.means[c] = s[1 : d + 1] / s[0]
            self.var[c] = np.maximum(s[d + 1 :] / s[0] - self.means[c] ** 2, 0) + self.floor
        self.weight = np.maximum(self.weight, 1e-6)
        self.weight /= self.weight.sum()
        return float(np.abs(self.means - old).max())


def _sums(model: Mixture):
    d = len(STATS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(model.means), 2 * d + 1))
        for b in batches:
            z = model.standard(b[list(STATS)].to_numpy(float))
            p = model.responsibilities(z)
            total[:, 0] += p.sum(0)
            total[:, 1 : d + 1] += p.T @ z
            total[:, d + 1 :] += p.T @ z**2
        yield pd.DataFrame({"c": range(len(total)), "s": list(total)})

    return run


def fit_mixture(stats: DataFrame, steps: int = 60, moved: float = 0.02) -> Mixture:
    """The mixture of all documents with statistics; ``stats`` should be a written table, as each step scans it.

    Steps end when no mean moves by ``moved`` standard deviations; where ``steps`` don't get there it warns.
    """
    spark = stats.sparkSession
    some = stats.where(F.col(STATS[0]).isNotNull())
    row = some.agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m_{c}") for c in STATS), *(F.stddev_pop(c).alias(f"s_{c}") for c in STATS)).first()
    texts = [(k, x) for k, xs in EXAMPLES.items() for x in xs]
    shown = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(texts)], "i int, x string").coalesce(1)
    example = np.array([[r[c] for c in STATS] for r in text_statistics(shown, "i", "x").orderBy("i").collect()], float)
    centre = np.array([row[f"m_{c}"] or 0.0 for c in STATS])
    scale = np.maximum(np.array([row[f"s_{c}"] or 0.0 for c in STATS]), 0.03)
    model = Mixture(centre, scale, example)
    n, d = row["n"] or 0, len(STATS)
    far = 0.0
    for _ in range(steps if n else 0):
        parts = some.select(*STATS).mapInPandas(_sums(model), "c int, s array<double>")
        sums = parts.groupBy("c").agg(F.array(*(F.sum(F.col("s")[i]) for i in range(2 * d + 1))).alias("s")).collect()
        if (far := model.step({r["c"]: np.array(r["s"]) for r in sums}, n)) < moved:
            break
    if far >= moved:
        warnings.warn(f"the means still moved by {far:.4f} after {steps} steps", stacklevel=2)
    p = model.responsibilities(model.standard(example))
    order = list(EXAMPLES)
    claims = np.zeros((len(model.means), len(order)))
    for i, (k, _) in enumerate(texts):
        claims[:, order.index(k)] += p[i]
    own = [k for k, _ in texts]
    model.kinds = [order[int(claims[c].argmax())] if claims[c].max() > 0.05 else own[c] for c in range(len(claims))]
    return model


def document_kinds(stats: DataFrame, model: Mixture, key: str = "doc_id") -> DataFrame:
    """(``key``, ``kind``, ``confidence``) of every document with statistics; equal probabilities go to the first kind."""
    order = list(EXAMPLES)
    fold = np.array([[k == o for o in order] for k in model.kinds], float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = model.responsibilities(model.standard(b[list(STATS)].to_numpy(float))) @ fold
            yield pd.DataFrame({key: b[key], "kind": [order[i] for i in p.argmax(1)], "confidence": p.max(1)})

    return stats.where(F.col(STATS[0]).isNotNull()).select(key, *STATS).mapInPandas(run, f"{key} {stats.schema[key].dataType.simpleString()}, kind string, confidence double")


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(text_statistics(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), "statistics")
    return document_kinds(stats, fit_mixture(stats))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds(spark, sf_dir).where("kind <> 'prose'").select("doc_id", "kind")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_statistics(table(spark, sf_dir, "documents"))


def p10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics that SQL can tell too."""
    return text_statistics(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_lines", "word_len", "digits", "upper", "semicolons", "repeats")


def queries() -> dict:
    return {"p10_found": p10_found, "p10_statistics": p10_statistics, "p10_counts": p10_counts}


def oracle_sql() -> dict[str, str]:
    blank = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    counts = rf"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS t FROM documents),
        x AS (SELECT doc_id, t, regexp_replace(t, '{blank}', '', 'g') AS x, string_split(t, chr(10)) AS lines, len(regexp_extract_all(t, '[^\x09-\x0d ]+')) AS w FROM t),
        c AS (SELECT *, length(x) AS m, len(list_filter(lines, lambda i: regexp_replace(i, '{blank}', '', 'g') <> '')) AS l FROM x)
        SELECT doc_id, w::INT AS n_words, l::INT AS n_lines, least(sqrt(m / greatest(w, 1)), 12) AS word_len, length(regexp_replace(x, '\P{{N}}', '', 'g')) / m AS digits, length(regexp_replace(x, '\P{{Lu}}', '', 'g')) / m AS upper,
            least((length(t) - length(replace(t, ';', ''))) / greatest(w, 1) * 4, 1.5) AS semicolons, 1 - len(list_distinct(lines)) / len(lines) AS repeats FROM c WHERE m > 0
        UNION ALL SELECT doc_id, w::INT, 0, NULL, NULL, NULL, NULL, NULL FROM c WHERE m = 0"""
    return {"p10_counts": counts}
