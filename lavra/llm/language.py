"""Languages of texts and of the segments of mixed ones: a bidirectional gated recurrent network over bytes.

The network reads the lower-case bytes of a sentence in both directions and labels every byte; a sentence's evidence
is the mean of its bytes' log probabilities. It is trained in numpy by backpropagation through time on a bounded
sample of labelled records (``SAMPLE`` for each label, drawn by hash over the whole table), each label weighted by
its frequency, so that the few wrong labels of a frequent language don't make a class. What it says of ``HELD`` more
texts of each label makes its confidence. The sentences of a text are
then joined to segments by the best path through them, where a change of language has a price.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.llm.canonical import ACCENTED, PLAIN, canonical_values
from lavra.session import spread, table, written

SAMPLE = 250  # labelled texts of each label that the network is fitted on, at most
UNITS = 16  # of the network, in each direction
HELD = 50  # more of each label, at most, that the confidence is fitted on
WIDTH = 72  # bytes of a training window; whole sentences are labelled in use
STEPS = 470, 282  # of the fit on opening sentences, and of that on all sentences
RESTED = 0.4  # of a fit's steps, whose mean the weights are
BATCH = 192  # sentences of a step
PRICE = 14.0  # of a change of language between two sentences, in nats
EVIDENCE = 60  # bytes that a sentence counts as, at most: bytes of a sentence aren't independent

# Headings that begin a version of an abstract, and those of keyword lists.
HEADING = r"(?:resumo|abstract|resumen|résumé|resumé|riassunto|summary|sommario|zusammenfassung)"
KEYWORDS = r"(?:palavras?[- ]?chaves?|key ?words?|palabras? claves?|mots?[- ]cl[ée]s?|parole chiave|descritores|unitermos)"
STOPS = re.compile(r"[.!?…][)\]”\"'’»]?\s+")
BREAK = re.compile(rf"\n\s*\n|\s+(?={HEADING}\s*[:.\-–—])|\s+(?=(?-i:{HEADING.upper()})\s)|\n(?={HEADING}\b)|\s+(?={KEYWORDS}\s*[:.\-–—])", re.I)
# Parts of the headings; a text with neither one of them nor a line break has no BREAK.
STEMS = ("resum", "résum", "abstract", "riassunto", "summary", "sommario", "zusammenfas", "chave", "keyword", "key word", "clave", "mot cl", "mot-cl", "mots cl", "mots-cl", "parole", "descritores", "unitermos")
HEADING_ALONE = re.compile(rf"(?:{HEADING}|{KEYWORDS})\s*[:.\-–—]?", re.I)
LIST = re.compile(rf"\s*{KEYWORDS}\s*[:.\-–—]", re.I)
MARKUP = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|&[a-zA-Z]{2,8};|&#\d{1,6};")


def _may_break(part: str) -> bool:
    low = part.casefold()
    for x in STEMS:
        if x in low:
            return True
    return "\n" in part


def sentences(text: str) -> list[str]:
    """The sentences of a text without the blanks between them; a heading alone joins what follows."""
    out, held = [], ""
    if "<" in text or "&" in text:
        text = MARKUP.sub(" ", text)
    at, parts = 0, []
    for m in STOPS.finditer(text):
        parts.append(text[at : m.end()].strip())
        at = m.end()
    parts.append(text[at:].strip())
    if not _may_break(text):  # nor may any of its parts
        return [s for s in parts if s]
    for part in parts:
        for s in BREAK.split(part) if _may_break(part) else (part,):
            s = s.strip()
            if not s:
                continue
            if len(s) < 20 and HEADING_ALONE.fullmatch(s):
                held += s + " "
                continue
            out.append(held + s)
            held = ""
    return out + ([held.strip()] if held else [])


DIGITS = re.compile(r"\d+")


def _bytes(sentence: str) -> bytes:
    return DIGITS.sub("0", sentence.lower()).encode("utf-8", "replace")


def _bounded(c: np.ndarray) -> np.ndarray:
    """The hyperbolic tangent's rational form for values between -3 and 3: a third of its time, and alike on all machines."""
    square = c * c
    return c * (square + 27) / (9 * square + 27)


class Network:
    """Both directions' weights and the output layer. Gates are piecewise linear, states between -1 and 1."""

    def __init__(self, classes: list[str], units: int = UNITS, seed: int = 7) -> None:
        r, h, k = np.random.default_rng(seed), units, len(classes)
        self.classes, self.h = classes, h
        self.temper = 1.0  # by which evidence is divided for a confidence
        self.dropped: dict[str, float] = {}  # labels that are no class, and the share of their texts that they kept
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.3, (257, 3 * h)).astype(np.float32)  # row 256: no byte
            self.p[f"u{d}"] = (r.normal(0, 1, (h, 3 * h)) / np.sqrt(h)).astype(np.float32)
        self.p["o"] = r.normal(0, 0.3, (2 * h, k)).astype(np.float32)
        self.p["c"] = np.zeros(k, np.float32)

    def run(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """States before and after each step (time + 1, direction, batch, unit), gates, new contents before they are bounded
        and which places hold a byte. Codes are (time, batch), read from the end by the second direction; a place without a byte keeps the state."""
        h, p, back = self.h, self.p, codes[::-1]
        u = np.stack([p["uf"], p["ub"]])
        u_zr, u_c = u[..., : 2 * h] * 0.25, np.ascontiguousarray(u[..., 2 * h :])
        a = np.stack([p["xf"][codes], p["xb"][back]], 1)
        gates, new = a[..., : 2 * h] * 0.25 + 0.5, np.ascontiguousarray(a[..., 2 * h :])
        live = np.stack([codes, back], 1) != 256
        states = np.zeros((len(codes) + 1, *new.shape[1:]), new.dtype)
        for t, all_live in enumerate(live.all((1, 2))):
            s, g, c = states[t], gates[t], new[t]
            g += s @ u_zr
            np.clip(g, 0, 1, out=g)
            c += (g[..., h:] * s) @ u_c
            np.clip(c, -3, 3, out=c)
            after = s + g[..., :h] * (_bounded(c) - s)
            states[t + 1] = after if all_live else np.where(live[t, ..., None], after, s)
        return states, gates, new, live

    def labels(self, codes: np.ndarray, first: list[int], d: str, out: np.ndarray) -> None:
        """Adds the direction's share of the output for every byte to ``out``; column i holds a text from row 0 on, columns
        are by length, and ``first[t]`` is the first column that reaches row t: the columns before it are left alone."""
        h, x, u = self.h, self.p[f"x{d}"], self.p[f"u{d}"]
        x_z, x_r, x_c = (np.ascontiguousarray(w) for w in (x[:, :h] * 0.25 + 0.5, x[:, h : 2 * h] * 0.25 + 0.5, x[:, 2 * h :]))
        u_z, u_r, u_c = (np.ascontiguousarray(w) for w in (u[:, :h] * 0.25, u[:, h : 2 * h] * 0.25, u[:, 2 * h :]))
        o = self.p["o"][:h] if d == "f" else self.p["o"][h:]
        t_end, n = codes.shape
        state = np.zeros((n, h), np.float32)
        room = np.empty((4, n, h), np.float32)
        share = np.empty((n, o.shape[1]), np.float32)
        for t in range(t_end) if d == "f" else range(t_end - 1, -1, -1):
            k = first[t]
            at, s, y = codes[t, k:], state[k:], share[k:]
            z, r, c, m = room[:, k:]
            for g, x_g, u_g in ((z, x_z, u_z), (r, x_r, u_r)):
                x_g.take(at, 0, g, "clip")
                g += np.matmul(s, u_g, out=m)
                np.clip(g, 0, 1, out=g)
            r *= s
            x_c.take(at, 0, c, "clip")
            c += np.matmul(r, u_c, out=m)
            np.clip(c, -3, 3, out=c)
            np.multiply(c, c, out=m)
            m += 3
            r[:] = 24 / 9  # what bounds c is 1/9 + 24/9 / (c² + 3)
            r /= m
            r += 1 / 9
            c *= r
            c -= s
            c *= z
            s += c
            out[t, k:] += np.matmul(s, o, out=y)

    def gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients by backpropagation through time, every byte labelled with its text's class."""
        h, o = self.h, self.p["o"]
        states, gates, raw, alive = self.run(codes)
        hf, hb = states[1:, 0], states[:0:-1, 1]
        y = hf @ o[:h] + hb @ o[h:] + self.p["c"]
        y -= y.max(2, keepdims=True)
        e = np.exp(y)
        q = e / e.sum(2, keepdims=True)
        live = (codes != 256).astype(np.float32) * weights[None, :]
        total = live.sum() or 1.0
        picked = np.take_along_axis(q, np.broadcast_to(labels[None, :, None], (*codes.shape, 1)), 2)[..., 0]
        loss = float(-(np.log(picked + 1e-9) * live).sum() / total)
        dy = q
        np.put_along_axis(dy, np.broadcast_to(labels[None, :, None], (*codes.shape, 1)), (picked - 1)[..., None], 2)
        dy *= (live / total)[..., None]
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["o"][:h] = np.tensordot(hf, dy, ((0, 1), (0, 1)))
        grads["o"][h:] = np.tensordot(hb, dy, ((0, 1), (0, 1)))
        grads["c"] = dy.sum((0, 1))
        up = np.stack([dy @ o[:h].T, dy[::-1] @ o[h:].T], 1)
        u = np.stack([self.p["uf"].T, self.p["ub"].T])
        u_zr, u_c = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h :])
        prev, z, r = states[:-1], gates[..., :h], gates[..., h:]
        slope = 0.25 * ((gates > 0) & (gates < 1) & alive[..., None]).astype(gates.dtype)
        by_z, by_r, stay = (_bounded(raw) - prev) * slope[..., :h], prev * slope[..., h:], 1 - z
        square = raw * raw
        by_c = z * ((9 - square) / (9 + 3 * square)) ** 2 * alive[..., None]
        back = np.zeros_like(up[0])
        into = np.empty((*up.shape[:3], 3 * h), up.dtype)
        all_live = alive.all((1, 2))
        for t in range(len(codes) - 1, -1, -1):
            ds, d = back + up[t], into[t]
            d[..., 2 * h :] = dc = ds * by_c[t]
            drs = dc @ u_c
            d[..., :h], d[..., h : 2 * h] = ds * by_z[t], drs * by_r[t]
            back = ds * stay[t] + drs * r[t] + d[..., : 2 * h] @ u_zr
            if not all_live[t]:
                back = np.where(alive[t, ..., None], back, ds)
        reset = r * prev
        flat = codes.ravel()
        order = np.argsort(flat, kind="stable")
        rows, starts = np.unique(flat[order], return_index=True)
        for i, d in enumerate("fb"):
            own = into[:, i]
            grads[f"u{d}"][:, : 2 * h] = prev[:, i].reshape(-1, h).T @ own[..., : 2 * h].reshape(-1, 2 * h)
            grads[f"u{d}"][:, 2 * h :] = reset[:, i].reshape(-1, h).T @ own[..., 2 * h :].reshape(-1, h)
            if d == "b":
                own = own[::-1]
            grads[f"x{d}"][rows] = np.add.reduceat(own.reshape(-1, 3 * h)[order], starts, axis=0)
        return loss, grads

    def score(self, texts: list[bytes], cells: int = 400_000) -> np.ndarray:
        """Mean log probabilities of each text's bytes, whole texts, in batches of like lengths and bounded size."""
        out = np.zeros((len(texts), len(self.classes)), np.float32)
        ones = np.ones(len(self.classes), np.float32)
        sizes = np.array([len(t) for t in texts])
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        at = 0
        while at < len(order):
            rows = max(1, cells // int(sizes[order[min(len(order) - 1, at + 1023)]]))
            some = order[at : at + min(rows, 1024)]
            at += len(some)
            own = sizes[some]
            codes = np.zeros((int(own[-1]), len(some)), np.intp)
            for j, i in enumerate(some):
                codes[: own[j], j] = np.frombuffer(texts[i], np.uint8)
            first = np.searchsorted(own, np.arange(len(codes)), side="right").tolist()
            y = np.zeros((*codes.shape, len(self.classes)), np.float32)
            self.labels(codes, first, "f", y)
            self.labels(codes, first, "b", y)
            y += self.p["c"]
            live = np.arange(len(codes))[:, None] < own
            norm = np.log(np.exp(y) @ ones) * live
            y *= live[..., None]
            out[some] = (y.sum(0) - norm.sum(0)[:, None]) / own[:, None]
        return out


def train(texts: list[tuple[str, str]], frequency: dict[str, float], steps: tuple[int, int] = STEPS, seed: int = 7) -> Network:
    """A network from (text, label) pairs; ``frequency`` is each label's share of the whole table.

    First the opening sentences are learned, a label weighing as a low power of its frequency: a frequent language
    under a wrong, rare label stays with the frequent label. Then labels that keep few of their texts are dropped
    (``dropped`` tells them), and all sentences are learned with the language that the best path through their text
    gives them.
    """
    classes = sorted(frequency)
    index = {c: i for i, c in enumerate(classes)}
    net = Network(classes, seed=seed)
    cut = [([s for s in sentences(t) if not LIST.match(s)], index[c]) for t, c in texts]
    samples = [(_bytes(s), c) for ss, c in cut for s in ss[:2]]  # a mixed text begins in its main language
    if not samples:
        return net
    _fit(net, samples, np.array([frequency[c] for c in classes]) ** 0.4, steps[0], seed)
    said = net.score([b for b, _ in samples]).argmax(1)
    own = np.array([c for _, c in samples])
    right = np.bincount(own[said == own], minlength=len(classes)) / np.maximum(np.bincount(own, minlength=len(classes)), 1)
    true = right >= 0.15
    if not true.any():
        return net
    left = [i for i in range(len(classes)) if true[i]]
    net.dropped = {c: float(right[i]) for i, c in enumerate(classes) if not true[i]}
    net.classes = [classes[i] for i in left]
    net.p["o"], net.p["c"] = net.p["o"][:, left], net.p["c"][left]
    coded = [codes for ss, _ in cut if (codes := [b for s in ss if (b := _bytes(s))])]
    again = []
    for codes, scores in zip(coded, _evidence(net, coded)):
        again += zip(codes, best_path(scores))
    _fit(net, again, np.ones(len(left)), steps[1], seed + 1)
    return net


def _evidence(net: Network, coded: list[list[bytes]]) -> list[np.ndarray]:
    """The evidence of each text's sentences, all read at once."""
    flat = [b for codes in coded for b in codes]
    scores = net.score(flat) * np.array([min(len(b), EVIDENCE) for b in flat])[:, None]
    return np.split(scores, np.cumsum([len(codes) for codes in coded])[:-1])


def _keep_memory() -> None:
    """A block of 30 MB, given back at once, has glibc keep what is freed later: else every step's arrays are new pages."""
    np.empty(30 << 20, np.uint8)


def _fit(net: Network, samples: list[tuple[bytes, int]], label_weight: np.ndarray, steps: int, seed: int) -> None:
    """``steps`` of Adam over windows of the samples; each label's samples share its weight. The weights are the mean of
    the last ``RESTED`` of the steps: those of a single step differ so much that the machine's rounding tells."""
    _keep_memory()
    r = np.random.default_rng(seed)
    have = np.bincount([c for _, c in samples], minlength=len(net.classes))
    weight = label_weight / np.maximum(have, 1)
    weight = (weight / (weight * have).sum() * len(samples)).astype(np.float32)
    plain = str.maketrans(ACCENTED, PLAIN)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    mean = {k: np.zeros(x.shape) for k, x in net.p.items()}
    rested = max(1, int(RESTED * steps))
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        while len(order) < BATCH:  # all samples in turn, each time in another order
            order = np.concatenate([order, r.permutation(len(samples))])
        some, order = order[:BATCH], order[BATCH:]
        codes = np.full((WIDTH, len(some)), 256, np.int16)
        for j, i in enumerate(some):
            b = samples[i][0]
            if r.random() < 0.25:  # texts that lost their accents
                b = b.decode().translate(plain).encode()
            start = r.integers(0, max(1, len(b) - WIDTH + 1))
            b = b[start : start + (WIDTH if r.random() < 0.7 else 24)]
            codes[: len(b), j] = np.frombuffer(b, np.uint8)
        labels = np.array([samples[i][1] for i in some])
        _, grads = net.gradients(codes, labels, np.minimum(weight[labels], 20.0))
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = 0.01 if step <= 0.8 * steps else 0.003
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-6))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            if step > steps - rested:
                mean[k] += net.p[k] / rested
    net.p = {k: x.astype(np.float32) for k, x in mean.items()}


def fit_languages(labelled: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Network:
    """The network fitted on at most ``sample`` texts of each label, drawn by the hash of their key; its confidence on
    ``HELD`` more of each, which it hasn't seen."""
    some = labelled.where(F.col(text).rlike(r"(?U)\S") & F.col(label).isNotNull()).select(label, text, F.xxhash64(key).alias("h"))
    freq = {r[label]: float(r["count"]) for r in labelled.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    first = some.withColumn("r", F.row_number().over(Window.partitionBy(label).orderBy("h"))).where(F.col("r") <= sample + HELD)
    texts = sorted((r["h"], r[text], r[label], r["r"] <= sample) for r in first.select("h", F.col(text), F.col(label), "r").collect())
    total = sum(freq.values()) or 1.0
    share = {c: n / total for c, n in freq.items()} or {"und": 1.0}
    net = train([(t, c) for _, t, c, own in texts if own], share)
    net.temper = tempered(net, [(t, c) for _, t, c, own in texts if not own], share)
    return net


def tempered(net: Network, held: list[tuple[str, str]], frequency: dict[str, float]) -> float:
    """The divisor under which unseen texts' labels are likeliest, each label weighing as its share of the table; 1 without such texts.

    Labels that are no class count as wrong: the confidence takes the labels' own errors in.
    """
    total, want, weight = [], [], []
    have: dict[str, int] = {}
    for _, c in held:
        have[c] = have.get(c, 0) + 1
    coded = [(codes, c) for t, c in held if (codes := [b for s in sentences(t) if (b := _bytes(s))])]
    if not coded:
        return 1.0
    for (_, c), scores in zip(coded, _evidence(net, [codes for codes, _ in coded])):
        total.append(scores.mean(0))
        want.append(net.classes.index(c) if c in net.classes else -1)
        weight.append(frequency.get(c, 0.0) / have[c])
    z, want, weight = np.array(total), np.array(want), np.array(weight)

    def loss(temper: float) -> float:
        p = np.exp((z - z.max(1, keepdims=True)) / temper)
        p = p / p.sum(1, keepdims=True) * 0.999 + 0.001 / p.shape[1]
        return float((weight * -np.log(np.where(want >= 0, p[np.arange(len(p)), want], 0.001))).sum())

    return min((2.0 ** (k / 2) for k in range(-2, 15)), key=loss)


def best_path(scores: np.ndarray, price: float = PRICE) -> list[int]:
    """The best sequence of classes for sentences of a text, a change costing ``price``."""
    best, ways = scores[0].copy(), []
    for s in scores[1:]:
        top = int(best.argmax())
        move = best[top] - price > best
        ways.append(np.where(move, top, np.arange(len(best))))
        best = np.where(move, best[top] - price, best) + s
    path = [int(best.argmax())]
    for w in reversed(ways):
        path.append(int(w[path[-1]]))
    return path[::-1]


def segments(net: Network, texts: list[str]) -> list[list[tuple[str, float, int]]]:
    """For each text its segments as (language, confidence, sentences)."""
    known: dict[bytes, int] = {}
    cut = []
    for text in texts:
        ss = sentences(text)
        told = [s for s in ss if not LIST.match(s)] or ss  # a keyword list belongs to the text before it
        cut.append([known.setdefault(_bytes(s), len(known)) for s in told])
    scored = net.score(list(known))
    scored *= np.array([min(len(b), EVIDENCE) for b in known], np.float32)[:, None] if known else 1
    out = []
    for ss in cut:
        if not ss:
            out.append([])
            continue
        scores = scored[ss]
        tops = scores.argmax(1)
        path = best_path(scores) if (tops != tops[0]).any() else tops.tolist()
        parts: list[list] = []
        for j, c in enumerate(path):
            if parts and parts[-1][0] == c:
                parts[-1][1] = parts[-1][1] + scores[j]
                parts[-1][2] += 1
            else:
                parts.append([c, scores[j].copy(), 1])
        done = []
        for c, total, n in parts:
            p = np.exp((total - total.max()) / (n * net.temper))
            done.append((net.classes[c], float(p[c] / p.sum()), n))
        out.append(done)
    return out


def language_segments(docs: DataFrame, net: Network, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(``key``, ``keep``…, ``seg_no``, ``lang``, ``confidence``, ``n_sentences``, ``n_segments``).

    One row for each longest run of sentences in one language; null and blank texts give no row. Sentences that
    stand more than once in an Arrow batch are read by the network once. Rows are worked on where they are: no
    shuffle. Whole texts are read, in batches whose memory doesn't grow with the longest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        _keep_memory()
        for b in batches:
            got = segments(model, b["t"].tolist())
            n = [len(g) for g in got]
            flat = [(i + 1, *s) for g in got for i, s in enumerate(g)]
            out = b[["k", *keep]].loc[b.index.repeat(n)].reset_index(drop=True)
            for c, v in zip(("seg_no", "lang", "confidence", "n_sentences"), zip(*flat) if flat else ((), (), (), ())):
                out[c] = list(v)
            out["n_segments"] = np.repeat(n, n)
            yield out

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"k {docs.schema[key].dataType.simpleString()}, {kinds + ', ' if kinds else ''}seg_no int, lang string, confidence double, n_sentences int, n_segments int"
    some = docs.where(F.col(text).rlike(r"(?U)\S")).select(F.col(key).alias("k"), *keep, F.col(text).alias("t"))
    return some.mapInPandas(run, schema).withColumnRenamed("k", key)


def labelled_records(records: DataFrame, canon: DataFrame) -> DataFrame:
    """``records`` (row_no, language, abstract) with ``code``: the entry that the language means, null for none."""
    kinds = records.select("language").where("language IS NOT NULL").distinct()
    told = canonical_values(kinds.withColumn("own", F.col("language")), canon, key="own", fields=("language",)).where("entry <> 'none'").select(F.col("own").alias("language"), F.col("entry").alias("code"))
    exact = canon.where("field = 'language'").select(F.col("label").alias("language"), "code")
    codes = written(told.unionByName(exact), "codes")
    return records.join(codes, "language", "left").select("row_no", "abstract", "code")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "records").select("row_no", "language", "abstract")
    labelled = labelled_records(spread(records), table(spark, sf_dir, "canon_values"))
    net = fit_languages(labelled, "row_no", "abstract", "code")
    return language_segments(labelled, net, "row_no", "abstract", keep=("code",))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _segments(spark, sf_dir)
    return s.where("code IS NULL OR n_segments > 1 OR lang <> code").select("row_no", "seg_no", "lang")


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select("row_no", "seg_no", "lang", "confidence", "n_sentences")


def queries() -> dict:
    return {"p5_found": p5_found, "p5_segments": p5_segments}


def oracle_sql() -> dict[str, str]:
    return {}
