"""Subject areas of documents: bisecting k-means, discriminative terms and leaf mixtures.

1. Texts are read once. A block of texts becomes one row: its distinct sentences as sets of terms, its texts as lists
   of those sentences and as sets of terms. A term is the beginning of a word (``STEM`` letters, no accents), and has
   one of ``PLACES`` places by its hash: no term is left out, however many there are.
2. Every text becomes a normalised vector of inverse document frequencies, counted over all texts.
3. Bisecting k-means on the sphere over all vectors, without labels: in each round the leaves that scatter most are
   split; halves start at two means of a bounded sample (``SEEDS``) and move by steps over all texts. A step sums
   vectors per half in the partitions and over them; (halves x places) sums reach the driver.
4. A leaf's mixture of areas comes from the hand-assigned rows in it, or, where it holds none, from its most
   discriminative terms found in the areas' scope notes, or else from its parent.
5. A sentence belongs to the leaves in the degree that its discriminative terms stand there more often than elsewhere;
   its area is the foremost of these leaves' mixtures, if one leads. A text has every area of at least a third of its
   sentences that have one.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.canonical import ACCENTED, PLAIN
from lavra.llm.language import LIST, sentences
from lavra.llm.names import name_classes
from lavra.session import released, spread, table, written

STEM = 6  # letters of a word that make its term
PLACES = 1 << 16
LEAVES = 96
SEEDS = 8192  # texts, drawn by the hash of their keys, that the halves start from
STEPS = 2  # of k-means over all texts for each round
SHARE = 1 / 3  # of a document's sentences, for an area
SURE = 1.5  # least lead of a sentence's area over the next, in nats
LEAST = 5  # texts that hold a term, for it to be evidence
BLOCK_CHARS = 4_000_000
WORDS = re.compile(r"[^\W\d_]{3,}|\n")
_TABLE = str.maketrans(ACCENTED, PLAIN)


def place_of(word: str) -> int:
    """A lower-case word's place."""
    return zlib.crc32(word.translate(_TABLE)[:STEM].encode()) % PLACES


def _sets(owner: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each owner's distinct places, owner by owner, and their number."""
    u = np.sort(owner.astype(np.int64) * PLACES + places)  # faster than a set by hashes
    u = u[np.diff(u, prepend=-1) != 0]
    return (u % PLACES).astype(np.uint16), np.bincount(u // PLACES, minlength=n).astype(np.int32)


def _expanded(lists: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For items by number, where each item is a run of ``sizes`` values: the places of all their values."""
    starts = np.concatenate([[0], np.cumsum(sizes)])[lists]
    n = sizes[lists]
    ends = np.cumsum(n)
    return np.repeat(starts - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


BLOCK = "keys array<bigint>, terms binary, term_sizes binary, lists binary, list_sizes binary, sets binary, set_sizes binary, df array<struct<place: int, d: bigint>>"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("t").to_pylist()
        at = 0
        while at < len(texts):
            begin, chars = at, 0
            while at < len(texts) and (at == begin or chars + len(texts[at]) <= BLOCK_CHARS):
                chars += len(texts[at])
                at += 1
            known: dict[str, int] = {}
            lists = [[known.setdefault(s, len(known)) for s in sentences(t) if not LIST.match(s)] for t in texts[begin:at]]
            coded = pa.array(WORDS.findall("\n".join(s.replace("\n", " ") for s in known).lower()), pa.string()).dictionary_encode()
            codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            place = np.array([-1 if w == "\n" else place_of(w) for w in words], np.int64)[codes] if words else np.zeros(0, np.int64)
            line, own = np.cumsum(place < 0), place >= 0
            terms, term_sizes = _sets(line[own], place[own], len(known))
            list_sizes = np.array([len(x) for x in lists], np.int32)
            flat = np.array([i for x in lists for i in x], np.int32)
            doc = np.repeat(np.repeat(np.arange(len(lists)), list_sizes), term_sizes[flat])
            sets, set_sizes = _sets(doc, terms[_expanded(flat, term_sizes)], len(lists))
            d = np.bincount(sets, minlength=PLACES)
            there = np.flatnonzero(d)
            df = pa.StructArray.from_arrays([pa.array(there.astype(np.int32)), pa.array(d[there])], names=["place", "d"])
            keys = b.column("k").slice(begin, at - begin)
            packed = [pa.array([x.tobytes()], pa.binary()) for x in (terms, term_sizes, flat, list_sizes, sets, set_sizes)]
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays([one(keys), *packed, one(df)], names=["keys", "terms", "term_sizes", "lists", "list_sizes", "sets", "set_sizes", "df"])


def coded_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The blocks (columns of ``BLOCK``) of all texts that aren't blank, written. ``key`` is a whole number."""
    return written(docs.where(F.col(text).rlike(r"(?U)\S")).select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).mapInArrow(_coded, BLOCK), "coded")


def _column(b: pa.RecordBatch, name: str, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(b.column(name)[row].as_buffer() or b"", kind)


class Space:
    """The places that are evidence, by number, and their weights."""

    def __init__(self, df: pd.DataFrame, n: int) -> None:
        df = df[df["d"] >= LEAST].sort_values("place")
        self.n, self.d = n, df["d"].to_numpy(float)
        self.number = np.full(PLACES, -1, np.int32)
        self.number[df["place"].to_numpy()] = np.arange(len(df))
        self.idf = np.log(np.maximum(n, 1) / self.d).astype(np.float32) if len(df) else np.zeros(0, np.float32)

    @property
    def size(self) -> int:
        return len(self.d)

    def vectors(self, sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number, value) of the texts' normalised vectors."""
        rows, at = np.repeat(np.arange(len(sizes)), sizes), self.number[sets]
        own = at >= 0
        rows, at = rows[own], at[own]
        v = self.idf[at]
        norm = np.sqrt(np.bincount(rows, v * v, len(sizes)))
        return rows, at, v / np.maximum(norm[rows], 1e-12).astype(np.float32)


class Tree:
    """Nodes by number; ``left`` is -1 in a leaf; a text goes right where its product with ``turn`` is positive."""

    def __init__(self) -> None:
        self.left, self.right, self.parent, self.turn = [-1], [-1], [-1], [None]

    def leaf_nodes(self) -> list[int]:
        return [i for i, l in enumerate(self.left) if l < 0]

    def split(self, node: int, turn: np.ndarray) -> tuple[int, int]:
        a = len(self.left)
        self.left[node], self.right[node], self.turn[node] = a, a + 1, turn
        self.left += [-1, -1]
        self.right += [-1, -1]
        self.parent += [node, node]
        self.turn += [None, None]
        return a, a + 1

    def leaves(self, rows: np.ndarray, at: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
        """The leaf of each of ``n`` texts. A walk goes on only with the texts that aren't in a leaf yet."""
        node = np.zeros(n, np.int64)
        inner = [i for i, l in enumerate(self.left) if l >= 0]
        if not inner or not n:
            return node
        place = np.full(len(self.left), -1)
        place[inner] = np.arange(len(inner))
        turns = np.stack([self.turn[i] for i in inner]).ravel()
        size = len(self.turn[inner[0]])
        left, right = np.array(self.left), np.array(self.right)
        while True:
            p = place[node]
            score = np.bincount(rows, v * turns[p[rows] * size + at], n)
            live = p >= 0
            node = np.where(live, np.where(score > 0, right[node], left[node]), node)
            if (more := place[node] >= 0).all():
                continue
            if not more.any():
                return node
            own = more[rows]
            rows, at, v = rows[own], at[own], v[own]


def direction(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a text lies nearer to b than to a."""
    return (b / (np.linalg.norm(b) or 1) - a / (np.linalg.norm(a) or 1)).astype(np.float32)


def halves(rows: np.ndarray, at: np.ndarray, v: np.ndarray, n: int, size: int, trials: int = 3, steps: int = 8) -> np.ndarray | None:
    """The turn between two means of ``n`` texts, the best of some starts; null where they don't part."""
    r, best = np.random.default_rng(n), None
    for _ in range(trials):
        first = np.zeros(size, np.float32)
        own = rows == r.integers(n)
        first[at[own]] = v[own]
        near = np.bincount(rows, v * first[at], n)
        second = np.zeros(size, np.float32)
        own = rows == int(np.argmin(near + r.random(n) * 1e-3))
        second[at[own]] = v[own]
        for _ in range(steps):
            turn = direction(first, second)
            side = np.bincount(rows, v * turn[at], n) > 0
            if side.all() or not side.any():
                break
            own = side[rows]
            first, second = np.bincount(at[~own], v[~own], size), np.bincount(at[own], v[own], size)
        else:
            worth = np.linalg.norm(first) + np.linalg.norm(second)
            if best is None or worth > best[0]:
                best = (worth, direction(first, second))
    return best and best[1]


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _gather(blocks: DataFrame, space: Space, tree: Tree, nodes: list[int], binary: bool) -> tuple[np.ndarray, np.ndarray]:
    """(nodes x places) sums of vectors, or numbers of texts with a term where ``binary``, and the nodes' texts.

    The model is broadcast once a step: (inner nodes x places), at most ``LEAVES`` by ``PLACES``.
    """
    shared = blocks.sparkSession.sparkContext.broadcast((space, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, tree = shared.value
        place = np.full(len(tree.left), -1)
        place[nodes] = np.arange(len(nodes))
        total, count = np.zeros(len(nodes) * space.size), np.zeros(len(nodes))
        for b in batches:
            for row in range(b.num_rows):
                sizes = _column(b, "set_sizes", row, np.int32)
                rows, at, v = space.vectors(_column(b, "sets", row, np.uint16), sizes)
                p = place[tree.leaves(rows, at, v, len(sizes))]
                count += np.bincount(p[p >= 0], minlength=len(nodes))
                q = p[rows]
                own = q >= 0
                total += np.bincount(q[own] * space.size + at[own], None if binary else v[own], len(total))
        key = np.flatnonzero(total)
        yield _batch(node=np.concatenate([key // max(1, space.size), np.arange(len(nodes))]).astype(np.int32), term=np.concatenate([key % max(1, space.size), np.full(len(nodes), -1)]).astype(np.int32), s=np.concatenate([total[key], count]))

    got = blocks.select("sets", "set_sizes").mapInArrow(run, "node int, term int, s double").groupBy("node", "term").agg(F.sum("s").alias("s")).toPandas()
    shared.unpersist()
    sums, counts = np.zeros((len(nodes), space.size)), np.zeros(len(nodes))
    own = got["term"] >= 0
    sums[got["node"][own], got["term"][own]] = got["s"][own]
    counts[got["node"][~own]] = got["s"][~own]
    return sums, counts


def _seeds(blocks: DataFrame, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The vectors of at most ``SEEDS`` texts, those of the least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in range(b.num_rows):
                keys, sizes, sets = b.column("keys")[row].values, _column(b, "set_sizes", row, np.int32), _column(b, "sets", row, np.uint16)
                ends = np.concatenate([[0], np.cumsum(sizes)]) * 2
                data = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(sets.tobytes())])
                yield pa.RecordBatch.from_arrays([keys, data], names=["key", "terms"])

    some = blocks.select("keys", "sets", "set_sizes").mapInArrow(run, "key bigint, terms binary").orderBy(F.xxhash64("key"), "key").limit(SEEDS).collect()
    sets = [np.frombuffer(bytes(x["terms"]), np.uint16) for x in some]
    rows, at, v = space.vectors(np.concatenate(sets) if sets else np.zeros(0, np.uint16), np.array([len(x) for x in sets], np.int64))
    return rows, at, v, len(sets)


def grow(blocks: DataFrame, space: Space, leaves: int = LEAVES, steps: int = STEPS) -> Tree:
    """The tree over all texts. A round splits the leaves that scatter at least a quarter of the most, most first."""
    tree = Tree()
    rows, at, v, n = _seeds(blocks, space)
    scatter = {0: float(space.n)}
    while scatter and len(tree.leaf_nodes()) < leaves:
        most = max(scatter.values())
        node = tree.leaves(rows, at, v, n)
        parts = []
        for leaf in sorted(scatter, key=lambda k: (-scatter[k], k)):
            if scatter[leaf] < most / 4 or len(tree.leaf_nodes()) >= leaves:
                break
            del scatter[leaf]
            own = node == leaf
            of = own[rows]
            number = np.cumsum(own) - 1
            if own.sum() < 8 or (turn := halves(number[rows[of]], at[of], v[of], int(own.sum()), space.size)) is None:
                continue  # too few texts, or all alike: it stays a leaf
            parts.append((leaf, *tree.split(leaf, turn)))
        if not parts:
            continue
        ends = [c for _, a, b in parts for c in (a, b)]
        for _ in range(steps):
            sums, counts = _gather(blocks, space, tree, ends, False)
            for i, (parent, _, _) in enumerate(parts):
                if counts[2 * i] and counts[2 * i + 1]:
                    tree.turn[parent] = direction(sums[2 * i], sums[2 * i + 1])
        scatter |= {c: float(counts[i] - np.linalg.norm(sums[i])) for i, c in enumerate(ends)}
    return tree


def _leaf_of(blocks: DataFrame, space: Space, tree: Tree, key: str) -> DataFrame:
    """(``key``, leaf) of every text."""
    shared = blocks.sparkSession.sparkContext.broadcast((space, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, tree = shared.value
        for b in batches:
            for row in range(b.num_rows):
                sizes = _column(b, "set_sizes", row, np.int32)
                leaf = tree.leaves(*space.vectors(_column(b, "sets", row, np.uint16), sizes), len(sizes))
                yield pa.RecordBatch.from_arrays([b.column("keys")[row].values, pa.array(leaf.astype(np.int32))], names=[key, "leaf"])

    return blocks.select("keys", "sets", "set_sizes").mapInArrow(run, f"{key} bigint, leaf int")


class Mixtures:
    """The leaves' mixtures of areas, and the weight of each discriminative term in each leaf."""

    def __init__(self, space: Space, tree: Tree, held: np.ndarray, texts: np.ndarray, hand: dict[int, np.ndarray], notes: list[set[int]]) -> None:
        """``held``: (leaves x places) texts with a term; ``texts`` of each leaf; ``hand``: assigned areas by node, in
        whole rows; ``notes``: the places of each area's scope note."""
        nodes, areas = tree.leaf_nodes(), len(notes)
        base = space.d / max(1, space.n)
        often = (held + 0.5 * base) / (texts[:, None] + 0.5)
        lift = np.log(often / np.maximum(base, 1e-12))
        total = sum(hand.values(), np.zeros(areas))
        prior = (total + 1) / (total.sum() + areas)
        named = [np.array(sorted(space.number[p] for p in ps if space.number[p] >= 0), int) for ps in notes]
        above = dict(hand)
        for node in range(len(tree.left) - 1, 0, -1):  # children have greater numbers
            above[tree.parent[node]] = above.get(tree.parent[node], np.zeros(areas)) + above.get(node, np.zeros(areas))
        self.mix = np.zeros((len(nodes), areas))
        for i, node in enumerate(nodes):
            own = above.get(node, np.zeros(areas))
            if own.sum() < 1:  # its most discriminative terms against the scope notes
                foremost = set(np.argsort(-np.where(held[i] >= 3, lift[i], -9), kind="stable")[:60].tolist())
                own = np.array([float(len(foremost & set(x.tolist()))) for x in named])
            while own.sum() == 0 and node >= 0:
                own, node = above.get(node, own), tree.parent[node]
            self.mix[i] = (own + 0.02 * prior) / (own.sum() + 0.02)
        rate = (self.mix.T @ held + 0.5) / ((self.mix.T @ texts)[:, None] + 1)
        post = np.sort(rate / np.maximum(rate.sum(0), 1e-12), axis=0)
        second = post[-2] if areas > 1 else 0 * post[-1]
        sure = (post[-1] > 0.5) & (post[-1] > 3 * second)
        self.term = np.full(PLACES, -1)
        self.term[np.flatnonzero(space.number >= 0)[sure]] = np.arange(int(sure.sum()))
        self.weight, self.prior = np.ascontiguousarray(lift[:, sure].T).astype(np.float32), np.log(np.maximum(texts, 1e-9)).astype(np.float32)

    def areas(self, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The area of each sentence, or -1 where no term is evidence or no area leads."""
        out = np.full(len(sizes), -1)
        t = self.term[terms]
        own = t >= 0
        rows, t = np.repeat(np.arange(len(sizes)), sizes)[own], t[own]
        if not len(t):
            return out
        some, starts = np.unique(rows, return_index=True)
        for at in range(0, len(some), 20_000):
            lo, hi = starts[at], starts[at + 20_000] if at + 20_000 < len(some) else len(t)
            z = np.add.reduceat(self.weight[t[lo:hi]], starts[at : at + 20_000] - lo, axis=0) + self.prior
            z = np.exp(z - z.max(1, keepdims=True))
            e = np.log((z / z.sum(1, keepdims=True)) @ self.mix + 1e-9)
            order = np.sort(e, axis=1)
            led = order[:, -1] - (order[:, -2] if e.shape[1] > 1 else -np.inf) >= SURE
            out[some[at : at + 20_000]] = np.where(led, e.argmax(1), -1)
        return out


def document_areas(blocks: DataFrame, mixtures: Mixtures, key: str, areas: list[str]) -> DataFrame:
    """(``key``, ``area``, ``share``): every area of at least ``SHARE`` of the sentences that have one.

    Keyword lists are no sentences. Texts without a sentence that has an area give no row. Narrow.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(mixtures)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for row in range(b.num_rows):
                own = model.areas(_column(b, "terms", row, np.uint16), _column(b, "term_sizes", row, np.int32))
                sizes = _column(b, "list_sizes", row, np.int32)
                doc, area = np.repeat(np.arange(len(sizes)), sizes), own[_column(b, "lists", row, np.int32)]
                told = area >= 0
                n = np.bincount(doc[told] * len(areas) + area[told], minlength=len(sizes) * len(areas)).reshape(len(sizes), len(areas))
                total = n.sum(1, keepdims=True)
                doc, area = np.nonzero((n > 0) & (n >= total * SHARE - 1e-9))
                yield pa.RecordBatch.from_arrays([b.column("keys")[row].values.take(pa.array(doc)), pa.array(areas, pa.string()).take(pa.array(area)), pa.array(n[doc, area] / total[doc, 0])], names=[key, "area", "share"])

    return blocks.select("keys", "terms", "term_sizes", "lists", "list_sizes").mapInArrow(run, f"{key} bigint, area string, share double")


def fit_areas(blocks: DataFrame, sample: DataFrame, subject_areas: DataFrame) -> tuple[Mixtures, list[str]]:
    """The mixtures over all texts of ``blocks``; ``sample`` has (row_no, area) of hand-assigned rows."""
    kinds = subject_areas.orderBy("area").collect()  # the fixed list of areas
    areas = [r["area"] for r in kinds]
    notes = [{place_of(w) for w in WORDS.findall(f"{r['area_name'] or ''} {r['scope_note'] or ''}".lower()) if w != "\n"} for r in kinds]
    n = blocks.select(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    space = Space(blocks.select(F.inline("df")).groupBy("place").agg(F.sum("d").alias("d")).toPandas(), n)  # PLACES rows at most
    tree = grow(blocks, space)
    nodes = tree.leaf_nodes()
    held, texts = _gather(blocks, space, tree, nodes, True)
    hand: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(len(areas)))
    known = sample.where(F.col("area").isin(areas)).select("row_no", "area").distinct()
    per = known.join(_leaf_of(blocks, space, tree, "row_no"), "row_no")
    of = per.groupBy("row_no").agg(F.count("*").alias("c"))
    for r in per.join(of, "row_no").groupBy("leaf", "area").agg(F.sum(1 / F.col("c")).alias("n")).collect():
        hand[r["leaf"]][areas.index(r["area"])] += r["n"]
    return Mixtures(space, tree, held, texts, dict(hand), notes), areas


def record_areas(records: DataFrame, sample: DataFrame, subject_areas: DataFrame) -> DataFrame:
    """(row_no, area) of every record with an abstract, or else with a graduate_program.

    A record without an abstract has the foremost area of its program's records that have one; the spellings of a
    program are linked first. A program none of whose records has an area gives no row. ``row_no`` is unique.
    """
    blocks = coded_texts(spread(records.select("row_no", "abstract").where("abstract IS NOT NULL")), "row_no", "abstract")
    if subject_areas.isEmpty() or blocks.isEmpty():
        return records.select("row_no").limit(0).withColumn("area", F.lit("")).select("row_no", "area")
    mixtures, areas = fit_areas(blocks, sample, subject_areas)
    found = written(document_areas(blocks, mixtures, "row_no", areas), "areas")
    released(blocks)

    programs = name_classes(records, ("graduate_program",)).select(F.col("name").alias("graduate_program"), "body")
    of = written(records.select("row_no", "graduate_program", (~F.coalesce(F.col("abstract"), F.lit("")).rlike(r"(?U)\S")).alias("bare")).where("graduate_program IS NOT NULL"), "programs")
    votes = of.join(found, "row_no").groupBy("graduate_program", "area").agg(F.sum("share").alias("n"))  # before the bodies: few rows
    body = votes.join(programs, "graduate_program").groupBy("body", "area").agg(F.sum("n").alias("n")).groupBy("body").agg(F.max_by("area", F.struct("n", "area")).alias("area"))
    told = programs.join(body, "body").select("graduate_program", "area")
    return found.select("row_no", "area").unionByName(of.where("bare").join(told, "graduate_program").select("row_no", "area"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_areas(table(spark, sf_dir, "records"), table(spark, sf_dir, "area_sample"), table(spark, sf_dir, "subject_areas"))


def p7_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area, n_records, share): the make-up of the collection by area."""
    found = written(p7_found(spark, sf_dir), "found")
    n = found.agg(F.countDistinct("row_no").alias("n"))
    return found.groupBy("area").agg(F.count("*").alias("n_records")).crossJoin(F.broadcast(n)).select("area", "n_records", (F.col("n_records") / F.col("n")).alias("share"))


def queries() -> dict:
    return {"p7_found": p7_found, "p7_composition": p7_composition}


def oracle_sql() -> dict[str, str]:
    return {}
