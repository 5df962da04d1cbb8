"""Toxicity by nearest labelled examples: exact TF-IDF cosine over whole texts, distance-weighted votes.

Examples are a bounded sample of the labelled training rows (``Settings.per_class`` of each label, smallest hashes first,
equal texts once). Terms are the words of the examples; their document frequencies are counted over all documents. A word no
example holds counts in a text's norm as one that stands in one document. Words that mark the toxic examples weigh more: by
the lower bound of the log ratio of the rates at which toxic and clean examples hold them (without it, plain TF-IDF finds
half of the toxic texts only). Each rate is taken within its own label, so caps, sample size and the balance of labels
don't move it.

The index is block-max: similar examples lie in blocks, common words have the largest weight of each block beside their
weights, rare words have postings. A text's rare words are summed over their postings; with the blocks' largest weights
that bounds what a block can reach, blocks are met in falling order of their bounds, and those whose bound is below the k-th
cosine are skipped. The k nearest are exact; ties go to the example that comes first by its terms. A vote weighs the inverse
cosine distance, times how many labelled rows its example stands for, against the share of toxic rows as prior.

Texts are scored whole; null counts as empty and scores as texts that share no term do. Ids never enter a score;
a null id counts as not held out. Without usable labels every score is 0. Repeated rows are scored alike; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import beside, pieces, texts_of

WORD = re.compile(r"[^\W_]+")

@dataclass(frozen=True)
class Settings:
    per_class: int = 3000
    emphasis: float = 2.0
    errors: float = 2.0
    neighbours: int = 16
    prior_weight: float = 2.0
    block: int = 128
    common: float = 0.05


def held_out(id_col: Column) -> Column:
    """The fold that labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Index:
    """Example vectors in blocks: postings by term for the rare terms; for the common ones ``dense`` has the weights of a block
    (block, term, example) and ``tops`` their largest (term, block). ``place`` has a common term's row and -1 for a rare one,
    ``rank`` the order of the examples by their terms."""

    numbers: dict[str, int]
    worth: np.ndarray
    outside: float
    ids: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray
    rank: np.ndarray
    block: int
    edges: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    place: np.ndarray
    dense: np.ndarray
    tops: np.ndarray
    prior: float
    unmarked: float

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and cosines of the k nearest examples that share a term, and how many blocks were read."""
        n = len(self.ids)
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0), 0
        column = self.place[terms]
        rare = terms[column < 0]
        starts = self.edges[rare]
        sizes = self.edges[rare + 1] - starts
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.rows.take(at), weights=self.weights.take(at) * np.repeat(weights[column < 0], sizes), minlength=n).astype(float, copy=False)
        query, column = weights[column >= 0].astype(np.float32), column[column >= 0]
        upper = np.maximum.reduceat(scores, np.arange(0, n, self.block)) + query @ self.tops.take(column, axis=0) + 1e-5  # more than rounding can add
        order = np.argsort(-upper, kind="stable")
        best, floor, read = np.zeros(0), -1.0, 0
        for b, most in zip(order.tolist(), upper[order].tolist(), strict=True):
            if most < floor:
                break
            part = scores[b * self.block : (b + 1) * self.block]
            if len(column):
                part += (query @ self.dense[b].take(column, axis=0))[: len(part)]
            read += 1
            above = part[part > floor]
            if len(above):
                best = np.concatenate([best, above])
                if len(best) > k:
                    best = np.partition(best, len(best) - k)[-k:]
                floor = best.min() if len(best) == k else -1.0
        rows = np.flatnonzero((scores >= floor) & (scores > 0))  # in blocks not read all stay below their bound, so below the floor
        rows = rows[np.lexsort((self.rank[rows], -scores[rows]))[:k]]
        return rows, scores[rows], read

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.search(terms, weights, k)[:2]

    def vector(self, terms: np.ndarray, counts: np.ndarray, others: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text; ``others`` is the squared weight, before ``outside``, of words no example holds."""
        weights = (1 + np.log(counts)) * self.worth[terms]
        return terms, weights / math.sqrt(weights @ weights + others * self.outside**2)

    def score(self, text: str, settings: Settings) -> tuple[float, list[int]]:
        terms, counts, others = read(text, self.numbers)
        if not len(terms):
            return self.unmarked, []
        rows, cosines = self.nearest(*self.vector(terms, counts, others), settings.neighbours)
        votes = self.stands_for[rows] / (1.05 - np.minimum(cosines, 1.0))
        total = votes.sum() + settings.prior_weight
        return float((votes @ self.labels[rows] + settings.prior_weight * self.prior) / total), self.ids[rows[:3]].tolist()


def read(text: str, numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Index terms of a text with their counts, and the squared weight of its other words."""
    words = Counter(WORD.findall(text.lower()))
    terms = np.array(list(map(numbers.get, words, repeat(-1))), dtype=np.int64)
    counts = np.fromiter(words.values(), dtype=np.int64, count=len(words))
    inside = terms >= 0
    others = (1 + np.log(counts[~inside])) ** 2
    return terms[inside], counts[inside], float(others.sum())


def training_rows(labels: DataFrame) -> DataFrame:
    """One row per labelled document outside the held-out fold; of contradicting labels the larger one."""
    given = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    return given.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def example_terms(examples: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All terms of the examples in order, and how many clean and toxic ones hold each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update(set(WORD.findall(text.lower())))
            terms = list(seen[0] | seen[1])
            columns = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in seen)]
            yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

    counts = examples.select("text", "toxic").mapInArrow(count, "term string, clean long, toxic long")
    summed = counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow().sort_by("term")
    return summed.column("term").to_pylist(), summed.column("clean").to_numpy(), summed.column("toxic").to_numpy()


def emphasis(clean: np.ndarray, toxic: np.ndarray, found: dict[int, int], settings: Settings) -> np.ndarray:
    """Factors of 1 and more: what the log ratio of a term's rates in toxic and clean examples surely exceeds."""
    ratio = np.log((toxic + 0.5) / (found[1] + 1)) - np.log((clean + 0.5) / (found[0] + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return 1 + settings.emphasis * np.maximum(0, ratio - settings.errors * error)


def document_counts(docs: DataFrame, text_col: str, sent: Broadcast, size: int) -> tuple[int, np.ndarray]:
    """How many documents there are, and in how many each term stands, over the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, get = np.zeros(size + 2, dtype=np.int64), sent.value.get
        for batch in batches:
            texts = texts_of(batch.column(0))
            total[size] += len(texts)
            for a, b in pieces(texts):
                met: list[int] = []
                for text in texts[a:b]:
                    met += map(get, set(WORD.findall(text.lower())), repeat(size + 1))
                total += np.bincount(np.array(met, dtype=np.int64), minlength=size + 2)
        total = total[: size + 1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

    found = docs.select(F.col(text_col)).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, dtype=np.int64)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return int(out[size]), out[:size]


@dataclass(frozen=True)
class Example:
    doc_id: object
    toxic: int
    terms: np.ndarray
    counts: np.ndarray


def build(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, settings: Settings) -> Index | None:
    """The index; None if the labels don't hold both kinds."""
    rows = training_rows(labels)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    order = F.xxhash64(F.lit(17), F.col("doc_id"))
    chosen = [rows.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(settings.per_class) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * per_class rows at most
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = source.join(ids, "doc_id").withColumn("code", F.sha2(F.coalesce("text", F.lit("")), 256))
    examples = texts.groupBy("code", "toxic").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id"))
    examples = examples.repartition(F.col("code")).persist()
    found = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    if len(found) < 2:
        examples.unpersist()
        return None
    words, clean, toxic = example_terms(examples)
    # words of many examples come first: a task keeps those it looks up all the time close together
    numbers = {words[k]: k for k in np.argsort(-(clean + toxic), kind="stable").tolist()}
    sent = docs.sparkSession.sparkContext.broadcast(numbers)
    n_docs, frequency = document_counts(docs, text_col, sent, len(numbers))
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read(t, sent.value) for t in texts_of(batch.column("text"))]
            sorts = [np.argsort(f[0]) for f in found]
            columns = [batch.column("doc_id"), batch.column("toxic")]
            columns += [pa.array([f[part][o].astype(np.int32).tobytes() for f, o in zip(found, sorts, strict=True)], pa.binary()) for part in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "terms", "counts"])

    kind = dict(examples.dtypes)["doc_id"]
    rows_ = examples.select("doc_id", "toxic", "text").mapInArrow(vectors, f"doc_id {kind}, toxic int, terms binary, counts binary").collect()
    examples.unpersist()
    sent.destroy()
    drawn = [Example(r.doc_id, r.toxic, np.frombuffer(r.terms, dtype=np.int32), np.frombuffer(r.counts, dtype=np.int32)) for r in rows_]
    worth = idf * emphasis(clean, toxic, found, settings)
    return indexed(drawn, numbers, worth, sizes, found, settings, math.log((1 + n_docs) / 2) + 1)


def indexed(drawn: list, numbers: dict[str, int], worth: np.ndarray, sizes: dict[int, int], found: dict[int, int], settings: Settings, outside: float = 0.0) -> Index:
    """Lay the example vectors out by term."""
    stands_for = {k: sizes[k] / found[k] for k in (0, 1)}
    held = [(np.asarray(r.terms, dtype=np.int32), np.asarray(r.counts, dtype=np.int32), r) for r in drawn]
    marked = sorted((x for x in held if len(x[0])), key=lambda x: (x[0].tobytes(), x[1].tobytes(), str(x[2].doc_id)))
    plain = [r for terms, _, r in held if not len(terms)]
    prior = sizes[1] / (sizes[0] + sizes[1])
    weight = {k: stands_for[k] * sum(r.toxic == k for r in plain) for k in (0, 1)}
    unmarked = (weight[1] + prior * settings.prior_weight) / (weight[0] + weight[1] + settings.prior_weight)
    none = np.zeros(0, dtype=np.int32)
    terms = np.concatenate([none, *(x[0] for x in marked)])
    rows = np.repeat(np.arange(len(marked), dtype=np.int32), [len(x[0]) for x in marked])
    weights = np.concatenate([none, *((1 + np.log(x[1])) * worth[x[0]] for x in marked)])
    weights /= np.sqrt(np.bincount(rows, weights=weights**2, minlength=len(marked)))[rows]
    held_by = np.bincount(terms, minlength=len(worth))
    place = np.full(len(worth), -1, dtype=np.int32)
    common = np.flatnonzero(held_by > settings.common * len(marked))
    place[common] = np.arange(len(common))
    often = place[terms] >= 0
    whole = np.zeros((len(marked), len(common)), dtype=np.float32)
    whole[rows[often], place[terms[often]]] = weights[often]
    order = in_blocks(whole, settings.block)
    blocks = -(-len(marked) // settings.block)
    dense = np.zeros((blocks * settings.block, len(common)), dtype=np.float32)
    dense[: len(marked)] = whole[order]
    dense = np.ascontiguousarray(dense.reshape(blocks, settings.block, len(common)).transpose(0, 2, 1))
    now = np.empty(len(marked), dtype=np.int32)
    now[order] = np.arange(len(marked), dtype=np.int32)
    by_term = np.flatnonzero(~often)[np.argsort(terms[~often], kind="stable")]
    edges = np.concatenate(([0], np.cumsum(np.where(place < 0, held_by, 0))))
    labels = [marked[k][2] for k in order]
    return Index(
        numbers, worth, outside, np.array([r.doc_id for r in labels], dtype=object), np.array([r.toxic for r in labels], dtype=float),
        np.array([stands_for[r.toxic] for r in labels]), order, settings.block, edges, now[rows[by_term]].astype(np.intp), weights[by_term], place, dense,
        np.ascontiguousarray(dense.max(axis=2).T) if blocks else np.zeros((len(common), 0), dtype=np.float32), prior, unmarked,
    )


def in_blocks(vectors: np.ndarray, block: int) -> np.ndarray:
    """An order in which similar vectors share blocks: parts are cut at a whole number of blocks along the direction in
    which they spread most."""
    parts, out = [np.arange(len(vectors))], []
    while parts:
        own = parts.pop()
        if len(own) <= block:
            out.append(own)
            continue
        x = vectors[own] - vectors[own].mean(axis=0)
        along = x[np.abs(x).sum(axis=1).argmax()] if x.size else np.zeros(0, dtype=np.float32)
        for _ in range(8):
            along = x.T @ (x @ along)
            along = along / max(float(np.linalg.norm(along)), 1e-30)
        own = own[np.argsort(x @ along, kind="stable")]
        cut = block * (-(-len(own) // block) // 2)
        parts += [own[cut:], own[:cut]]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` with a score between 0 and 1 and the ids of the nearest examples."""
    settings = settings or Settings()
    index = build(docs, labels, id_col, text_col, settings)
    sent = docs.sparkSession.sparkContext.broadcast(index)
    kind = dict(docs.dtypes)[id_col]

    def fresh() -> Callable[[list[str]], list]:
        own = sent.value

        def made(texts: list[str]) -> list:
            found = [own.score(t, settings) if own else (0.0, []) for t in texts]
            return [pa.array([x[0] for x in found], pa.float64()), pa.array([[str(k) for k in x[1]] for x in found], pa.list_(pa.string()))]

        return made

    scored = beside(docs, text_col, "score double, evidence array<string>", fresh)
    return scored.withColumn("evidence", F.col("evidence").cast(f"array<{kind}>")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxic_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """Per document: id, whether it is held out, score, prediction and evidence."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = toxicity(slim, labels, settings=settings)
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted", "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows that aren't predicted to be toxic."""
    return toxicity(docs, labels, settings=settings).where("predicted = 0").select("row.*")
