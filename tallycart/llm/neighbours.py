"""Approximate nearest neighbours by balanced posting lists.

Lists are the leaves of a balanced bisection of at most ``Settings.sample`` distinct vectors (smallest hashes first); that
sample alone is fitted in the driver. Every vector is put into the list of its nearest centroid and, if it lies near a
boundary, into further ones (closer than ``closure`` times the least distance and not shadowed by a list already chosen).
Centroids are found by beam search in a proximity graph that each task holds. A query reads the lists whose centroid is
within ``ratio`` of its least distance. Vectors of a list lie in blocks of bounded size, so neither a hot list nor many
queries on one list meet in one task as a whole. Queries that met fewer than k candidates are searched over all lists.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do null
ids. Equal vectors stand once with their k + 1 smallest ids, which is all that any answer can name. Extra columns are left
aside; a repeated row with the same id counts once.
Equal distances go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import staged


@dataclass(frozen=True)
class Settings:
    k: int = 10
    sample: int = 20_000
    list_size: int = 400
    closure: float = 1.15
    replicas: int = 4
    ratio: float = 1.35
    most_lists: int = 48
    links: int = 16
    beam: int = 64
    home_beam: int = 16
    block: int = 512


def bisected(points: np.ndarray, leaves: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of ``leaves`` equally large parts, by cutting each part at the median between two centres."""
    parts = [(points, leaves)]
    centres = []
    while parts:
        own, n = parts.pop()
        if n <= 1 or len(own) < 2:
            centres.append(own.mean(axis=0))
            continue
        a, b = own[rng.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = ((own - a) ** 2).sum(axis=1) < ((own - b) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            a, b = own[side].mean(axis=0), own[~side].mean(axis=0)
        order = np.argsort(own @ (b - a), kind="stable")
        cut = round(len(own) * (n // 2) / n)
        parts += [(own[order[cut:]], n - n // 2), (own[order[:cut]], n // 2)]
    return np.array(centres)


@dataclass(frozen=True)
class Graph:
    """Centroids with their links to near ones, and where searches begin."""

    centres: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def of(cls, centres: np.ndarray, links: int) -> Graph:
        norms = (centres**2).sum(axis=1)
        near = np.empty((len(centres), min(links, len(centres) - 1)), dtype=np.int64)
        for a in range(0, len(centres), 256):
            d = norms[a : a + 256, None] + norms - 2 * centres[a : a + 256] @ centres.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near[a : a + 256] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
        step = max(1, int(np.sqrt(len(centres))))
        return cls(centres, near, np.arange(0, len(centres), step))

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each point and their distances, ``beam`` at most, by best-first expansion."""
        n, size = len(points), len(self.centres)
        beam = min(beam, size)
        seen = np.full((n, size), np.inf)
        open_ = np.zeros((n, size), dtype=bool)
        rows = np.arange(n)
        first = self.entries
        seen[:, first] = ((points[:, None, :] - self.centres[first]) ** 2).sum(axis=2)
        open_[:, first] = True
        while len(rows) and self.links.shape[1]:
            ahead = np.where(open_[rows], seen[rows], np.inf)
            pick = ahead.argmin(axis=1)
            least = ahead[np.arange(len(rows)), pick]
            worst = np.partition(seen[rows], beam - 1, axis=1)[:, beam - 1]
            going = np.isfinite(least) & (least <= worst)
            rows, pick = rows[going], pick[going]
            open_[rows, pick] = False
            near = self.links[pick]
            fresh = ~np.isfinite(seen[rows[:, None], near])
            d = ((points[rows][:, None, :] - self.centres[near]) ** 2).sum(axis=2)
            r, c = np.nonzero(fresh)
            seen[rows[r], near[r, c]] = d[r, c]
            open_[rows[r], near[r, c]] = True
        order = np.argsort(seen, axis=1, kind="stable")[:, :beam]
        return order, np.sqrt(np.take_along_axis(seen, order, axis=1))

    def homes(self, points: np.ndarray, s: Settings) -> list[list[int]]:
        """The lists that each vector is put into."""
        order, far = self.search(points, s.home_beam)
        out = []
        for ranked, d in zip(order, far, strict=True):
            chosen = [int(ranked[0])]
            for c, x in zip(ranked[1:].tolist(), d[1:].tolist(), strict=True):
                if x > s.closure * d[0] or len(chosen) >= s.replicas:
                    break
                if all(((self.centres[c] - self.centres[o]) ** 2).sum() >= x * x for o in chosen):
                    chosen.append(c)
            out.append(chosen)
        return out

    def probes(self, points: np.ndarray, s: Settings) -> list[list[int]]:
        """The lists that each query reads."""
        order, far = self.search(points, s.beam)
        return [ranked[: s.most_lists][d[: s.most_lists] <= s.ratio * d[0] + 1e-12].tolist() for ranked, d in zip(order, far, strict=True)]


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Usable rows of the most frequent length."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0].d if lengths else 0))


def entered(rows: DataFrame, graph, settings: Settings, way: str, columns: list[str]) -> DataFrame:
    """Rows once per list that ``Graph.homes`` or ``Graph.probes`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Graph = graph.value
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                lists = getattr(own, way)(matrix(batch.column("v")), settings)
                index = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
                flat = pa.array([c for x in lists for c in x], pa.int32())
                yield pa.RecordBatch.from_arrays([flat, *(batch.column(c).take(index) for c in columns)], ["list", *columns])

    kinds = dict(rows.dtypes)
    return rows.select(*columns).mapInArrow(run, ", ".join(["list int", *(f"{c} {kinds[c]}" for c in columns)]))


def packed(rows: DataFrame, size: int, names: tuple[str, str]) -> DataFrame:
    """Consecutive rows of one list as blocks: a matrix in bytes and the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("list").to_numpy()
            cuts = np.flatnonzero(np.diff(lists, prepend=lists[:1] - 1))
            edges = [*cuts.tolist(), len(lists)]
            for a, b in zip(edges, edges[1:], strict=False):
                for c in range(a, b, size):
                    part = batch.slice(c, min(size, b - c))
                    block = matrix(part.column("v")).tobytes()
                    ids = part.column("ids")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(lists[a])], pa.int32()), pa.array([block], pa.binary()), pa.ListArray.from_arrays([0, len(ids)], ids)],
                        ["list", *names],
                    )

    kind = dict(rows.dtypes)["ids"]
    placed = rows.repartitionByRange("list", F.xxhash64("v")).sortWithinPartitions("list").select("list", "v", "ids")
    return placed.mapInArrow(run, f"list int, {names[0]} binary, {names[1]} array<{kind}>")


def answers(blocks: DataFrame, asked: DataFrame, settings: Settings, width: int) -> DataFrame:
    """For each block of vectors and each block of queries on the same list: each query's k best."""
    k = settings.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, ids, q, asker in zip(*(batch.column(c).to_pylist() for c in ("x", "ids", "q", "asker")), strict=True):
                points, queries = np.frombuffer(x).reshape(-1, width), np.frombuffer(q).reshape(-1, width)
                fast = (queries**2).sum(axis=1)[:, None] + (points**2).sum(axis=1) - 2 * queries @ points.T
                slack = 1e-9 * (1 + np.abs(fast).max())
                out_q, out_v, out_d = [], [], []
                at = min(k, len(points) - 1)
                limit = np.partition(fast, at, axis=1)[:, at] + slack
                for r, query in enumerate(asker):
                    near = np.flatnonzero(fast[r] <= limit[r])
                    d = np.sqrt(((points[near] - queries[r]) ** 2).sum(axis=1))
                    found = sorted((float(y), v) for y, j in zip(d, near, strict=True) for v in ids[j] if v != query)[:k]
                    out_q += [query] * len(found)
                    out_v += [v for _, v in found]
                    out_d += [y for y, _ in found]
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_d, pa.float64())], ["query_id", "vec_id", "score"])

    met = blocks.join(asked, "list").select("x", "ids", "q", "asker").mapInArrow(run, "query_id long, vec_id long, score double")
    return met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))


def best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """The k nearest other vectors of each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    s = settings or Settings()
    spark = table.sparkSession
    rows = vectors_of(table, id_col, vector_col)
    ranked = rows.distinct().withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= s.k + 1)
    distinct = staged(ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "distinct-vectors")
    total = distinct.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(s.sample).toArrow()
    sample = matrix(drawn.column("v").combine_chunks())
    leaves = max(1, min(total // s.list_size, len(sample) // 8))
    graph = spark.sparkContext.broadcast(Graph.of(bisected(sample, leaves, np.random.default_rng(11)), s.links))
    placed = staged(entered(distinct, graph, s, "homes", ["v", "ids"]), "in-lists")  # the range sort below reads it twice
    blocks = staged(packed(placed, s.block, ("x", "ids")), "blocks")
    queries = staged(rows.where(F.col("vec_id") % every == 0).select("v", F.col("vec_id").alias("ids")).distinct(), "queries")
    width = sample.shape[1]
    probing = staged(entered(queries, graph, s, "probes", ["v", "ids"]), "probes")
    asked = packed(probing, s.block, ("q", "asker"))
    found = staged(best(answers(blocks, asked, s, width), s.k), "found")
    # few candidates in the lists read: look through all of them
    enough = found.groupBy("query_id").count().where(F.col("count") >= s.k).select(F.col("query_id").alias("ids"))
    short = staged(queries.join(enough, "ids", "left_anti"), "short-queries")
    if short.isEmpty():
        return found
    everywhere = short.select(F.explode(F.sequence(F.lit(0), F.lit(leaves - 1))).alias("list"), "v", "ids")
    again = best(answers(blocks, packed(everywhere, s.block, ("q", "asker")), s, width), s.k)
    return found.join(short.select(F.col("ids").alias("query_id")), "query_id", "left_anti").unionByName(again)
