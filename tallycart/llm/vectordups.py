"""Near-duplicate vectors by Euclidean p-stable hashing, every link by its exact cosine.

Vectors are brought to length 1, where a cosine is a distance. A table's key joins ``k`` quantised random projections
floor((a.v + b) / width) with normal a; there are as many tables as a pair exactly at the limit needs to miss all of them
with a chance of ``miss`` (1e-6) at most, and k grows with the logarithm of the number of vectors, so that a vector shares a
bucket with about ``mates`` unrelated ones at any size. Projections multiply whole numbers, which doubles do exactly: a
key is a pure function of its vector in any task.

1. Equal vectors collapse to one with its weight.
2. Entries of key, id and a sketch of 128 signs are sorted over all partitions. Neighbours with the same key and sketches that
   are close enough for the limit (4.5 standard deviations, which loses 1e-5 of the links at the limit) go on.
3. Only those entries meet again with their vectors. Buckets are compared as matrices. A pair counts in the first table
   that both share, so numbers of links need no list of pairs; of its links a bucket passes on a spanning forest.

A bucket beyond ``pack`` entries is cut into packs that the sort may lay into several partitions; packs meet pairwise in a grid
of tasks. In step 2 packs whose entries have all met a partner already needn't meet, so a dense group costs no square there;
in step 3 it costs matrix products, which counting its links takes.

Vectors that are null, zero, hold null or non-finite entries or are of another length than most (the shorter of equally
frequent lengths) link with nothing. Rows that repeat an id are one: a usable vector before others, then the least by
entries. Rows with a null id come back unlinked, without a component, and kept. A cosine at exactly the limit is a link.
An empty table gives no rows. Extra columns are left aside.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.components import components
from tallycart.llm.neighbours import usable
from tallycart.llm.textcode import U64, mixed
from tallycart.operators.skew import salted_join
from tallycart.session import staged

SLOT_BITS = 10  # low bits of a key: its table


@dataclass(frozen=True)
class Settings:
    limit: float = 0.95
    width: float = 2.0
    miss: float = 1e-6
    mates: int = 64
    bits: int = 128
    slack: float = 4.5
    pack: int = 1024
    grid: int = 16  # packs of one bucket that meet in one task
    seed: int = 12

    @property
    def most_apart(self) -> int:
        """Signs in which sketches of a linked pair may differ."""
        share = math.acos(self.limit) / math.pi
        return int(self.bits * share + self.slack * math.sqrt(self.bits * share * (1 - share)))


def collision(distance: float, width: float) -> float:
    """The chance of one value for two vectors at this distance."""
    c = distance / width
    return math.erf(1 / (c * math.sqrt(2))) - 2 * c / math.sqrt(2 * math.pi) * (1 - math.exp(-1 / (2 * c * c)))


@dataclass(frozen=True)
class Hashing:
    """The tables for vectors of one length."""

    d: int
    k: int
    tables: int
    settings: Settings

    @classmethod
    def of(cls, n: int, d: int, s: Settings) -> Hashing:
        near, far = collision(math.sqrt(2 - 2 * s.limit), s.width), collision(math.sqrt(2), s.width)
        k = max(1, math.ceil(math.log(max(n / s.mates, 1)) / -math.log(far)))
        tables = math.ceil(math.log(s.miss) / math.log1p(-(near**k)))
        if tables >> SLOT_BITS:
            raise ValueError(f"{tables} tables are needed; raise mates or miss")
        return cls(d, k, tables, s)

    def functions(self) -> tuple[Callable[[np.ndarray], np.ndarray], Callable[[np.ndarray], np.ndarray]]:
        """From unit vectors to keys (a column per table) and to sketches."""
        rng = np.random.default_rng(self.settings.seed)
        slopes = np.rint(rng.standard_normal((self.d, self.tables * self.k)) * (1 << 12))
        step = self.settings.width * (1 << 36)
        offsets = np.floor(rng.random(self.tables * self.k) * step)
        signs = np.rint(rng.standard_normal((self.d, self.settings.bits)) * (1 << 12))
        salts = rng.integers(1, 1 << 63, self.tables, dtype=np.uint64)
        slots = np.arange(self.tables, dtype=np.uint64)

        def keys(unit: np.ndarray) -> np.ndarray:
            cells = np.floor((np.rint(unit * (1 << 24)) @ slopes + offsets) / step).astype(np.int64).view(U64).reshape(len(unit), self.tables, self.k)
            out = np.broadcast_to(salts, (len(unit), self.tables)).copy()
            for j in range(self.k):
                out = mixed(out * U64(3) + cells[:, :, j])
            return ((out >> U64(SLOT_BITS) << U64(SLOT_BITS)) | slots).view(np.int64)

        def sketches(unit: np.ndarray) -> np.ndarray:
            return np.packbits(np.rint(unit * (1 << 24)) @ signs > 0, axis=1)

        return keys, sketches


def unit(vectors: np.ndarray) -> np.ndarray:
    if not len(vectors):
        return vectors
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def rows_of(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """Equally long binary values as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


def packed(distinct: DataFrame) -> DataFrame:
    """id, weight and the entries of the vector as doubles in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("v")
                flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("weight"), pa.array([r.tobytes() for r in flat], pa.binary())], ["id", "weight", "v"])

    return distinct.select("id", "weight", "v").mapInArrow(run, "id long, weight long, v binary")


def entries(vectors: DataFrame, hashing: Hashing, kind: str) -> DataFrame:
    """key, id and sketch (in ``data``) of every vector in every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sketches = hashing.functions()
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                own = unit(rows_of(batch.column("v"), hashing.d, kind).astype(np.float64))
                which = pa.array(np.repeat(np.arange(len(own)), hashing.tables))
                drawn = pa.array([x.tobytes() for x in sketches(own)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(keys(own).ravel()), batch.column("id").take(which), drawn.take(which)], ["key", "id", "data"])

    return vectors.select("id", "v").mapInArrow(run, "key long, id long, data binary")


@dataclass(frozen=True)
class Pack:
    """Entries of one key; ``met`` marks those that have a partner already."""

    key: int
    ids: np.ndarray
    data: list[bytes]
    met: np.ndarray


Within = Callable[[np.ndarray, np.ndarray, np.ndarray, list[bytes]], tuple[list[tuple], np.ndarray]]  # cuts, key, ids, data
Across = Callable[[Pack, Pack], list[tuple]]


def compared(given: DataFrame, within: Callable[[], Within], across: Callable[[], Across], names: list[str], only_open: bool, s: Settings) -> DataFrame:
    """Rows of ``names`` (longs) from comparing the entries (key, id, data) of each key.

    ``within`` compares the entries of each cut, which is a bucket or a pack of one, and tells which have met; ``across``
    does so for two packs of one bucket. With ``only_open``, packs whose entries have all met need not meet.
    """
    pack_names = ["key", "no", "ids", "data", "met"]
    pack_schema = "key long, no long, ids array<long>, data array<binary>, met array<boolean>"
    schema = ", ".join(f"{n} long" for n in names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, part, made = within(), TaskContext.get().partitionId(), 0
        key, ids, data, opened = np.zeros(0, np.int64), np.zeros(0, np.int64), [], True  # the last cut's entries; a partition's first bucket is open

        def out(stop: int, cuts: np.ndarray, spans: list[tuple[int, int]]) -> pa.RecordBatch:
            nonlocal made
            rows, met = judge(cuts, key[:stop], ids[:stop], data[:stop])
            nothing = [None] * len(rows)
            columns = [pa.array([r[j] for r in rows] + [None] * len(spans), pa.int64()) for j in range(len(names))]
            packs = [
                pa.array(nothing + [int(key[a]) for a, _ in spans], pa.int64()),
                pa.array(nothing + [(part << 32) + made + j for j in range(len(spans))], pa.int64()),
                pa.array(nothing + [ids[a:b] for a, b in spans], pa.list_(pa.int64())),
                pa.array(nothing + [data[a:b] for a, b in spans], pa.list_(pa.binary())),
                pa.array(nothing + [met[a:b] for a, b in spans], pa.list_(pa.bool_())),
            ]
            made += len(spans)
            return pa.RecordBatch.from_arrays([*columns, *packs], [*names, *(f"pack_{n}" for n in pack_names)])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column("key").to_numpy()])
            ids = np.concatenate([ids, batch.column("id").to_numpy()])
            data = data + batch.column("data").to_pylist()
            begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            run = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
            cuts = np.flatnonzero((np.arange(len(key)) - begins[run]) % s.pack == 0)
            is_open = (np.bincount(run[cuts]) > 1)[run[cuts]] | ((run[cuts] == 0) & opened)
            last = int(cuts[-1])  # may go on in the next batch
            if last:
                yield out(last, cuts[:-1], [(int(a), int(b)) for a, b, x in zip(cuts, cuts[1:], is_open, strict=False) if x])
            key, ids, data, opened = key[last:], ids[last:], data[last:], bool(is_open[-1])
        if len(key):
            yield out(len(key), np.zeros(1, dtype=np.int64), [(0, len(key))])

    placed = given.repartitionByRange("key", "id").sortWithinPartitions("key", "id").select("key", "id", "data")
    pack_columns = ", ".join(f"pack_{c}" for c in pack_schema.split(", "))
    scanned = staged(placed.mapInArrow(scan, f"{schema}, {pack_columns}"), "compared")
    found = scanned.where("pack_key is null").select(*names)

    packs = scanned.where("pack_key is not null").select(*(F.col(f"pack_{n}").alias(n) for n in pack_names))
    sizes = packs.groupBy("key").agg(F.count("*").alias("packs")).where("packs > 1")
    packs = staged(packs.join(sizes, "key").withColumn("cells", F.ceil(F.col("packs") / s.grid).cast("int")), "open-packs")
    cells = F.sequence(F.lit(0), F.col("cells") - 1)
    own = F.pmod(F.xxhash64("no"), F.col("cells")).cast("int")
    x = packs.select("key", own.alias("i"), F.explode(cells).alias("j"), F.struct("no", "ids", "data", "met").alias("x"))
    y = packs.select("key", F.explode(cells).alias("i"), own.alias("j"), F.struct("no", "ids", "data", "met").alias("y"))
    pairs = x.join(y, ["key", "i", "j"]).where("x.no < y.no")
    if only_open:
        pairs = pairs.where(F.exists("x.met", lambda m: ~m) | F.exists("y.met", lambda m: ~m))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = across()
        for batch in batches:
            for k in range(batch.num_rows):
                key = batch.column("key")[k].as_py()
                a, b = (Pack(key, np.array(r["ids"]), r["data"], np.array(r["met"])) for r in (batch.column(c)[k].as_py() for c in "xy"))
                rows = judge(a, b)
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(len(names))], names)

    return found.unionByName(pairs.select("key", "x", "y").mapInArrow(meet, schema))


def sketch_partners(s: Settings) -> tuple[Callable[[], Within], Callable[[], Across]]:
    """Entries (key, id) that have a partner with a close sketch."""
    apart, words = s.most_apart, s.bits // 64

    def within() -> Within:
        def judge(cuts: np.ndarray, key: np.ndarray, ids: np.ndarray, data: list[bytes]) -> tuple[list[tuple], np.ndarray]:
            signs = np.frombuffer(b"".join(data), dtype=np.uint64).reshape(len(key), words)
            cut = np.repeat(np.arange(len(cuts)), np.diff([*cuts, len(key)]))
            met = np.zeros(len(key), dtype=bool)
            at, step = np.arange(len(key)), 1
            while True:
                at = at[at < len(key) - step]
                at = at[cut[at] == cut[at + step]]
                if not len(at):
                    break
                near = at[np.bitwise_count(signs[at] ^ signs[at + step]).sum(axis=1, dtype=np.int64) <= apart]
                met[near] = met[near + step] = True
                step += 1
            return list(zip(key[met].tolist(), ids[met].tolist(), strict=True)), met

        return judge

    def across() -> Across:
        def judge(x: Pack, y: Pack) -> list[tuple]:
            a, b = (np.frombuffer(b"".join(p.data), dtype=np.uint64).reshape(len(p.ids), words) for p in (x, y))
            rows = np.flatnonzero(~x.met) if y.met.all() else np.arange(len(a))
            hit_x, hit_y = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
            for r in rows:
                near = np.bitwise_count(a[r] ^ b).sum(axis=1, dtype=np.int64) <= apart
                hit_x[r] = near.any()
                hit_y |= near
            return [(x.key, int(v)) for v in (*x.ids[hit_x], *y.ids[hit_y])]

        return judge

    return within, across


def counted_links(hashing: Hashing, kind: str, s: Settings) -> tuple[Callable[[], Within], Callable[[], Across]]:
    """Rows (id, null, weight of its links) and (id, id, null) of a spanning forest, for pairs that meet in this table
    first. Data are 8 bytes of weight and the vector."""

    def split(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(len(data), -1)
        return joined[:, :8].copy().view(">i8")[:, 0], joined[:, 8:].copy().view(kind).astype(np.float64)

    def links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = lambda m: np.sqrt((m**2).sum(axis=1))
        top = lambda m: m / np.abs(m).max(axis=1, keepdims=True)
        a, b = top(a), top(b)
        cosine = (a @ b.T) / np.outer(size(a), size(b))
        out = cosine >= s.limit
        for i, j in zip(*np.nonzero(np.abs(cosine - s.limit) < 1e-12), strict=True):  # a product's last bits depend on its shape
            out[i, j] = (a[i] * b[j]).sum() / math.sqrt((a[i] ** 2).sum() * (b[j] ** 2).sum()) >= s.limit
        return out

    def fresh(linked: np.ndarray, a: np.ndarray, b: np.ndarray, slot: int, keys) -> np.ndarray:
        """Links of pairs that share no earlier table."""
        i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if slot and len(i):
            one, two = keys(unit(a[i]))[:, :slot], keys(unit(b[j]))[:, :slot]
            before = np.zeros((len(i), len(j)), dtype=bool)
            for t in range(slot):
                before |= one[:, t, None] == two[None, :, t]
            linked[np.ix_(i, j)] &= ~before
        return linked

    def forest(linked: np.ndarray) -> list[tuple[int, int]]:
        """Edges that join what a symmetric matrix links."""
        label = np.arange(len(linked))
        while True:
            least = np.minimum(label, np.where(linked, label, len(label)).min(axis=1, initial=len(label)))
            if (least == label).all():
                return [(int(k), int(v)) for k, v in enumerate(label) if k != v]
            label = least

    def within() -> Within:
        keys, _ = hashing.functions()

        def judge(cuts: np.ndarray, key: np.ndarray, ids: np.ndarray, data: list[bytes]) -> tuple[list[tuple], np.ndarray]:
            rows, (weight, vectors) = [], split(data)
            edges = [*cuts.tolist(), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b - a < 2:
                    continue
                own = vectors[a:b]
                linked = links(own, own)
                linked &= linked.T
                np.fill_diagonal(linked, False)
                linked = fresh(linked, own, own, int(key[a]) & ((1 << SLOT_BITS) - 1), keys)
                total = linked @ weight[a:b]
                rows += [(int(ids[a + k]), None, int(total[k])) for k in np.flatnonzero(total)]
                rows += [(int(ids[a + k]), int(ids[a + v]), None) for k, v in forest(linked)]
            return rows, np.zeros(len(key), dtype=bool)

        return judge

    def across() -> Across:
        keys, _ = hashing.functions()

        def judge(x: Pack, y: Pack) -> list[tuple]:
            (weight_a, a), (weight_b, b) = split(x.data), split(y.data)
            linked = fresh(links(a, b), a, b, x.key & ((1 << SLOT_BITS) - 1), keys)
            i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            inner = linked[np.ix_(i, j)]
            both = np.zeros((len(i) + len(j),) * 2, dtype=bool)
            both[: len(i), len(i) :], both[len(i) :, : len(i)] = inner, inner.T
            ids = np.concatenate([x.ids[i], y.ids[j]])
            total = np.concatenate([inner @ weight_b[j], inner.T @ weight_a[i]])
            rows = [(int(v), None, int(n)) for v, n in zip(ids, total, strict=True)]
            return rows + [(int(ids[k]), int(ids[v]), None) for k, v in forest(both)]

        return judge

    return within, across


def one_per_id(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, null where the vector isn't usable; rows with a null id aside."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null")
    rows = rows.select("vec_id", F.when(usable(F.col("v")), F.col("v")).alias("v"))
    again = staged(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated-ids")
    if not again.isEmpty():
        several = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
        rows = rows.join(again, "vec_id", "left_anti").unionByName(several)
    lengths = rows.where("v is not null").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.withColumn("v", F.when(F.size("v") == (lengths[0].d if lengths else 0), F.col("v")))


def linked_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (the smallest id reachable by links), kept."""
    s = settings or Settings()
    rows = one_per_id(table, id_col, vector_col)
    code = F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit("again"), "v").alias("b"))
    distinct = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    distinct = staged(distinct.withColumn("code", code), "distinct-vectors")
    shape = distinct.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    labels, counts = None, None
    if shape.n > 1:
        hashing = Hashing.of(shape.n, shape.d, s)
        kind = "<f4" if dict(table.dtypes)[vector_col] == "array<float>" else "<f8"
        wide = distinct if kind == "<f4" else distinct.withColumn("v", F.col("v").cast("array<double>"))
        vectors = staged(packed(wide), "packed-vectors")
        hits = staged(compared(entries(vectors, hashing, kind), *sketch_partners(s), ["key", "id"], True, s).distinct(), "bucket-partners")
        weighed = vectors.select("id", F.concat(F.to_binary(F.lpad(F.hex("weight"), 16, "0"), F.lit("hex")), F.col("v")).alias("data"))
        found = staged(compared(hits.join(weighed, "id").select("key", "id", "data"), *counted_links(hashing, kind, s), ["u", "v", "n"], False, s), "links")
        counts = found.where("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("links"))
        labels = components(found.where("v is not null").select("u", "v").distinct())
    of_vector = distinct.select("code", "id", "weight")
    if counts is None:
        of_vector = of_vector.withColumn("links", F.lit(0)).withColumn("label", F.col("id"))
    else:
        of_vector = of_vector.join(counts, "id", "left").join(labels.select(F.col("node").alias("id"), "label"), "id", "left")
    found = of_vector.select("code", "weight", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "id").alias("component_id"))
    out = salted_join(rows.select("vec_id", F.when(F.col("v").isNotNull(), code).alias("code")), found, "code", "vec_id", "weight", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    unnamed = table.where(F.col(id_col).isNull()).select(F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(True))
    return out.union(unnamed)
