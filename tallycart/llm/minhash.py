"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on the full shingle sets.

Two collections of ``side`` short tuples of minhashes are computed; a table's key is a tuple of the first with one of the
second, so side * side tables come from 2 * side * tuple minhashes, the square root of what separate tables would need. A
pair of similarity s meets in some table unless it misses a whole side: with p = s ** tuple, it is missed with a chance
of less than 2 * (1 - p) ** side (1.5e-4 at 0.85 for tuples of 3 and sides of 10, less above).

1. Documents with equal sets collapse to the one with the smallest id.
2. Table entries are sorted by key and id over all partitions; runs of one key are kept. A run's first document leads it
   (in each partition it reaches), and each member is compared with its leader: no pairs of a hot bucket are listed.
3. Confirmed links give components. Members of a run that are in different components by now still have to meet. Runs with
   one tuple of the first side and one first document are taken together: a document stands in few such families, not in
   as many runs as there are tables, and a family whose members all are in its first document's component is settled.
   Members of the others are grouped by their tuple of the first side, so that a document stands in ``side`` groups at
   most. Groups are packed into blocks of bounded size, blocks of one group are paired, and a task passes on
   only pairs that share a tuple of the second side too and none of the first side before this one, may reach the
   similarity by size and by their distances from a common leader (Jaccard distance is a metric), and agree in enough of
   ``sketch`` further minhashes of 8 bits: ``slack`` standard deviations below the limit, which loses a link with a chance
   of 4e-6 at most, less than the tables do. Survivors not compared before are confirmed on the full sets.

Texts are read whole. Null and empty texts have an empty set and no links. Rows with a null id take no part. Rows that
repeat an id are one node. Other columns are left aside.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import pieces, texts_of
from tallycart.llm.components import components
from tallycart.llm.textcode import U64, Packed, grams, mixed
from tallycart.session import staged


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 85
    tuple: int = 3
    side: int = 10
    seed: int = 7
    sketch: int = 256
    slack: float = 4.5
    block: int = 256


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct codes of each text's windows of words; of all its words, if they are fewer."""
    packed = Packed.of(texts, lower=True)
    starts, ends = packed.words()
    codes, text = packed.codes(starts, ends), packed.text_of(starts)
    out, first = grams(codes, text, words)
    owner = text[first] if len(first) else np.zeros(0, dtype=np.int64)
    counts = np.bincount(text, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(counts)))
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = []
    for k in range(len(texts)):
        if 0 < counts[k] < words:
            whole, _ = grams(codes[at[k] : at[k + 1]], np.zeros(counts[k], dtype=np.int64), int(counts[k]))
            sets.append(mixed(whole + U64(counts[k])))
        else:
            sets.append(np.unique(out[edges[k] : edges[k + 1]]))
    return sets


def tuples(codes: np.ndarray, settings: Settings) -> np.ndarray:
    """Codes of the 2 * side tuples of minhashes of one set."""
    n = 2 * settings.side * settings.tuple
    seeds = np.random.default_rng(settings.seed).integers(1, 1 << 63, n, dtype=np.uint64)
    least = np.empty(n, dtype=U64)
    for k, seed in enumerate(seeds):
        x = (codes ^ seed) * U64(0x9FB21C651E98DF25)
        least[k] = ((x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)).min()
    least = least.reshape(2 * settings.side, settings.tuple)
    out = np.zeros(2 * settings.side, dtype=U64)
    for k in range(settings.tuple):
        out = mixed(out * U64(3) + least[:, k])
    return out


def sketched(codes: np.ndarray, settings: Settings) -> bytes:
    """Low bytes of ``sketch`` further minhashes."""
    seeds = np.random.default_rng(settings.seed + 1).integers(1, 1 << 63, settings.sketch, dtype=np.uint64)
    out = np.empty(settings.sketch, dtype=np.uint8)
    step = max(1, (1 << 17) // len(codes))
    for k in range(0, settings.sketch, step):
        x = (codes[None, :] ^ seeds[k : k + step, None]) * U64(0x9FB21C651E98DF25)
        out[k : k + step] = mixed(((x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)).min(axis=1)) & U64(255)
    return out.tobytes()


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: id, set size, a 128-bit code of the set, and both sides' tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in pieces(texts):
                sets = shingle_sets(texts[a:b], settings.words)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                high = np.array([s.sum(dtype=U64) if len(s) else U64(0) for s in sets], dtype=U64).view(np.int64)
                low = np.array([mixed(s ^ U64(0x5BD1E995)).sum(dtype=U64) if len(s) else U64(0) for s in sets], dtype=U64).view(np.int64)
                drawn = [tuples(s, settings).view(np.int64) if len(s) else np.zeros(2 * settings.side, dtype=np.int64) for s in sets]
                flat = pa.array(np.concatenate(drawn)) if drawn else pa.array([], pa.int64())
                edges = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * 2 * settings.side)
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(high), pa.array(low), pa.ListArray.from_arrays(edges, flat)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "high", "low", "tuples"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, n long, high long, low long, tuples array<long>")


def keyed(signed: DataFrame, side: int) -> DataFrame:
    """An entry per table: its number, key, id and set size."""
    first, second = F.slice("tuples", 1, side), F.slice("tuples", side + 1, side)
    keys = F.flatten(F.transform(first, lambda x, i: F.transform(second, lambda y, j: F.xxhash64(i, j, x, y))))
    return signed.select(F.posexplode(keys).alias("slot", "key"), "doc_id", "n")


def runs(entries: DataFrame) -> DataFrame:
    """Entries whose key occurs more than once, with the leader of their run. Runs at a partition's ends are all kept and
    marked, as they may go on in the next one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        lead, at_start = None, True  # the held row's leader; whether its run began the partition
        joined_before = False
        for batch in [*_merged(batches), None]:
            if batch is None and held is None:
                return
            rows = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            rows = rows.combine_chunks()
            keys = rows.column("key").to_numpy()
            ids = rows.column("doc_id").to_pylist() if not pa.types.is_integer(rows.schema.field("doc_id").type) else rows.column("doc_id").to_numpy()
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            begin = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            leaders = np.array([ids[k] for k in begin], dtype=object if isinstance(ids, list) else None)[run]
            edge = (run == 0) & at_start
            same_before = ~new
            if held is not None and lead is not None:
                leaders[run == 0] = lead
                same_before[0] = joined_before
            last = batch is None
            same_after = np.concatenate((~new[1:], [False]))
            if last:
                edge |= run == run[-1]
            keep = same_before | same_after | edge
            stop = len(keys) if last else len(keys) - 1
            chosen = np.flatnonzero(keep[:stop])
            if len(chosen):
                taken = rows.take(pa.array(chosen))
                yield from pa.table(
                    [*(taken.column(c) for c in ("slot", "key", "doc_id", "n")), pa.array(leaders[chosen], taken.schema.field("doc_id").type), pa.array(edge[chosen])],
                    names=["slot", "key", "doc_id", "n", "leader", "edge"],
                ).to_batches()
            if last:
                return
            held, lead, joined_before = rows.slice(len(keys) - 1), leaders[-1], bool(same_before[-1])
            at_start = bool(edge[-1])

    kind = dict(entries.dtypes)["doc_id"]
    placed = entries.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    return placed.mapInArrow(scan, f"slot int, key long, doc_id {kind}, n long, leader {kind}, edge boolean")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def sets_of(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The full sets of the wanted ids, as bytes, and their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in pieces(texts):
                sets = shingle_sets(texts[a:b], settings.words)
                columns = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([sketched(s, settings) if len(s) else b"" for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], ["doc_id", "codes", "sketch"])

    return docs.join(wanted, "doc_id", "left_semi").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, codes binary, sketch binary")


def met(packs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of members that meet in a table, in different components, and may be similar enough; each from the group of
    the first tuple of the first side that they share."""
    s = settings
    share = s.percent / 100
    # two sets of similarity ``share`` agree in a byte as often as in a minhash, and in one of 256 other cases
    agree = share + (1 - share) / 256
    least = s.sketch * agree - s.slack * np.sqrt(s.sketch * agree * (1 - agree))

    def members(rows: list[dict]) -> dict[str, np.ndarray]:
        out = {c: np.array([r[c] for r in rows]) for c in ("doc_id", "label", "leader", "n")}
        out["gap"] = np.array([np.nan if r["gap"] is None else r["gap"] for r in rows], dtype=float)
        out["tuples"] = np.array([r["tuples"] for r in rows])
        out["sketch"] = np.frombuffer(b"".join(r["sketch"] for r in rows), dtype=np.uint8).reshape(len(rows), s.sketch)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                at = batch.column("tuple")[k].as_py()
                x, y = (members(batch.column(c)[k].as_py()) for c in ("x", "y"))
                far = lambda c: (x[c][:, None], y[c][None, :])
                (a, b), (n, m), (p, q) = far("doc_id"), far("n"), far("label")
                fits = (a != b) & (p != q)
                fits &= np.minimum(n, m) * 100 >= np.maximum(n, m) * s.percent
                fits &= ~((x["leader"][:, None] == y["leader"][None, :]) & (np.abs(x["gap"][:, None] - y["gap"][None, :]) > 1 - share + 1e-9))
                if batch.column("same")[k].as_py():
                    fits &= a < b
                i, j = np.nonzero(fits)
                if len(i):
                    equal = x["tuples"][i] == y["tuples"][j]
                    here = equal[:, at] & ~equal[:, :at].any(axis=1) & equal[:, s.side :].any(axis=1)
                    i, j = i[here], j[here]
                    close = (x["sketch"][i] == y["sketch"][j]).sum(axis=1) >= least
                    i, j = i[close], j[close]
                u, v = x["doc_id"][i], y["doc_id"][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])

    x = packs.select("tuple", "key", F.col("block").alias("i"), F.col("members").alias("x"))
    y = packs.select("tuple", "key", F.col("block").alias("j"), F.col("members").alias("y"))
    joined = x.join(y, ["tuple", "key"]).where("i <= j").select("tuple", "x", "y", (F.col("i") == F.col("j")).alias("same"))
    return joined.mapInArrow(run, "a long, b long")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of intersection and union of their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, union = [], []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=U64) for c in ("x", "y"))
                inside = len(np.intersect1d(x, y, assume_unique=True))
                both.append(inside)
                union.append(len(x) + len(y) - inside)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "both", "union"])

    kind = dict(pairs.dtypes)["a"]
    joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("codes").alias("y")), "b")
    joined = joined.join(sets.select(F.col("doc_id").alias("a"), F.col("codes").alias("x")), "a")
    return joined.select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}, both long, union long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """Per row: id, set size, component (its smallest id) and whether the row is the component's kept document."""
    s = settings or Settings()
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = staged(signatures(slim, s), "signatures")
    named = signed.where("doc_id is not null and n > 0")
    firsts = staged(named.groupBy("high", "low", "n").agg(F.min("doc_id").alias("first")), "first-of-equal-sets")
    distinct = staged(named.join(firsts.select(F.col("first").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n", "tuples"), "distinct-sets")
    buckets = staged(runs(keyed(distinct, s.side)), "buckets")

    # a set can only be similar enough to one of nearly its size
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * s.percent
    sizes = distinct.select(F.col("doc_id").alias("leader"), F.col("n").alias("leader_n"))
    led = buckets.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).where("a != b")
    ends = buckets.where("edge").select("key", "leader").distinct()
    tops = ends.groupBy("key").agg(F.min("leader").alias("top"))
    led = led.unionByName(ends.join(tops, "key").where("leader != top").select(F.col("top").alias("a"), F.col("leader").alias("b")))
    led = led.distinct().join(distinct.select(F.col("doc_id").alias("b"), F.col("n").alias("b_n")), "b")
    led = staged(led.join(sizes.withColumnRenamed("leader", "a"), "a").where(fits(F.col("b_n"), F.col("leader_n"))).select("a", "b"), "led-pairs")
    sets = staged(sets_of(slim, buckets.select("doc_id").distinct(), s), "sets")
    first_round = staged(compared(led, sets), "compared-with-leaders")
    linked = F.col("both") * 100 >= F.col("union") * s.percent
    links = first_round.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = components(links)

    # the second round: members of one run in different components. Runs of one first-side tuple and one first document are
    # a family, which is open if a member's component isn't the first document's: a document is not met once for each table
    slim_runs = buckets.where("not edge").select("slot", "doc_id", "n", "leader", F.col("leader").alias("top"))
    slim_runs = slim_runs.unionByName(buckets.where("edge").join(tops, "key").select("slot", "doc_id", "n", "leader", "top"))
    family = F.floor(F.col("slot") / s.side).cast("int").alias("tuple")
    families = slim_runs.groupBy(family, "top", "doc_id").agg(F.min("leader").alias("leader"), F.min("n").alias("n"))
    label = lambda at: labels.select(F.col("node").alias(at), F.col("label").alias(f"{at}_label"))
    families = families.join(label("doc_id"), "doc_id", "left").join(label("top"), "top", "left")
    families = families.withColumn("label", F.coalesce("doc_id_label", "doc_id")).withColumn("loose", F.col("label") != F.coalesce("top_label", "top"))
    families = staged(families.select("tuple", "top", "doc_id", "leader", "n", "label", "loose"), "families")
    open_families = families.groupBy("tuple", "top").agg(F.max("loose").alias("open"), F.count("*").alias("members"))
    open_families = staged(open_families.where("open and members > 2").select("tuple", "top"), "open-families")
    # families of one tuple of the first side are one group here, so a document stands in ``side`` groups at most
    rest = families.join(open_families, ["tuple", "top"], "left_semi")
    rest = rest.groupBy("doc_id", "tuple").agg(F.min("leader").alias("leader"), F.min("label").alias("label"), F.min("n").alias("n"))
    gap = (F.lit(1.0) - F.col("both") / F.col("union")).alias("gap")
    gaps = first_round.select(F.col("a").alias("leader"), F.col("b").alias("doc_id"), gap)
    rest = rest.join(gaps, ["leader", "doc_id"], "left")
    rest = rest.withColumn("gap", F.when(F.col("leader") == F.col("doc_id"), F.lit(0.0)).otherwise(F.col("gap")))
    rest = rest.join(distinct.select("doc_id", "tuples"), "doc_id").join(sets.select("doc_id", "sketch"), "doc_id")
    rest = staged(rest.withColumn("key", F.get("tuples", F.col("tuple"))), "members-to-compare")
    large = rest.groupBy("tuple", "key").agg(F.count("*").alias("members")).where(F.col("members") > s.block)
    rest = rest.join(staged(large, "large-groups"), ["tuple", "key"], "left")
    block = F.pmod(F.xxhash64("doc_id"), F.ceil(F.coalesce("members", F.lit(1)) / s.block)).alias("block")
    member = F.struct("doc_id", "label", "leader", "n", "gap", "tuples", "sketch")
    packs = staged(rest.groupBy("tuple", "key", block).agg(F.collect_list(member).alias("members")), "packs")
    others = staged(met(packs, s).join(led, ["a", "b"], "left_anti"), "other-pairs")
    second = compared(others, sets).where(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
    second = staged(second, "links-of-second-round")
    if not second.isEmpty():
        labels = components(links.unionByName(second))

    of_set = firsts.join(labels.withColumnRenamed("node", "first"), "first", "left")
    of_set = staged(of_set.select("high", "low", "n", F.coalesce("label", "first").alias("label")), "label-of-set")
    out = signed.join(of_set, ["high", "low", "n"], "left")
    label = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("label", "doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), label.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """The rows of the kept documents, one row for each id; all rows with a null id."""
    found = staged(near_duplicates(docs, id_col, text_col, settings), "near-duplicates")
    dropped = found.where("not kept").select(F.col("doc_id").alias(id_col))
    kept = docs.join(dropped.distinct(), id_col, "left_anti").select(*docs.columns)
    again = staged(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col)), "repeated")
    if again.isEmpty():
        return kept
    return kept.join(again, id_col, "left_anti").unionByName(kept.join(again, id_col, "left_semi").dropDuplicates([id_col])).select(*docs.columns)
