"""A random forest for a number, with importances and R squared, whose work per level is one pass over slim rows.

As in Spark's own forest, inputs are cut into at most 32 bins, every tree weighs every row by its own Poisson draw of mean 1, and a
node takes the cut that lowers the squared error most. Rows become (cell, target, hash): the cell numbers the bins of all inputs.
They are ranged and sorted by cell, so that a task adds up the rows of a cell for each tree before it looks for their node; draws
are a pure function of hash and tree, made anew in each pass, so nothing is kept per tree and row and retries agree. A pass
returns sums per tree, node, input and bin, which are added by tree; the driver holds the cuts of the trees only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.session import staged

BINS = 32  # of each input
CUT_ROWS = 10_000  # rows whose values set the cuts, as many as Spark's forest takes
STEP = 1 << 17  # rows that a task works on at once
TINY = 1e-12  # shares of a node's squares that count as no gain

# 2 ** 32 times the chance of at most k for a Poisson draw of mean 1.
POISSON = np.array([min(2**32 - 1, round(2**32 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)))) for k in range(13)], np.uint64).astype(np.uint32)
GOLDEN, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def cuts_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts between neighbouring values, all of them or those next to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride, out = len(values) / bins, []
    target, below = stride, np.cumsum(counts)
    for k in range(1, len(distinct)):
        if abs(below[k - 1] - target) < abs(below[k] - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out)


def bin_of(value: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """The number of cuts below a value; a value at a cut lies below it."""
    if not len(cuts):
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value <= F.lit(float(cuts[middle])), bin_of(value, cuts[:middle], first)).otherwise(bin_of(value, cuts[middle + 1 :], first + middle + 1))


def stepped(times: int) -> np.uint64:
    return np.uint64(times * GOLDEN % 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's last step, in place."""
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def drawn(bits: np.ndarray) -> np.ndarray:
    """Poisson draws of mean 1 from 32 random bits each."""
    out = (bits >= POISSON[0]).view(np.uint8)
    for k in (1, 2, 3):
        out += bits >= POISSON[k]
    many = np.flatnonzero(out == 4)
    out[many] += np.searchsorted(POISSON[4:], bits[many], side="right").astype(np.uint8)
    return out


def weights(hashes: np.ndarray, trees: int, seed: int) -> Iterator[np.ndarray]:
    """The draws of some rows, one array per tree."""
    start = mixed(hashes.view(np.uint64) + stepped(seed))
    for pair in range(-(-trees // 2)):
        bits = mixed(start + stepped(pair + 1)).view(np.uint32).reshape(-1, 2)
        for half in range(min(2, trees - 2 * pair)):
            yield drawn(np.ascontiguousarray(bits[:, half]))


def apart(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows of one cell and hash, which follow each other, by counting them."""
    new = np.r_[True, (cells[1:] != cells[:-1]) | (hashes[1:] != hashes[:-1])]
    if new.all():
        return hashes
    place = np.arange(len(cells))
    place -= np.maximum.accumulate(np.where(new, place, 0))
    return (hashes.view(np.uint64) + place.astype(np.uint64) * MIX_2).view(np.int64)


@dataclass
class Trees:
    """Cuts of all trees by node; the children of node k are 2k and 2k + 1, 1 is the root, and a leaf has input -1."""

    inputs: np.ndarray
    cuts: np.ndarray
    means: np.ndarray

    def nodes(self, tree: int, bins: np.ndarray, level: int) -> np.ndarray:
        """The node of each cell at a level, or the leaf it stays in. ``bins``: inputs x cells."""
        at, every = np.ones(bins.shape[1], np.int32), np.arange(bins.shape[1])
        inputs, cuts = self.inputs[tree], self.cuts[tree]
        for _ in range(level):
            own = inputs[at]
            right = bins[own, every] > cuts[at]
            at = np.where(own >= 0, 2 * at + right, at)
        return at


def bins_of(cells: np.ndarray, inputs: int) -> np.ndarray:
    return np.stack([(cells // BINS**k % BINS).astype(np.int8) for k in range(inputs)])


def in_steps(batches: Iterator[pa.RecordBatch], step: int = STEP) -> Iterator[list[np.ndarray]]:
    """The columns of some rows at once."""
    held, rows = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows >= step:
            yield [np.concatenate(c) for c in zip(*held)]
            held, rows = [], 0
    if rows:
        yield [np.concatenate(c) for c in zip(*held)]


def level_sums(rows: DataFrame, trees: Trees, count: int, inputs: int, level: int, seed: int) -> DataFrame:
    """(tree, node, sums): weights and weighted targets per input and bin, from each task."""
    first, width = 1 << level, inputs * BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, 2, first * width))
        for cells, targets, hashes in in_steps(batches):
            begins = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            bins = bins_of(cells[begins], inputs)
            for tree, weight in enumerate(weights(apart(cells, hashes), count, seed)):
                totals = np.add.reduceat(weight, begins, dtype=np.float64), np.add.reduceat(weight * targets, begins)
                nodes = trees.nodes(tree, bins, level)
                places = (nodes - first) * width
                open_ = np.flatnonzero((nodes >= first) & (trees.inputs[tree][nodes] == -2) & (totals[0] > 0))
                if len(open_) < len(nodes):
                    places, own, totals = places[open_], bins[:, open_], (totals[0][open_], totals[1][open_])
                else:
                    own = bins
                if not len(open_):
                    continue
                low, high = int(places.min()), int(places.max()) + width
                places = places - low
                for k in range(inputs):
                    at = places + (k * BINS + own[k].astype(np.int32))
                    for kind in (0, 1):
                        sums[tree, kind, low:high] += np.bincount(at, totals[kind], high - low)
        for tree in range(count):
            both = sums[tree].reshape(2, first, width)
            some = np.flatnonzero(both[0].any(axis=1))
            if len(some):
                blobs = [both[:, k].tobytes() for k in some]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), tree, np.int32)), pa.array((some + first).astype(np.int32)), pa.array(blobs, pa.binary())], ["tree", "node", "sums"])

    return rows.mapInArrow(run, "tree int, node int, sums binary")


def best_cuts(sums: DataFrame, inputs: int) -> DataFrame:
    """(tree, node, input, cut, gain, mean, left, right): the best cut of each node and the means on either side; input -1 where
    none lowers the squared error."""

    def run(table: pa.Table) -> pa.Table:
        nodes, places = np.unique(table["node"].to_numpy(), return_inverse=True)
        both = np.zeros((len(nodes), 2, inputs, BINS))
        for place, blob in zip(places, table["sums"]):
            both[place] += np.frombuffer(blob.as_buffer()).reshape(2, inputs, BINS)
        low = np.cumsum(both, axis=3)[..., :-1]
        whole = both[:, :, :1].sum(axis=3, keepdims=True)
        high = whole - low
        with np.errstate(divide="ignore", invalid="ignore"):
            squares = low[:, 1] ** 2 / low[:, 0] + high[:, 1] ** 2 / high[:, 0]
            gain = np.where((low[:, 0] > 0) & (high[:, 0] > 0), squares - whole[:, 1] ** 2 / whole[:, 0], -np.inf)
            sides = [np.where(side[:, 0] > 0, side[:, 1] / side[:, 0], 0.0) for side in (low, high)]
        flat = gain.reshape(len(nodes), -1)
        best, every = flat.argmax(axis=1), np.arange(len(nodes))
        gains = flat[every, best]
        with np.errstate(invalid="ignore"):
            kept = gains > TINY * squares.reshape(len(nodes), -1)[every, best]
        columns = [
            np.full(len(nodes), table["tree"][0].as_py(), np.int32), nodes.astype(np.int32),
            np.where(kept, best // (BINS - 1), -1).astype(np.int32), (best % (BINS - 1)).astype(np.int32), np.where(kept, gains, 0.0),
            (whole[:, 1] / whole[:, 0]).reshape(-1), *(side.reshape(len(nodes), -1)[every, best] for side in sides),
        ]
        return pa.table([pa.array(c) for c in columns], names=["tree", "node", "input", "cut", "gain", "mean", "left", "right"])

    return sums.groupBy("tree").applyInArrow(run, "tree int, node int, input int, cut int, gain double, mean double, left double, right double")


def errors(cells: DataFrame, trees: Trees, count: int, inputs: int, depth: int) -> DataFrame:
    """Squared errors of the forest's mean over cells with their number of rows, sum and squares of targets; a row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for codes, rows, targets, squares in in_steps(batches):
            bins = bins_of(codes, inputs)
            guess = np.zeros(len(codes))
            for tree in range(count):
                guess += trees.means[tree][trees.nodes(tree, bins, depth)]
            guess /= count
            total += float((squares - 2 * guess * targets + guess * guess * rows).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["error"])

    return cells.mapInArrow(run, "error double")


def fitted(rows: DataFrame, inputs: Sequence[str], target: str, key: str, held_out: str, trees: int, depth: int, seed: int) -> tuple[np.ndarray, float]:
    """Importance of each input and R squared on the rows held out. ``rows`` is a stored frame without nulls, ``key`` a hash of each
    row; what is staged is for a block of ``passing``."""
    spark, k = rows.sparkSession, len(inputs)
    train = rows.where(~F.col(held_out))
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("centre")).first()
    if not seen.n:
        raise ValueError("no rows to fit")
    drawn_rows = np.array([tuple(r) for r in train.orderBy(key, *inputs).select(*inputs).limit(CUT_ROWS).collect()], float).reshape(-1, k)
    cuts = [cuts_of(drawn_rows[:, j]) for j in range(k)]
    cell = sum((bin_of(F.col(name), cuts[j]) * F.lit(BINS**j) for j, name in enumerate(inputs)), F.lit(0)).cast("bigint").alias("cell")
    slim = rows.select(cell, (F.col(target) - F.lit(seen.centre)).alias("y"), F.col(key).alias("h"), held_out)
    cells = slim.where(held_out).groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("y"), F.sum(F.col("y") * F.col("y")).alias("squares"))
    cells = staged(cells, "forest-cells")
    slim = slim.where(~F.col(held_out)).select("cell", "y", "h").repartitionByRange("cell", "h").sortWithinPartitions("cell", "h", "y")
    slim = staged(slim, "forest-train").coalesce(3 * spark.sparkContext.defaultParallelism)  # each task returns the sums of all trees
    size = 1 << (depth + 1)
    made = Trees(np.full((trees, size), -1, np.int8), np.zeros((trees, size), np.int8), np.zeros((trees, size)))
    made.inputs[:, 1] = -2  # open
    weight = np.zeros((trees, k))
    for level in range(depth):
        if not (made.inputs == -2).any():
            break
        found = best_cuts(level_sums(slim, made, trees, k, level, seed), k).collect()  # a short row per tree and node
        made.inputs[made.inputs == -2] = -1
        for r in found:
            made.inputs[r.tree, r.node], made.means[r.tree, r.node] = r.input, r.mean
            if r.input >= 0:
                made.cuts[r.tree, r.node] = r.cut
                made.means[r.tree, 2 * r.node], made.means[r.tree, 2 * r.node + 1] = r.left, r.right
                made.inputs[r.tree, 2 * r.node : 2 * r.node + 2] = -2 if level + 1 < depth else -1
                weight[r.tree, r.input] += r.gain
    sums = weight.sum(axis=1, keepdims=True)
    importance = np.divide(weight, sums, out=np.zeros_like(weight), where=sums > 0).sum(axis=0)
    importance /= importance.sum() or 1.0
    error = sum(r.error for r in errors(cells, made, trees, k, depth).collect())  # a row per task
    spread = cells.agg(F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum("squares").alias("squares")).first()
    if not spread.n:
        return importance, math.nan
    whole = spread.squares - spread.y**2 / spread.n
    return importance, 1 - error / whole if whole > 0 else math.nan
