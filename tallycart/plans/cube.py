"""Totals under any combination of slicers from stored cuboids, without reading a fact again.

The facts are reduced once to the base cuboid: one row per combination of all slicer attributes with additive measures, and
beside it the distinct customers as 64-bit words (the combination, customer_id / 64, a bit for each customer): a sparse cuboid
has a row for each of its customers, a dense one for 64 of them. The sizes of all cuboids come from one CUBE over it; further
ones are chosen greedily by the rows they save over all questions (each set of attributes once). A question is answered from the
smallest cuboid that holds its slicers and its grouping, sums and customers each from theirs. Cuboids of customers keep all
customer attributes: a customer has one value of each, so dropping them saves no row, and fewer cuboids are made.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.plans.measures import ATTRIBUTES, base_of, fact_keys, in_context
from tallycart.plans.rollups import refunds_per_order
from tallycart.session import lean, passing, scratch, staged
from tallycart.sources.warehouse import Warehouse

SLICERS = ("category", "region", "sales_channel", "segment", "loyalty_tier", "country", "month")
SUMS = ("revenue", "profit", "orders", "units", "discounts", "refunds")
SUM_TYPES = {"decimal(38,2)": ("revenue", "profit", "refunds"), "decimal(35,3)": ("discounts",), "bigint": ("orders", "units")}


def base_cuboid(wh: Warehouse, slicers: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Sums and customers per combination of slicers. Sales and the refunds of their orders meet the dimensions once, stacked; what is
    staged here, and the frames returned, are for a block of ``passing``."""
    keys = fact_keys(["customer_id", *slicers])
    amounts = {"revenue": F.col("sales_amount"), "profit": F.col("profit"), "orders": F.lit(1).cast("bigint"), "units": F.col("quantity"), "discounts": F.col("discount")}
    sold = wh.sales.select(*keys, *(value.alias(name) for name, value in amounts.items()))
    paid = staged(refunds_per_order(wh).join(wh.sales, "order_id").select(*keys, "refunds"), "paid")
    rows = in_context(wh, sold.unionByName(paid, allowMissingColumns=True), slicers)
    rows = staged(rows.select(*dict.fromkeys([*slicers, "customer_id"]), *SUMS), "rows-in-context")
    wide = {name: kind for kind, names in SUM_TYPES.items() for name in names}
    sums = rows.groupBy(*slicers).agg(*(F.sum(c).cast(wide[c]).alias(c) for c in SUMS))
    bit = F.expr("shiftleft(1L, cast(customer_id & 63 as int))")
    buyers = rows.groupBy(*slicers, F.expr("shiftright(customer_id, 6)").alias("word")).agg(F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")).alias("bits"))
    return sums, buyers


def subsets(names: Sequence[str]) -> list[frozenset[str]]:
    return [frozenset(s) for s in chain.from_iterable(combinations(names, k) for k in range(len(names) + 1))]


def chosen(sizes: Mapping[frozenset[str], int], whole: frozenset[str], count: int) -> list[frozenset[str]]:
    """The whole cuboid and ``count`` further ones, each the one that saves most rows over all questions by then; ties to
    fewer attributes, then by name."""
    out = [whole]
    cost = dict.fromkeys(sizes, sizes[whole])
    for _ in range(count):
        saved = {s: sum(max(0, cost[q] - sizes[s]) for q in sizes if q <= s) for s in sizes if s not in out}
        best = min(saved, key=lambda s: (-saved[s], len(s), sorted(s)), default=None)
        if best is None or not saved[best]:
            break
        out.append(best)
        cost = {q: min(c, sizes[best]) if q <= best else c for q, c in cost.items()}
    return out


_cubes: dict[tuple[str, str], Cube] = {}


def cube_of(wh: Warehouse) -> Cube:
    """The cube of a derived star, built once per application."""
    key = (wh.spark.sparkContext.applicationId, wh.source or "")
    if key not in _cubes or not wh.source:
        _cubes[key] = Cube(wh)
    return _cubes[key]


class Cube:
    """Stored cuboids of a warehouse and the questions they answer."""

    def __init__(self, wh: Warehouse, slicers: Sequence[str] = SLICERS, cuboids: int = 8, folder: str | None = None):
        if dict(wh.sales.dtypes)["customer_id"] != "bigint":
            raise ValueError("distinct customers need numeric ids")
        self.spark, self.slicers = wh.spark, tuple(slicers)
        self.folder = folder or scratch(wh.spark, "cube")
        needed = ("fact_sales", "fact_returns", *(ATTRIBUTES[a][1] for a in self.slicers if a in ATTRIBUTES))
        tables = {name: wh.table(name) for name in dict.fromkeys(needed)}  # before the block: a star's tables outlive it
        with lean(self.spark), passing(self.spark):
            self._build(Warehouse.of(wh.spark, tables), cuboids)

    def _build(self, wh: Warehouse, cuboids: int) -> None:
        sums, buyers = base_cuboid(wh, self.slicers)
        sums = staged(sums, "base-cuboid")
        whole = frozenset(self.slicers)
        places = {s: sum(1 << (len(self.slicers) - 1 - k) for k, a in enumerate(self.slicers) if a not in s) for s in subsets(self.slicers)}
        counted = sums.cube(*self.slicers).agg(F.grouping_id().alias("g")).groupBy("g").count()
        counts = {r.g: r["count"] for r in counted.collect()}  # a row per set of attributes
        self.sizes = {s: counts.get(g, 0) for s, g in places.items()}
        self.held = chosen(self.sizes, whole, cuboids)
        sets = [[F.col(a) for a in self.slicers if a in s] for s in self.held]
        self.places = {s: places[s] for s in self.held}
        columns = [F.col(a) for a in self.slicers]
        made = sums.groupingSets(sets, *columns).agg(F.grouping_id().alias("cuboid"), *(F.sum(c).alias(c) for c in SUMS))
        made.repartition("cuboid").write.partitionBy("cuboid").parquet(f"{self.folder}/sums")
        of_customer = {a for a in self.slicers if ATTRIBUTES.get(a, ("",))[0] == "customer_id"}
        self.buyers = {}
        for held in dict.fromkeys(s | of_customer for s in self.held):
            path = f"{self.folder}/buyers/cuboid={places[held]}"
            kept = [a for a in self.slicers if a in held]
            (buyers if held == whole else buyers.groupBy(*kept, "word").agg(F.bit_or("bits").alias("bits"))).write.parquet(path)
            if held == whole:  # comes first
                buyers = self.spark.read.schema(buyers.schema).parquet(path)
            self.buyers[held] = (self.spark.read.parquet(path).count(), path)

    def smallest(self, needed: Iterable[str]) -> frozenset[str]:
        """The smallest stored cuboid with these attributes."""
        wanted = frozenset(needed)
        if not wanted <= frozenset(self.slicers):
            raise ValueError(f"no slicer: {', '.join(sorted(wanted - frozenset(self.slicers)))}")
        return min((s for s in self.held if wanted <= s), key=lambda s: (self.sizes[s], sorted(s)))

    def answer(self, by: Sequence[str] = (), **slices: Sequence) -> DataFrame:
        """The base measures by any slicers, of the rows whose slicers have one of the given values."""
        wanted = {*by, *(a for a, values in slices.items() if values)}
        cuboid = self.places[self.smallest(wanted)]
        _, path = min(at for held, at in self.buyers.items() if wanted <= held)

        def kept(rows: DataFrame) -> DataFrame:
            for attribute, values in slices.items():
                rows = rows.where(F.col(attribute).isin(*values)) if values else rows
            return rows

        keys: list[str | Column] = list(by)
        sums = kept(self.spark.read.parquet(f"{self.folder}/sums").where(F.col("cuboid") == cuboid)).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in SUMS))
        whole = kept(self.spark.read.parquet(path)).groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
        buyers = whole.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias("customers"))
        return base_of(sums.join(buyers, list(by), "left") if by else sums.crossJoin(F.broadcast(buyers)), by)
