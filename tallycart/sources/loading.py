"""Loading a star schema into a folder of Parquet tables.

A load writes its new rows below ``<table>/load=<id>`` for all tables, with a key filter and the states of the views
beside them, and then adds one row to the folder's list. Readers follow that list only, so a load that dies half-way is
never seen: the whole load becomes visible at once, without renaming anything. ``compact`` writes one load in place of
several and takes their place by one row of the list, too.

Rules are counted in the pass that writes; keys are looked up in the loads that may hold them (``keyindex``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycart.operators.cleaning import first_per_key
from tallycart.operators.integrity import RuleViolation, row_rules
from tallycart.plans.refreshed import write_states
from tallycart.session import lean, passing, side_by_side, staged
from tallycart.sources.keyindex import Held, stored_keys, write_filter
from tallycart.sources.layout import curved
from tallycart.sources.schemas import FOREIGN, KEYS, star_schema
from tallycart.sources.warehouse import Warehouse

ORDER = ("dim_customers", "dim_products", "dim_stores", "dim_warehouses", "fact_sales", "fact_inventory", "fact_returns")
SLIM = tuple(t for t in ORDER if t != "fact_sales")  # side by side; the rows of sales are shuffled alone, so that files don't add up
LISTED = "id string, replaces array<string>, held array<struct<table:string, rows:bigint, low:string, high:string>>"


def listed_loads(spark: SparkSession, folder: str) -> dict[str, dict[str, Held]]:
    """The visible loads and what they hold of each table; one short row per load."""
    try:
        rows = spark.read.schema(LISTED).json(f"{folder}/_loads").collect()
    except AnalysisException:  # no load has finished yet
        return {}
    gone = {i for row in rows for i in row.replaces or ()}
    return {row.id: {h.table: Held(row.id, h.rows, h.low, h.high) for h in row.held} for row in sorted(rows) if row.id not in gone}


def finished_loads(spark: SparkSession, folder: str) -> list[str]:
    return list(listed_loads(spark, folder))


def read_loads(spark: SparkSession, folder: str, table: str, loads: list[str]) -> DataFrame | None:
    """The rows of some loads; None when there is none."""
    if not loads:
        return None
    base = f"{folder}/{table}"
    return spark.read.option("basePath", base).parquet(*[f"{base}/load={i}" for i in loads]).drop("load")


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    return read_loads(spark, folder, table, finished_loads(spark, folder))


def stored_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    loads = finished_loads(spark, folder)
    return Warehouse.of(spark, {t: read_loads(spark, folder, t, loads) for t in ORDER})


def typed(df: DataFrame, table: str) -> DataFrame:
    """The columns of the star table in their types. Keys may be numbers or text, as the extracts have them; anything
    else that can't be cast fails the load."""
    columns = []
    for field in star_schema(table).fields:
        if field.name not in df.columns:
            raise ValueError(f"{table} lacks the column {field.name}")
        given = df.schema[field.name].dataType
        if field.name.endswith("_id") and isinstance(given, (T.StringType, T.LongType)):
            columns.append(F.col(field.name))
        elif field.name.endswith("_id") and not isinstance(given, (T.IntegerType, T.ShortType)):
            raise ValueError(f"{table}.{field.name} is {given.simpleString()}; keys are bigint or string")
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def write_table(df: DataFrame, table: str, path: str) -> tuple[Held, dict[str, int]]:
    """Write rows in the table's layout; what was written and the violations of each row rule come out of the same pass."""
    if table == "fact_sales":
        df = curved(df)
    rules = row_rules(table)
    first = F.col(KEYS[table][0])
    seen = Observation()
    counts = [F.count(F.when(broken, F.lit(1))).alias(f"rule_{k}") for k, (_, broken) in enumerate(rules)]
    bounds = [F.min(first).cast("string").alias("low"), F.max(first).cast("string").alias("high")]
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *bounds, *counts).write
    (writer.partitionBy("order_month") if table == "fact_sales" else writer).parquet(path)
    got = seen.get
    return Held("", got["rows"], got["low"], got["high"]), {name: got[f"rule_{k}"] for k, (name, _) in enumerate(rules)}


def load_all(tables: Mapping[str, DataFrame], folder: str, strict: bool = True, most_loads: int = 32) -> str:
    """Add the rows whose keys are not stored yet and skip the rest; repeating a load changes nothing.

    With ``strict`` a violated rule raises before the load is listed, which leaves it invisible. Once there are
    ``most_loads`` loads they are compacted first.
    """
    spark = next(iter(tables.values())).sparkSession
    tables = {t: typed(tables[t], t) for t in ORDER}
    before = listed_loads(spark, folder)
    if len(before) >= most_loads:
        compact(spark, folder)
        before = listed_loads(spark, folder)
    load = uuid.uuid4().hex

    def add(table: str) -> tuple[Held, dict[str, int]]:
        key = KEYS[table]
        with passing(spark):
            fresh, low, high = one_per_key(tables[table], key)
            earlier = [h[table] for h in before.values() if h[table].meets(low, high)]
            if earlier:
                known = stored_keys(spark, fresh.select(*key), key, earlier, _filters(folder, table), _reader(spark, folder, table))
                fresh = fresh.join(known, key, "left_anti").select(*fresh.columns)
                fresh = staged(fresh, "fresh") if table == "fact_sales" else fresh  # its layout reads the rows several times
            held, counts = write_table(fresh, table, f"{folder}/{table}/load={load}")
        write_filter(_written(spark, folder, tables[table], table, load).select(*key), key, held.rows, _filters(folder, table)(load))
        return held, counts

    with lean(spark):
        added = side_by_side(spark, add, SLIM) | {"fact_sales": add("fact_sales")}
        fresh = {t: _written(spark, folder, tables[t], t, load) for t in ORDER}
        checks = {"orphans": lambda: orphans(spark, folder, fresh, before) if strict else [], "states": lambda: write_states(Warehouse.of(spark, fresh), f"{folder}/_states", load)}
        found = side_by_side(spark, lambda name: checks[name](), checks)["orphans"]
    if strict:
        broken = found + [(table, rule, n) for table, (_, counts) in added.items() for rule, n in counts.items() if n]
        if broken:
            raise RuleViolation("; ".join(f"{table}.{rule}: {n}" for table, rule, n in sorted(broken)))
    _list(spark, folder, load, [], {t: held for t, (held, _) in added.items()})
    return load


def one_per_key(df: DataFrame, key: list[str]) -> tuple[DataFrame, object, object]:
    """The rows with the first of several for a key, and the range of the first key column. Keys are counted alone, and rows
    are compared only where a key comes again."""
    counts = df.select(*key).groupBy(*key).count()
    seen = counts.agg(F.min(key[0]).alias("low"), F.max(key[0]).alias("high"), F.max("count").alias("most")).first()
    if (seen.most or 0) > 1:
        again = staged(counts.where("count > 1").select(*key), "repeated-keys")
        several = first_per_key(df.join(again, key, "left_semi").select(*df.columns), key)
        df = df.join(again, key, "left_anti").select(*df.columns).unionByName(several)
    return df, seen.low, seen.high


def orphans(spark: SparkSession, folder: str, fresh: Mapping[str, DataFrame], before: Mapping[str, Mapping[str, Held]]) -> list[tuple[str, str, int]]:
    """Violations of foreign keys among the fresh rows: the keys of all children of a parent in one pass, first against the
    parent's fresh rows, and what is left against the loads that may hold it."""
    children: dict[str, list[tuple[str, str]]] = {}
    for table, links in FOREIGN.items():
        for column, parent in links:
            children.setdefault(parent, []).append((table, column))

    def without(parent: str) -> list[tuple[str, str, int]]:
        with passing(spark):
            return missing(parent)

    def missing(parent: str) -> list[tuple[str, str, int]]:
        links, key = children[parent], KEYS[parent]
        asked = None
        for table, column in links:
            own = fresh[table].where(F.col(column).isNotNull()).select(F.col(column).alias(key[0]), F.lit(table).alias("child"), F.lit(column).alias("column"))
            asked = own if asked is None else asked.unionByName(own)
        asked = asked.groupBy(key[0], "child", "column").agg(F.count(F.lit(1)).alias("rows"))
        left = staged(asked.join(fresh[parent].select(*key), key, "left_anti"), "without-parent")
        if left.isEmpty():
            return []
        bounds = left.agg(F.min(key[0]).alias("low"), F.max(key[0]).alias("high")).first()
        earlier = [h[parent] for h in before.values() if h[parent].meets(bounds.low, bounds.high)]
        known = stored_keys(spark, left.select(*key).distinct(), key, earlier, _filters(folder, parent), _reader(spark, folder, parent))
        rest = left.join(known, key, "left_anti").groupBy("child", "column").agg(F.sum("rows").alias("rows")).collect()  # a row per foreign key
        return [(row.child, f"foreign_{row.column}_in_{parent}", row.rows) for row in rest]

    return [found for part in side_by_side(spark, without, children).values() for found in part]


def compact(spark: SparkSession, folder: str) -> str | None:
    """Write all visible loads as one, which takes their place by one row of the list. A compaction that dies changes nothing;
    loads that finish meanwhile stay beside it. Files of replaced loads may be deleted once no reader uses them."""
    before = listed_loads(spark, folder)
    if len(before) < 2:
        return None
    load, loads = uuid.uuid4().hex, list(before)

    def merge(table: str) -> Held:
        rows = read_loads(spark, folder, table, loads).drop("order_month")
        held, _ = write_table(rows, table, f"{folder}/{table}/load={load}")
        write_filter(_written(spark, folder, rows, table, load).select(*KEYS[table]), KEYS[table], held.rows, _filters(folder, table)(load))
        return held

    with lean(spark):
        held = side_by_side(spark, merge, SLIM) | {"fact_sales": merge("fact_sales")}
        write_states(Warehouse.of(spark, {t: read_loads(spark, folder, t, [load]) for t in ORDER}), f"{folder}/_states", load)
    _list(spark, folder, load, loads, held)
    return load


def _list(spark: SparkSession, folder: str, load: str, replaces: list[str], held: Mapping[str, Held]) -> None:
    row = (load, replaces, [(t, h.rows, h.low, h.high) for t, h in held.items()])
    spark.createDataFrame([row], LISTED).coalesce(1).write.mode("append").json(f"{folder}/_loads")


def _filters(folder: str, table: str):
    return lambda load: f"{folder}/_keys/{table}/load={load}"


def _reader(spark: SparkSession, folder: str, table: str):
    return lambda loads: read_loads(spark, folder, table, loads)


def _written(spark: SparkSession, folder: str, source: DataFrame, table: str, load: str) -> DataFrame:
    """The rows of an unfinished load; the schema is given because a load may have added no row at all."""
    schema = source.schema
    if table == "fact_sales":
        schema = T.StructType([*schema.fields, T.StructField("order_month", T.DateType())])
    return spark.read.schema(schema).parquet(f"{folder}/{table}/load={load}")


def write_report(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Report tables as Parquet, one folder each."""
    for name, frame in frames.items():
        frame.write.mode("errorifexists").parquet(f"{folder}/{name}")
