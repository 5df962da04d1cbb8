"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is target share * wanted total / its size, size being characters plus one per document, so that
sources of empty texts count too. Every document draws its number of copies from a Poisson distribution with that mean, by
inverting the distribution at a hash of seed and document: any run, partitioning or retry draws alike. Rates above
``PART`` are split into parts that are drawn one by one, which adds up to the same distribution. Documents are exploded by
their copies and all rows are put in the order of another hash.

Null sources form one source; a null id takes its text's hash in place of the id. Repeated rows draw the same number.
Sources missing in given weights have weight 0; without weights, a source's share is its size to the power ``alpha``, over
the sum of these. Columns of the input pass through untouched; the added ones are kept apart in ``mixed``'s struct.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.session import staged

#: Largest mean of one draw, and the largest count that its table of probabilities holds: beyond it lie under 1e-30.
PART, TOP = 8, 60
#: Hex digits of a hash that make a number in [0, 1).
DIGITS = 13


@dataclass(frozen=True)
class Mix:
    weights: Mapping[str | None, float] | None = None
    alpha: float = 0.7
    epochs: float = 1.0
    seed: int = 20


def rates(docs: DataFrame, source_col: str, text_col: str, mix: Mix) -> DataFrame:
    """Per source: its rate, the number of parts, and the cumulated probabilities of one part."""
    size = F.coalesce(F.char_length(text_col), F.lit(0)).cast("long") + 1
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size"))
    if mix.weights is None:
        wanted = F.pow(F.col("size").cast("double"), F.lit(mix.alpha))
    else:
        wanted = F.lit(0.0)
        for source, weight in mix.weights.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(weight))).otherwise(wanted)
    sizes = sizes.withColumn("wanted", wanted)
    total = sizes.agg(F.sum("wanted").alias("all_wanted"), F.sum("size").alias("all_size"))
    share = F.when(F.col("all_wanted") > 0, F.col("wanted") / F.col("all_wanted")).otherwise(F.lit(0.0))
    rate = (share * (F.col("all_size") * F.lit(mix.epochs)) / F.col("size")).alias("rate")
    rated = sizes.crossJoin(F.broadcast(total)).select("source", rate)  # one row of totals
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    rated = rated.withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    first = F.exp(-F.col("mean"))

    def longer(acc: Column, k: Column) -> Column:
        p = acc["p"] * acc["mean"] / k
        return F.struct(p.alias("p"), acc["mean"].alias("mean"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + p)).alias("sums"))

    start = F.struct(first.alias("p"), F.col("mean").alias("mean"), F.array(first).alias("sums"))
    return rated.select("source", "rate", "parts", F.aggregate(F.sequence(F.lit(1), F.lit(TOP)), start, longer, lambda a: a["sums"]).alias("sums"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts."""
    code = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(code, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", mix: Mix | None = None, payload: list[str] | None = None) -> DataFrame:
    """The struct ``row`` of the wanted columns (all by default) once per copy, with key, copy, n_copies, rate and the
    hash ``place`` that the result is sorted by."""
    mix = mix or Mix()
    table = staged(rates(docs, source_col, text_col, mix), "rates")  # of known size: Spark broadcasts it if small
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    rows = docs.select(F.struct(*[docs[c] for c in payload or docs.columns]).alias("row"), F.col(source_col).alias("of"), key.alias("key"))
    rows = rows.join(table, F.col("of").eqNullSafe(F.col("source")))
    seed = F.lit(str(mix.seed))

    def draw(part: Column) -> Column:
        u = uniform(seed, F.col("key"), part.cast("string"))
        return F.size(F.filter(F.col("sums"), lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(0), F.col("parts") - 1), F.lit(0), lambda acc, part: acc + draw(part))
    rows = rows.select("row", "key", "rate", copies.alias("n_copies")).where("n_copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    return rows.withColumn("place", F.md5(F.concat_ws("|", seed, F.lit("place"), "key", F.col("copy").cast("string")))).orderBy("place", "key", "copy")


def mixed_documents(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The documents, each as often as drawn, in mixed order."""
    return mixed(docs, mix=mix).select("row.*")


def drawn_copies(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """Every copy by id and source, without the texts."""
    out = mixed(docs, mix=mix, payload=["doc_id", "source"])
    return out.select("row.doc_id", "row.source", "copy", "n_copies", F.round("rate", 9).alias("rate"), "place")


def sql(table: str, mix: Mix, columns: str) -> str:
    """The same draw for DuckDB, by recursion over the counts, for the default weights."""
    u = f"('0x' || substr(md5(concat_ws('|', '{mix.seed}', doc_key, part::varchar)), 1, {DIGITS}))::bigint::double / {float(16**DIGITS)!r}"
    return f"""
WITH RECURSIVE docs AS (SELECT *, coalesce(doc_id::varchar, 'text:' || md5(coalesce(text, ''))) AS doc_key FROM {table}),
sizes AS (SELECT source, sum(coalesce(length(text), 0) + 1)::double AS size FROM docs GROUP BY source),
wanted AS (SELECT source, size, pow(size, {mix.alpha}) AS w FROM sizes),
rates AS (SELECT source, w / (SELECT sum(w) FROM wanted) * ((SELECT sum(size) FROM wanted) * {mix.epochs}) / size AS rate FROM wanted),
means AS (SELECT source, rate, greatest(1, ceil(rate / {PART}))::int AS parts, rate / greatest(1, ceil(rate / {PART})) AS mean FROM rates),
steps(source, mean, k, p, c) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM means
  UNION ALL SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM steps WHERE k < {TOP}),
tables AS (SELECT source, list(c ORDER BY k) AS sums FROM steps GROUP BY source),
drawn AS (
  SELECT d.*, m.rate, list_sum(list_transform(range(m.parts), lambda part: len(list_filter(t.sums, lambda c: c <= {u}))))::int AS n_copies
  FROM docs d JOIN means m ON d.source IS NOT DISTINCT FROM m.source JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT *, unnest(range(1, n_copies + 1))::int AS copy FROM drawn WHERE n_copies > 0)
SELECT {columns} FROM copies"""


def oracle(table: str = "documents", mix: Mix | None = None) -> str:
    mix = mix or Mix()
    place = f"md5(concat_ws('|', '{mix.seed}', 'place', doc_key, copy::varchar))"
    return sql(table, mix, f"doc_id, source, copy, n_copies, round(rate, 9) AS rate, {place} AS place")
