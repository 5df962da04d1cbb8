"""Streaming forms of the integrity steps and running figures.

The transformations take and give DataFrames and run on a stream as on a table. Event time is the order date as UTC
midnight. Every query keeps its state and progress below a checkpoint folder and resumes there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallycart.functions.numeric import dbl, ratio, rnd
from tallycart.operators.cleaning import clipped
from tallycart.operators.integrity import recompute_profit, stock_mismatches
from tallycart.session import staged

DAY = 86400


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("order_ts", F.timestamp_seconds(F.unix_date("order_date") * DAY))


def day_of(stamp: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(stamp) / DAY).cast("int"))


def read_files(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def clean_orders(sales: DataFrame, customers: DataFrame, products: DataFrame, delay: str = "30 days") -> DataFrame:
    """Known customer and product, positive quantity, discount in 0-1, first arrival of each order, profit
    recomputed. Rows are dropped before the deduplication so that its state holds only orders worth keeping; state
    older than the delay is forgotten."""
    kept = (
        with_event_time(sales)
        .withWatermark("order_ts", delay)
        .where(F.col("quantity") > 0)
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .join(products.select("product_id"), "product_id", "left_semi")
        .withColumn("discount", clipped("discount", 0, 1).cast("decimal(5,3)"))
        .dropDuplicatesWithinWatermark(["order_id"])
    )
    return recompute_profit(kept, products).drop("order_ts")


def stock_alerts(inventory: DataFrame) -> DataFrame:
    """Arriving inventory lines that do not reconcile; stateless."""
    return stock_mismatches(inventory)


def spend_per_customer(sales: DataFrame) -> DataFrame:
    """Running lifetime value; in update mode only the customers that a batch touched are emitted."""
    return sales.groupBy("customer_id").agg(
        F.sum("sales_amount").alias("lifetime_value"), F.count(F.lit(1)).alias("orders")
    )


def windowed_revenue(sales: DataFrame, length: str, slide: str | None = None, delay: str = "3 days") -> DataFrame:
    """Revenue per event-time window; rows later than the delay are left out, a window is final when the
    watermark has passed its end."""
    span = F.window("order_ts", length, slide) if slide else F.window("order_ts", length)
    return (
        with_event_time(sales)
        .withWatermark("order_ts", delay)
        .groupBy(span.alias("w"))
        .agg(F.sum("sales_amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .select(day_of(F.col("w.start")).alias("from_day"), "revenue", "orders")
    )


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """The number of state partitions is fixed when a stateful query starts for the first time, and AQE cannot change
    it later. By default one per core of the cluster."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_to(stream: DataFrame, folder: str, checkpoint: str, partitions: int | None = None) -> None:
    """Run over everything that has arrived and append final rows to Parquet; exactly once per input file."""
    writer = stream.writeStream.format("parquet").option("path", folder).outputMode("append")
    _run(stream, writer, checkpoint, partitions)


class Buckets:
    """A table of the newest row per key that batches update by copying what they touch.

    Keys fall into a fixed number of buckets. A batch writes the whole new content of the buckets it touches below its own
    folder and then adds a row to the list, which says for every bucket whose folder holds it; readers follow the newest row,
    so a batch is seen as a whole or not at all, and a reader opens each bucket once however many batches there were. A
    batch that is listed already changes nothing; one that died before is written anew. One store belongs to one checkpoint.
    """

    LISTED = "batch bigint, holders array<bigint>"

    def __init__(self, spark: SparkSession, folder: str, key: str, count: int = 16):
        self.spark, self.folder, self.key, self.count = spark, folder, key, count

    def newest(self) -> tuple[int, list[int]]:
        """The last batch and, by bucket, the batch that holds it (-1 for none)."""
        try:
            row = self.spark.read.schema(self.LISTED).json(f"{self.folder}/_list").orderBy(F.desc("batch")).first()
        except AnalysisException:  # nothing yet
            row = None
        return (row.batch, list(row.holders)) if row else (-1, [-1] * self.count)

    def _read(self, holders: dict[int, int]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.folder}/batch={holder}/bucket={bucket}" for bucket, holder in holders.items()))

    def upsert(self, rows: DataFrame, batch: int) -> None:
        last, holders = self.newest()
        if batch <= last:
            return
        placed = staged(rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")), "upserts")
        touched = [row.bucket for row in placed.select("bucket").distinct().collect()]  # ``count`` at most
        if not touched:
            return
        old = {bucket: holders[bucket] for bucket in touched if holders[bucket] >= 0}
        merged = placed
        if old:
            kept = self._read(old).join(placed.select(self.key), self.key, "left_anti")
            merged = placed.unionByName(kept.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")))
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/batch={batch}")
        now = [batch if bucket in touched else holder for bucket, holder in enumerate(holders)]
        self.spark.createDataFrame([(batch, now)], self.LISTED).coalesce(1).write.mode("append").json(f"{self.folder}/_list")

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._read({bucket: holder for bucket, holder in enumerate(self.newest()[1]) if holder >= 0})


def upsert_to(stream: DataFrame, folder: str, checkpoint: str, key: str, partitions: int | None = None, buckets: int = 16) -> None:
    """X3 sink: the newest row per key, kept by ``Buckets``; ``latest`` reads it."""
    store = Buckets(stream.sparkSession, folder, key, buckets)
    _run(stream, stream.writeStream.foreachBatch(store.upsert).outputMode("update"), checkpoint, partitions)


def judge_to(stream: DataFrame, folder: str, checkpoint: str, limit: float = 2.0, partitions: int | None = None) -> None:
    """X4 sink: every final day is judged once, by the days before it, when it becomes final. A batch stores its days with
    ``z`` and ``alert`` below ``days`` and the moments of all days so far below ``moments``; it reads those of the batch
    before it, so a repeated batch changes nothing."""

    def judge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        days = judged(rows, earlier_moments(spark, folder, batch), limit)
        days = staged(days, "judged")
        after = days.orderBy(F.desc("from_day")).limit(1).select(*MOMENTS)
        if not days.isEmpty():
            after.write.mode("overwrite").parquet(f"{folder}/moments/batch={batch}")
            days.drop(*MOMENTS).write.mode("overwrite").parquet(f"{folder}/days/batch={batch}")

    _run(stream, stream.writeStream.foreachBatch(judge).outputMode("append"), checkpoint, partitions)


MOMENTS = ("n", "mean", "m2")


def earlier_moments(spark: SparkSession, folder: str, batch: int) -> tuple[float, float, float]:
    """Number, mean and sum of squared deviations of the days that batches before this one judged."""
    try:
        stored = spark.read.parquet(f"{folder}/moments").where(F.col("batch") < batch).orderBy(F.desc("batch")).first()
    except AnalysisException:  # no batch yet
        stored = None
    return (float(stored.n), stored.mean, stored.m2) if stored else (0.0, 0.0, 0.0)


def judged(days: DataFrame, before: tuple[float, float, float], limit: float) -> DataFrame:
    """Days with their deviation from all earlier ones, in units of their population deviation (null for fewer than two
    or equal earlier days), and the moments that include the day itself. Days are few, so one window takes them."""
    n0, mean0, m20 = (F.lit(x) for x in before)
    value = dbl("revenue")

    def merged(frame: Window) -> tuple[Column, Column, Column]:
        n = F.count(value).over(frame).cast("double")
        mean = F.coalesce(F.avg(value).over(frame), F.lit(0.0))
        m2 = F.coalesce(F.var_pop(value).over(frame), F.lit(0.0)) * n
        total, gap = n0 + n, mean - mean0
        whole = F.coalesce(F.try_divide(n0 * mean0 + n * mean, total), F.lit(0.0))
        return total, whole, m20 + m2 + F.coalesce(F.try_divide(gap * gap * n0 * n, total), F.lit(0.0))

    order = Window.orderBy("from_day")
    n, mean, m2 = merged(order.rowsBetween(Window.unboundedPreceding, -1))
    after = merged(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = days.select(
        "from_day", value.alias("revenue"), "orders", n.alias("_n"), mean.alias("_mean"), m2.alias("_m2"),
        *(x.alias(name) for x, name in zip(after, MOMENTS, strict=True)),
    )
    z = F.when(F.col("_n") >= 2, ratio(F.col("revenue") - F.col("_mean"), F.sqrt(F.col("_m2") / F.col("_n"))))
    out = rows.withColumn("z", rnd(z, 3)).withColumn("alert", F.coalesce(F.abs(z) > limit, F.lit(False)))
    return out.drop("_n", "_mean", "_m2")


def _run(stream: DataFrame, writer: DataStreamWriter, checkpoint: str, partitions: int | None) -> None:
    with state_partitions(stream.sparkSession, partitions):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def latest(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return Buckets(spark, folder, key).read()


def in_rounds(feeds: list[DataFrame], folder: str, run: Callable[[], None]) -> None:
    """Deliver the feeds one after the other and run the query after each, as files that arrive over time."""
    for feed in feeds:
        feed.write.mode("append").parquet(folder)
        run()
