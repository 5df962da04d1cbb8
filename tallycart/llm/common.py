"""What the text operators share: the tables, Arrow batches in bounded pieces, and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Characters of text that one numpy step holds; a longer document is a step of its own.
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(texts: list[str], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(column) -> list[str]:
    """A text column of an Arrow batch, null as empty."""
    return [x or "" for x in column.to_pylist()]


def beside(docs: DataFrame, text_col: str, schema: str, fresh: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """The rows as a struct column ``row`` beside new columns made from their texts; names can't clash. ``fresh`` gives a
    task its function from texts to one Arrow array per column of ``schema``."""
    paired = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    place = docs.columns.index(text_col)
    names = ["row", *(x.split()[0] for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fresh()
        for batch in batches:
            rows = batch.column("row")
            texts = texts_of(rows.flatten()[place])
            for a, b in pieces(texts):
                yield pa.RecordBatch.from_arrays([rows.slice(a, b - a), *made(texts[a:b])], names)

    return paired.mapInArrow(run, StructType([StructField("row", paired.schema["row"].dataType), *StructType.fromDDL(schema)]))
