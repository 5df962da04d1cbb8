"""The queries of this folder under the names the driver uses, and their SQL for the comparison."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallycart.llm.bpe import tokens
from tallycart.llm.common import table
from tallycart.llm.html import main_text
from tallycart.llm.minhash import near_duplicates
from tallycart.llm.mixing import drawn_copies
from tallycart.llm.mixing import oracle as mixing_sql
from tallycart.llm.neighbours import nearest
from tallycart.llm.passages import removed_passages
from tallycart.llm.pii import pii_spans
from tallycart.llm.prefixes import oracle as prefixes_sql
from tallycart.llm.prefixes import prefix_trie
from tallycart.llm.repetition import repetition
from tallycart.llm.toxicity import toxic_scores
from tallycart.llm.vectordups import linked_vectors
from tallycart.llm.warc import archived
from tallycart.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_passages(table(spark, sf_dir, "documents"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(table(spark, sf_dir, "documents"), RANKS, PATTERN, with_ids=False)


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn_copies(table(spark, sf_dir, "documents"))


ORACLES["op6_mixing"] = mixing_sql()


@query
def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, b, octet_length(b) AS n, max(page_id) OVER (PARTITION BY b) AS last FROM p)
SELECT page_id, n::bigint AS payload_bytes, sha1(b) AS payload_digest,
       CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM d"""


@query
def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefixes"] = prefixes_sql()


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_vectordups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))
