"""The queries of this subpackage over the standard tables, each on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sonoweave.llm import lookalikes, packing, sentences, spans, tokens, truncation
from sonoweave.session import table

#: Least length of a shared passage, in code points.
SPAN = 100


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.same_look_pairs(table(spark, d, "segments"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.same_look_groups(table(spark, d, "segments"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_positions(table(spark, d, "segments"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "segments"))


def p4_by_source(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_by_source(table(spark, d, "segments"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "container_sizes"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_fill(p7_containers(spark, d), table(spark, d, "container_sizes"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_stretches(table(spark, d, "documents"), SPAN)


def p8_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_amounts(table(spark, d, "documents"), SPAN)


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    return spans.fuzzy_passages(table(spark, d, "documents"), SPAN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_groups, p3_found, p4_found, p4_by_source, p6_ids, p7_containers, p7_fill, p8_found, p8_shared, p8_passages)
}
