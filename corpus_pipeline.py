"""A training corpus in five stages, each an operator of ``strata.llm``.

quality rules -> one document of each near-duplicate component -> benchmark
decontamination -> sources mixed to target weights -> token files.  All stages
but the last return the columns of ``documents``; each is written as Parquet
and read again as the next one's input.  The mixture's decision is the order
of rows in the files it writes, and the token files follow that order.

Rows are told apart by id and text; rows that repeat both share their fate,
but for near duplicates, where one of them stays.  Columns of any name pass
through unchanged: no stage adds one beside them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.decontamination import find_items
from strata.llm.divergence import judge_documents
from strata.llm.ngram_groups import near_duplicates
from strata.llm.pfair import mix_sources
from strata.llm.token_files import read_token_spans, write_token_files
from strata.operators.staging import stage
from strata.session import scratch_path, ship_package

#: Rows of a decision that go to the tasks by broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _same_row(rows: str, decided: str) -> Column:
    text_hash = F.xxhash64(F.coalesce(F.col(f"{rows}.text").cast("string"), F.lit("")))
    same_id = F.col(f"{rows}.doc_id").cast("long").eqNullSafe(F.col(f"{decided}.doc_id"))
    return same_id & (text_hash == F.col(f"{decided}.text_hash"))


def _matching(docs: DataFrame, decided: DataFrame, how: str) -> DataFrame:
    """``docs`` that are (``left_semi``) or are not (``left_anti``) in ``decided(doc_id, text_hash)``."""
    rows = stage(decided.select("doc_id", "text_hash").distinct(), "decided")
    side = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows.hint("shuffle_hash")
    return docs.alias("d").join(side.alias("r"), _same_row("d", "r"), how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their divergence from their language reject go."""
    ship_package(spark)
    return _matching(docs, judge_documents(docs).where("not kept"), "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays (of the smallest text hash, if ids repeat)."""
    ship_package(spark)
    found = stage(near_duplicates(docs, percent=75, width=5), "near-duplicates")
    grouped = found.where("component is not null")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    stays = grouped.groupBy("component").agg(F.min(order).alias("stays")).select("component", "stays.doc_id", "stays.text_hash")
    same = F.col("g.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("g.text_hash") == F.col("s.text_hash"))
    goes = grouped.alias("g").join(stays.alias("s"), (F.col("g.component") == F.col("s.component")) & same, "left_anti")
    left = _matching(docs, goes, "left_anti")
    repeated = grouped.groupBy("doc_id", "text_hash").count().where("count > 1")
    twice = stage(repeated, "repeated")
    if twice.isEmpty():
        return left
    # one row of each id and text, whatever its other columns are called
    row = F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("row")
    kept = _matching(left, twice, "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.first(row).alias("row"))
    return _matching(left, twice, "left_anti").unionByName(kept.select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _matching(docs, find_items(docs, items), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture."""
    ship_package(spark)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # beside the mixture's own columns
    placed = mix_sources(docs.select("doc_id", "source", row), temperature=0.5)
    return placed.repartitionByRange("place").sortWithinPartitions("place").select("row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The files' documents, in the order in which ``docs`` is stored: ``doc_id, start, n_tokens, ids_crc32``."""
    ship_package(spark)
    path = scratch_path(spark, "pipeline-tokens")
    file = F.col("_metadata.file_name")
    number = F.regexp_extract(file, r"^part-(\d+)", 1).cast("long")  # its digits are padded to five only
    stored = docs.select("doc_id", "text", number.alias("part"), file.alias("file"), F.col("_metadata.row_index").alias("row"))
    write_token_files(stored, path, public_tokenizers.path("word_bpe_49k.json"), order=["part", "file", "row"])
    return read_token_spans(spark, path)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixture", mix),
    ("token files", token_files),
]

#: SQL cannot express the tokenizer of the last stage; a test holds all stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
