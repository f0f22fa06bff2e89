"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import decontamination, divergence, merkle_manifest, ngram_groups, oracles, pfair, prefix_trie, resampling, secret_forest, token_files, tool_calls, toxicity, url_digests, warc_dictionary
from strata.operators.staging import stage
from strata.session import scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]

#: (verdict, host/path) of the URL query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

#: What a leaf of the manifest is made of, in order.
MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

TOOL_SCHEMAS = {
    "reply": {
        "type": "object",
        "properties": {"opening": {"type": "string"}, "length": {"type": "integer", "minimum": 1, "maximum": 2000}},
        "required": ["opening", "length"],
        "additionalProperties": False,
    },
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 5}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
}


def _shipped(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_of_turns(_table(spark, sf_dir, "conversations"))
    linked = tool_calls.link_tool_calls(calls, results, TOOL_SCHEMAS)
    return linked.withColumn("errors", F.array_join("errors", "; "))


def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc_dictionary.write_archives(_table(spark, sf_dir, "pages"), path, min_payload=0)
    records = warc_dictionary.read_archives(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge_documents(_table(spark, sf_dir, "documents")).drop("text_hash", "class_distance", "word_distance")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, vocabulary, end_id=1)
    return token_files.read_token_spans(spark, path)


def op6_ngram_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_groups.near_duplicates(_table(spark, sf_dir, "documents"), percent=75, width=5)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: every URL with a path whose page repeats the body of a page with a smaller id."""
    pages = _table(spark, sf_dir, "pages")
    url = F.col("url")
    bodies = pages.where("html is not null").select("page_id", "url", F.sha1("html").alias("body"))
    first = bodies.groupBy("body").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    copies = bodies.join(first, "body").where("page_id > first_id")
    named = copies.select(url_digests.host_of(url).alias("host"), url_digests.path_of(url).alias("path"))
    entries = named.where("host <> '' and length(path) > 1").select(F.concat("host", "path").alias("entry"))
    return url_digests.judge_urls(pages, URL_RULES, entries)


def op8_pfair_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix_sources(docs, temperature=0.5)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.7)


def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings are labelled by review rules; the forest judges all candidates, also those they leave open."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    candidates = stage(secret_forest.review_by_rule(secret_forest.describe_candidates(docs)), "described")
    findings = candidates.where("label is not null")
    judged = secret_forest.remove_false_findings(candidates, findings)
    columns = ["doc_id", "place", "run", "length", "changes", "entropy", "dictionary_share", "label", "score", "is_secret"]
    return judged.select(*columns, F.sha2("candidate", 256).alias("digest"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=5, min_words=20, seed="42")
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the documents whose id's crc32 five divides, the version with A-Z of the text in lower case is held against the root."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle_manifest.audit(docs, MANIFEST_COLUMNS, {"text": lowered}, tampered).drop("copied")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoded = prefix_trie.encode_documents(_table(spark, sf_dir, "documents"), vocabulary)
    decoded = prefix_trie.decode_documents(encoded, vocabulary)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Query]:
    found = [
        op1_tool_calls,
        op2_warc_dictionary,
        op3_decontamination,
        op4_divergence,
        op5_token_files,
        op6_ngram_groups,
        op7_url_digests,
        op8_pfair_mixture,
        op9_toxicity,
        op10_secret_forest,
        op11_resampling,
        op12_merkle_manifest,
        op13_prefix_trie,
    ]
    return {q.__name__: _shipped(q) for q in found}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
