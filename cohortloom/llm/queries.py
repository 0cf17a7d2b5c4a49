"""The corpus operators as queries over the whole given tables, with SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm import oracles
from cohortloom.llm.common import digest_bin, written
from cohortloom.llm.decontaminate import find_leaks, leak_report
from cohortloom.llm.dialogue_repair import conversation_report, damage, repair_conversations
from cohortloom.llm.host_rules import judge_hosts
from cohortloom.llm.jaccard_join import link_documents
from cohortloom.llm.lexical_search import search_documents
from cohortloom.llm.license_rules import scan_licenses
from cohortloom.llm.mixture import systematic_copies, word_count
from cohortloom.llm.passages import remove_repeats
from cohortloom.llm.reshard import reshard, rewrite_shards
from cohortloom.llm.token_counts import count_tokens
from cohortloom.llm.token_store import read_index, write_store
from cohortloom.llm.url_templates import judge_urls
from cohortloom.llm.window_lm import score_documents
from cohortloom.session import fresh_path

OLD_SHARDS, NEW_SHARDS = 6, 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_reshard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents from six uneven shards, by source, into eight equal ones.

    The old shards are written with their texts, those that change are written again,
    and the rows are read from the files that the manifest names.
    """
    text = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    docs = table(spark, folder, "documents")
    stored = docs.withColumns({"_key": F.monotonically_increasing_id(),
                               "old_shard": digest_bin("source", OLD_SHARDS)})
    before, after = fresh_path(spark, "old-shards"), fresh_path(spark, "new-shards")
    stored.write.option("compression", "zstd").partitionBy("old_shard").parquet(before)
    old = spark.read.schema(stored.schema).parquet(before)
    placed = written(reshard(
        old.select("_key", "doc_id", size, crc, "old_shard"), size="size", old="old_shard",
        capacities=NEW_SHARDS, order=["doc_id", "text_crc32"], old_shards=OLD_SHARDS
    ).select("_key", "old_shard", "shard", "slot"), "placement")
    manifest = rewrite_shards(placed, before, after, old="old_shard", key="_key",
                              contents=old.drop("old_shard")).collect()
    # An untouched shard's files have no slots; they are taken from the placement.
    same = [m.shard for m in manifest if not m.rewritten]
    rows = old.where(F.col("old_shard").isin(same)).join(
        placed.select("_key", "shard", "slot"), "_key").select(*docs.columns, "shard", "slot")
    paths = [m.path for m in manifest if m.rewritten]
    if paths:
        schema = T.StructType([*docs.schema, *placed.select("slot", "shard").schema])
        new = spark.read.schema(schema).option("basePath", after).parquet(*paths)
        rows = new.select(*rows.columns).unionByName(rows) if same else new
    return rows.select(
        "doc_id", size, crc, F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        digest_bin("source", OLD_SHARDS).alias("old_shard"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Write the store of all documents, then read its files."""
    store = fresh_path(spark, "token-store")
    write_store(table(spark, folder, "documents"), store, vocabulary("byte_bpe_50k.json"))
    return read_index(spark, store)


def op3_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_hosts(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return link_documents(table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("text_hash")


def op6_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op7_window_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))


def op8_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    # Sizes are read four times; the texts, once.
    rows = written(table(spark, folder, "documents").select(
        "doc_id", "source", word_count("text").alias("size")), "mix-sizes")
    drawn = systematic_copies(rows, size="size")
    return drawn.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return leak_report(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """All pages; a label of a document counts for the page of the same number."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))
    return judge_urls(table(spark, folder, "pages"), labels).drop("bad_rate")


def op12_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    conversations = table(spark, folder, "conversations")
    return conversation_report(conversations, repair_conversations(damage(conversations)))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_reshard": op1_reshard, "op2_token_store": op2_token_store,
    "op3_host_rules": op3_host_rules,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_repeated_passages": op5_repeated_passages, "op6_license_rules": op6_license_rules,
    "op7_window_scores": op7_window_scores, "op8_systematic_mix": op8_systematic_mix, "op9_token_counts": op9_token_counts, "op10_benchmark_leaks": op10_benchmark_leaks,
    "op11_url_templates": op11_url_templates, "op12_dialogue_repair": op12_dialogue_repair,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES: dict[str, str] = {
    "op3_host_rules": oracles.HOST_RULES, "op4_jaccard_join": oracles.JACCARD_JOIN,
    "op8_systematic_mix": oracles.SYSTEMATIC_MIX, "op10_benchmark_leaks": oracles.BENCHMARK_LEAKS,
    "op11_url_templates": oracles.URL_TEMPLATES, "op12_dialogue_repair": oracles.DIALOGUE_REPAIR,
    "op13_ranked_search": oracles.LEXICAL_SEARCH,
}
