"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from gaugemill.llm import backoff_lm, conversation_repair
from gaugemill.llm.decontaminate import contamination
from gaugemill.llm.license_scan import scan_licenses
from gaugemill.llm.packing import pack_apart
from gaugemill.llm.pii import replace_pii
from gaugemill.llm.probminhash import near_duplicates
from gaugemill.llm.quality_classifier import score_documents, train
from gaugemill.llm.quality_rules import judge_quality
from gaugemill.llm.secret_scan import digests, scan_secrets
from gaugemill.llm.token_alignment import align_documents
from gaugemill.llm.token_files import read_token_files, write_token_files
from gaugemill.llm.url_filter import RULES, filter_urls, rule_table
from gaugemill.sources.folders import new_staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def folders(spark: SparkSession, name: str) -> Callable[[], str]:
    """A function that names a new folder in shared storage at each call."""
    root, numbers = new_staging_path(spark, name), count()
    return lambda: f"{root}/{next(numbers)}"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rule_table(spark, RULES)
    return filter_urls(table(spark, sf_dir, "pages"), rules, folders(spark, "urls")())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), folders(spark, "votes")())


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = new_staging_path(spark, "tokens")
    write_token_files(
        table(spark, sf_dir, "documents"),
        f"{path}/files",
        tokenizer,
        Tokenizer.from_file(tokenizer).get_vocab_size(),
        staging=f"{path}/ids",
    )
    return read_token_files(spark, f"{path}/files").select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return backoff_lm.score_documents(docs, folders(spark, "lm"), backoff_lm.ORDER)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _, scorer = train(docs, folders(spark, "votes")())
    return score_documents(docs, scorer)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan_secrets(table(spark, sf_dir, "documents")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced, _ = replace_pii(table(spark, sf_dir, "documents"), folders(spark, "pii"))
    return replaced.select("doc_id", "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_apart(table(spark, sf_dir, "documents"), folders(spark, "sizes"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), folders(spark, "dedup"))
    return found.drop("row_key", "class_key")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    repaired = conversation_repair.repair_conversations(rows, folders(spark, "turns"))
    return conversation_repair.digests(repaired)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        folders(spark, "links"),
    )


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_lm_scores": op5_lm_scores,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secret_scan": op7_secret_scan,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_near_dedup": op10_near_dedup,
    "op11_license_scan": op11_license_scan,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}
