"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpulse.llm import alignment, bpe, fingerprints, html_cut, hyperminhash, language_id, packing, quality_rules, substring_dedup, surrogates, token_files, toxicity, turn_repair
from townpulse.llm.common import table, vocabulary
from townpulse.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary(WORD_BPE), end_id=1)
    return token_files.read_token_files(spark, folder)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_cut.extract(table(spark, sf_dir, "pages"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.place(packing.token_counts(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE)))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECES))


@query
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    found = language_id.predict(docs, language_id.fit(docs, held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
