"""Registered queries of the training-data operators; production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import ann, chat, decontam, html, langid, linededup, mixing, simhash, suffix, tokens
from vellum.llm.common import read

TOKENIZER = "word_bpe_49k.json"


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read(spark, sf_dir, "documents"))


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.expand(rows.unionByName(added)))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_linededup": op2_linededup,
    "op3_suffix": op3_suffix,
    "op4_decontam": op4_decontam,
    "op5_ann": op5_ann,
    "op6_chat": op6_chat,
    "op7_tokens": op7_tokens,
    "op8_html": op8_html,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
}
ORACLES: dict[str, str] = {"op4_decontam": decontam.ORACLE, "op6_chat": chat.ORACLE, "op8_html": html.ORACLE}
