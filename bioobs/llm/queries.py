"""The check queries of the text operators, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from bioobs.llm import collocations, source_mix, url_filter, warc
from bioobs.llm.byte_bpe import digest_documents
from bioobs.llm.common import read_table, stored, word_count
from bioobs.llm.html_extract import extract_pages
from bioobs.llm.jaccard_join import jaccard_components
from bioobs.llm.lm_scoring import score_documents
from bioobs.llm.quality_rules import judged
from bioobs.llm.fingerprints import fingerprint_documents
from bioobs.llm.secret_scan import scan_documents
from bioobs.llm.token_alignment import aligned_documents
from bioobs.llm.token_counts import TokenRollup
from bioobs.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return keep


@check("op1_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(read_table(spark, folder, "documents"))


@check("op2_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@check("op3_jaccard_join")
def near_duplicate_classes(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(read_table(spark, folder, "documents"))


@check("op4_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return scan_documents(read_table(spark, folder, "documents"))


@check("op5_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(read_table(spark, folder, "pages"))


@check("op6_document_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(read_table(spark, folder, "documents"))


@check("op7_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digest_documents(read_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@check("op8_source_mix", source_mix.ORACLE)
def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix_documents(read_table(spark, folder, "documents")).drop("whole_times")


@check("op9_url_filter", url_filter.ORACLE)
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_pages(spark, read_table(spark, folder, "pages"))


TOKEN_BATCHES = ["001-load", "002-recount", "003-remove"]

TOKEN_TOTALS = """
WITH counted AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]*[A-Za-z][^\\x20\\x09-\\x0D]*')) AS with_letters FROM documents
)
SELECT source, lang, 'words-1' AS tokenizer_version,
  count(*) - count(*) FILTER (gone) AS documents,
  coalesce(sum(with_letters) FILTER (NOT gone), 0)::BIGINT AS tokens
FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS gone FROM counted) GROUP BY source, lang
"""


@check("op10_token_counts", TOKEN_TOTALS)
def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Load all documents, recount the words that hold an ASCII letter, then take out documents of low
    quality. The second batch is committed again, which must change nothing."""
    docs = read_table(spark, folder, "documents")
    letters = F.lit(r"[^\x20\x09-\x0D]*[A-Za-z][^\x20\x09-\x0D]*")
    counted = stored(
        docs.select(
            "doc_id",
            "source",
            "lang",
            F.lit("words-1").alias("tokenizer_version"),
            word_count(F.col("text")).alias("words"),
            F.coalesce(F.regexp_count("text", letters), F.lit(0)).cast("long").alias("with_letters"),
        ),
        "counted",
    )
    keys = ["source", "lang", "tokenizer_version"]
    none = F.lit(0).cast("long")

    def changes(rows: DataFrame, kind: str, tokens: str, previous) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), *keys, F.col(tokens).alias("tokens"), previous.alias("previous"))

    low = read_table(spark, folder, "labels").where("quality = 0").select("doc_id").distinct()
    recount = changes(counted.where("words <> with_letters"), "revise", "with_letters", F.col("words"))
    rollup = TokenRollup(spark, shared_folder(spark, "token-totals"))
    rollup.commit(TOKEN_BATCHES[0], changes(counted, "insert", "words", none))
    rollup.commit(TOKEN_BATCHES[1], recount)
    rollup.commit(TOKEN_BATCHES[1], recount)
    rollup.commit(TOKEN_BATCHES[2], changes(counted.join(low, "doc_id", "left_semi"), "delete", "with_letters", none))
    return rollup.totals(TOKEN_BATCHES)


@check("op11_warc", warc.ORACLE)
def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(read_table(spark, folder, "pages"))


@check("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return aligned_documents(read_table(spark, folder, "documents"), *paths)


@check("op13_collocations", collocations.ORACLE)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read_table(spark, folder, "documents"))
