"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import best_fit_packing, bpe, chat_format, conversation_repair, decontaminate, exact_dedup, jaccard_join, license_scan, phrase_mining, pii, token_files, toxicity, url_filter
from strata.llm.oracles import ORACLE as ORACLE
from strata.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BYTE_TOKENIZER, BYTE_END_ID = "byte_bpe_50k.json", 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return str(public_tokenizers.path(TOKENIZER))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: ``source/lang/doc_id``."""
    return docs.withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return license_scan.scan_licenses(files, keep=["doc_id"])


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_digests(spark, docs, tokenizer_path(), scratch_path(spark, "token-files"), END_ID)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "coverage", F.size("tiles").alias("n_tiles"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def _equals(value: int) -> Callable[[Column], Column]:
    return lambda x: x == value


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    name = F.array(*[F.lit(k) for k in pii.KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(chat_format.format_windows(turns.unionByName(more)))


def severity_grade() -> Column:
    """The labels have no severity: 0 not toxic, 1 toxic, 2 toxic in a text of low quality."""
    return F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), severity_grade())
    return toxicity.severity(docs, model)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path(BYTE_TOKENIZER)), BYTE_END_ID)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a checksum of conversation and turn; nulls are one space."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(known[0], F.lit(":"), known[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumns({"role": F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")),
                             "text": F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))})
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.conversation_report(damaged(turns), turns)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pii": op7_pii,
    "op8_bpe": op8_bpe,
    "op9_chat_format": op9_chat_format,
    "op10_toxicity": op10_toxicity,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_phrase_mining": op13_phrase_mining,
}
