"""The operators over whole tables, with the columns asked of each query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import byte_bpe
from .class_lm import class_scores
from .decontaminate import contaminated_spans
from .fourier_quality import kernel_scores
from .heap_kmeans import heap_kmeans
from .licenses import scan_licenses
from .line_dedup import line_components
from .near_dedup import near_duplicates
from .packing import pack
from .quality_rules import quality_verdicts
from .resampling import resample
from .sharding import shard
from .url_rules import host_path_rule, host_word_rule, judge_urls

SHARDS = 24
TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
#: The rules asked for; the last two are of our own.
URL_RULES = [
    host_path_rule("allow", "org", "/"),
    host_path_rule("block", "example.org", "/es/"),
    host_path_rule("block", "example.org", "/en/1"),
    host_path_rule("allow", "com", "/fr/"),
    host_path_rule("block", "com", "/de/"),
]
OWN_URL_RULES = [host_word_rule("block", "spam-farm"), host_word_rule("block", "ads-track")]


def _table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _id_remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark, folder):
    spans = contaminated_spans(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return spans.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_quality_rules(spark, folder):
    return quality_verdicts(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_near_duplicates(spark, folder):
    return near_duplicates(_table(spark, folder, "documents"))


def op4_shards(spark, folder):
    sharded = shard(_table(spark, folder, "documents"), SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_packing(spark, folder):
    pieces = pack(_table(spark, folder, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_licenses(spark, folder):
    found = scan_licenses(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op7_class_scores(spark, folder):
    return class_scores(_table(spark, folder, "documents"), _id_remainder("doc_id") == 1)


def op8_line_components(spark, folder):
    return line_components(_table(spark, folder, "documents"))


def op9_kernel_quality(spark, folder):
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return kernel_scores(documents, labels, _id_remainder("doc_id") == 0)


def op10_url_rules(spark, folder):
    judged = judge_urls(_table(spark, folder, "pages"), URL_RULES + OWN_URL_RULES)
    asked = F.col("rule").isin([rule.name for rule in URL_RULES])
    return judged.withColumn("rule", F.when(asked, F.col("rule")))


def op11_resampling(spark, folder):
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_byte_bpe(spark, folder):
    import public_tokenizers

    documents, ranks = _table(spark, folder, "documents"), tokenizer_path(BYTE_RANKS)
    coded = byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_heap_kmeans(spark, folder):
    return heap_kmeans(_table(spark, folder, "embeddings"))


def queries() -> dict:
    found = [
        op1_decontamination,
        op2_quality_rules,
        op3_near_duplicates,
        op4_shards,
        op5_packing,
        op6_licenses,
        op7_class_scores,
        op8_line_components,
        op9_kernel_quality,
        op10_url_rules,
        op11_resampling,
        op12_byte_bpe,
        op13_heap_kmeans,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLE_SQL

    return dict(ORACLE_SQL)
