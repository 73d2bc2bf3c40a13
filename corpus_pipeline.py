"""A corpus pipeline over `documents`: STAGES in order, each written as Parquet and read again as the next one's input.

Rules reject documents; of each class of near duplicates one stays; words of passages that occurred earlier go; benchmark passages go;
what is left is encoded. All stages but the last return the columns of documents. Stages keep clean documents byte for byte; n_chars
follows the text where a stage changes it.

Nulls, empty tables and repeated rows are handled as each operator's module says. No SQL covers the near-duplicate stage, so ORACLE_SQL is None
and the tests hold run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.llm import byte_bpe, decontaminate, near_dup, quality_rules, substring_dedup
from braidwork.llm.common import table, written

#: Words that the last stage remembers: half of the operator's own number, since the driver holds the plans of all stages. It bears on speed alone.
REMEMBERED = 1 << 18


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars of the text as it now is."""
    if "n_chars" not in columns:
        return docs.select(columns)
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))).select(columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(substring_dedup.kept(docs), docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of docs but for text, n_chars and those it makes: n_tokens, ids, and digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    out, codec = byte_bpe.encoded(docs, byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), most=REMEMBERED)
    ids, made = F.col("_ids"), {"text", "n_chars", "_ids", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}
    return out.select(
        *[c for c in docs.columns if c.lower() not in made],
        F.size(ids).cast("long").alias("n_tokens"),
        ids.alias("ids"),
        F.sha2(codec.packed(ids), 256).alias("ids_sha256"),
        F.sha2(codec.decoded(ids), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("substring deduplication", substrings),
    ("benchmark decontamination", benchmarks),
    ("byte-level BPE", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; only the last is not written."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
