"""Word counts of the language model where a task hands over its words more than once, as it does on large tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from braidwork.llm import attention_lm


@pytest.mark.parametrize("most", [0, 3, 5, 400_000])
@pytest.mark.parametrize("rows", [0, 1, 6])
def test_counts_do_not_depend_on_when_words_are_handed_over(spark, most, rows):
    docs = spark.range(rows, numPartitions=2).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b a w"), F.col("id").cast("string")).alias("text"))
    want = Counter(w for i in range(rows) for w in ["a", "b", "a", f"w{i}", attention_lm.END_WORD])
    assert {r.word: r.c for r in attention_lm.word_counts(docs, most=most).collect()} == want
