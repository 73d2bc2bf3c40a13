"""Templates put together by columns are those of templates(), whatever the text."""

import random

from pyspark.sql import functions as F

from braidwork.operators import wikitext as X
from braidwork.plans import record_queries as D


def test_columns_and_steps(spark, monkeypatch):
    r = random.Random(5)
    marks = ["{{", "}}", "[[", "]]", "|", "=", " ", "a", "7", "\n", "{", "}", "é"]
    texts = [None, "", *("".join(r.choice(marks) for _ in range(r.randint(0, 30))) for _ in range(3000)), "{{a|b=c=d|7=x| =y|[[p|q=r]]|{{i|1}}}}"]
    assert X._columns(texts).to_pylist() == [X.templates(t) for t in texts]
    monkeypatch.setattr(X, "AT_ONCE", 64)
    assert [x for part in X._in_steps(iter([X.pa.array(texts)])) for x in part.to_pylist()] == [X.templates(t) for t in texts]


def test_through_spark(spark):
    texts = ["{{a|b|c=d}} {{e}}", "none", "{{f|{{g}}|[[h|i]]=j}}"] * 50
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", "text", X.templates_udf(F.col("text")).alias("ts")).collect()
    assert all([t.asDict(True) for t in r.ts] == X.templates(r.text) for r in rows) and len(rows) == 150


def test_families_are_dealt(spark, sf):
    assert "REPARTITION_BY_NUM" in D.q_template_families(spark, sf)._jdf.queryExecution().executedPlan().toString()
