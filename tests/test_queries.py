"""The analytical queries on small graphs, and every driver query against its SQL."""

import math
from pathlib import Path

import pytest

from braidwork.plans import analysis as A
from braidwork.plans.driver_queries import ORACLES, QUERIES

LINKS = "src string, dst string, witnesses array<smallint>, wp_count int"


def graph(spark):
    many = list(range(1, 13))
    return spark.createDataFrame([("Q1", "Q2", many, 12), ("Q2", "Q3", many, 12), ("Q3", "Q1", many[:11], 11), ("Q4", "Q5", [1], 1)], LINKS)


def statements(spark):
    return spark.createDataFrame([("Q1", "Q2", "P31"), ("Q3", "Q2", "P50"), ("Q4", "Q5", "P2"), ("Q4", "Q5", "P1")], "src string, dst string, prop string")


def test_wp_not_wd(spark):
    out = A.wp_not_wd(graph(spark), statements(spark))
    assert [(r.src, r.dst) for r in out.collect()] == [("Q3", "Q1")]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_overlap_and_recall(spark):
    languages = spark.createDataFrame([(1, "en"), (12, "zz")], "id smallint, code string")
    assert [(r.src, r.dst) for r in A.witnesses_overlap(graph(spark), languages, ["zz"]).collect()] == [("Q1", "Q2"), ("Q2", "Q3")]
    assert A.witnesses_overlap(graph(spark), languages, ["none"]).count() == 0
    assert tuple(A.language_recall(graph(spark), 12, 11).first()) == (12, 11, 2, 1)
    assert tuple(A.language_recall(graph(spark).limit(0), 12, 11).first()) == (12, 11, 0, 0)


def test_promotable(spark):
    guesses = spark.createDataFrame([("Q4", "Q5", [1], 5), ("Q8", "Q9", [1], 6), ("Q1", "Q2", [1], 4)], "src string, dst string, witnesses array<smallint>, n int")
    rows = [tuple(r) for r in A.promotable_best_guesses(guesses, graph(spark), statements(spark)).collect()]
    assert rows == [("Q8", "Q9", 6, None, None), ("Q4", "Q5", 5, 1, ["P1", "P2"])]


def test_coverage_and_hubs(spark):
    methods = spark.createDataFrame([(1, "Q1", "Q2", 2), (1, "Q1", "Q2", 3), (2, "Q1", "Q2", 1), (9, "Q4", "Q5", 3)], "lang_id smallint, src string, dst string, method smallint")
    assert [tuple(r) for r in A.coverage_violations(methods, graph(spark)).collect()] == [("Q1", "Q2", 12, 1, 0.083)]
    lost = spark.createDataFrame([(1, "T"), (2, "T")], "lang_id smallint, title string")
    failed = spark.createDataFrame([(1, "Q1", "T"), (1, "Q2", "T"), (3, "Q1", "T")], "lang_id smallint, src string, target string")
    languages = spark.createDataFrame([(1, "en"), (2, "de"), (3, "fr")], "id smallint, code string")
    assert [tuple(r) for r in A.unconnected_hubs(lost, failed, languages).collect()] == [("en", "T", 2)]


def test_neighbours(spark):
    assert sorted(r.qid for r in A.neighbours(graph(spark), statements(spark), "Q3").collect()) == ["Q1", "Q2", "Q3"]
    assert A.neighbours(graph(spark), statements(spark), "Q77").count() == 0


def cells(rows, names):
    plain = lambda v: "null" if v is None or isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(plain(r[n]) for n in names) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    wanted = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    out = QUERIES[name](spark, sf)
    assert sorted(out.columns) == sorted(names)
    assert cells([r.asDict() for r in out.collect()], sorted(names)) == cells(wanted, sorted(names))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["src", "dst", "witnesses", "wp_count"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
