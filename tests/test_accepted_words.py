"""Word links counted at once are those counted kind by kind."""

from pyspark.sql import functions as F

from braidwork.operators import graph as G


def test_at_once_as_by_kinds(spark):
    near = ["a" * n for n in (178, 180, 182, 184, 186, 188, 190, 192, 194, 384)]
    words = ["a", " a", "a\t", "é ", "é", "", " ", "a:b", 'a"b', "a\tb", "\t", None, *near, near[4] + "\t"]
    rows = [(t, u) for t in words for u in words for _ in range(1 + 10 * (t == "a") + (u == near[5]) * 99)]
    links = spark.createDataFrame(rows, "title string, target string")
    wanted = G.routed_word_links(links).where("route = 'accept'")
    tuples = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert tuples(G.word_links(links)) == tuples(wanted.groupBy("src", "dst").agg(F.sum("n").cast("int").alias("n")))
    assert tuples(G.word_entries(G.accepted_words(links))) == tuples(wanted.select(F.explode(F.array("src", "dst"))).distinct())


def test_entries_need_no_count_of_pairs(spark):
    links = spark.createDataFrame([("a", "b")], "title string, target string")
    plan = G.word_entries(G.accepted_words(links))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # pairs near the limit, and the words
