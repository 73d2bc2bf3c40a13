"""Resolution cascade, aggregation, entity and lexeme extraction, loaders, checks."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from braidwork.operators import entities as E
from braidwork.operators import graph as G
from braidwork.operators import resolve as R


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def redirects(spark, pairs, lang="en"):
    return spark.createDataFrame([(lang, a, b) for a, b in pairs], "lang string, title string, target string")


def followed(step, title, depth=5):
    """What the closure must say, walked title by title."""
    seen, at = [], title
    for d in range(depth):
        if at in seen:
            return "cycle", None, None
        if at not in step:
            return "resolved", at, d
        seen.append(at)
        at = step[at]
    return "depth_exceeded", None, None


def test_redirect_closure(spark):
    step = {"a1": "x", "b1": "b2", "b2": "x", "c1": "c2", "c2": "c3", "c3": "c4", "c4": "x", "d1": "d2", "d2": "d3", "d3": "d4", "d4": "d5", "d5": "x", "self": "self"}
    step |= {f"r4{i}": f"r4{(i + 1) % 4}" for i in range(4)} | {f"r6{i}": f"r6{(i + 1) % 6}" for i in range(6)}
    got = {r.title: (r.kind, r.final, r.depth) for r in R.redirect_closure(redirects(spark, step.items())).collect()}
    assert got == {t: followed(step, t) for t in step}
    assert got["c1"][0] == "resolved" and got["d1"][0] == "depth_exceeded" and got["self"][0] == "cycle" and got["r60"][0] == "depth_exceeded"


LABELS = [
    ("en", "Src", "Q1"), ("en", "Direct", "Q10"), ("en", "Direct", "Q9"), ("en", "Cap", "Q11"), ("en", "Final", "Q12"), ("en", "A b", "Q13"), ("de", "Berlin", "Q64"), ("doi", "10.1/x", "Q70"),
    ("mul", "Shared", "Q80"), ("mul", "Shared", "Q81"), ("mul", "Alone", "Q82"), ("best", "Guess", "Q90"),
]
HOPS = [("One", "Final"), ("Two", "One"), ("Loop", "Loop"), ("Lost", "Nowhere"), ("D1", "D2"), ("D2", "D3"), ("D3", "D4"), ("D4", "D5"), ("D5", "Final")]
WANTED = {
    "Direct": ("converted", "Q9", None), "cap": ("converted", "Q11", None), "One": ("converted", "Q12", None), "two": ("converted", "Q12", 1), "A_b": ("converted", "Q13", None), "A&nbsp;b": ("converted", "Q13", None),
    "File:X y.png": ("commons", "X y.png", None), ":File:X y.png": ("commons", "X y.png", None), "d:q42": ("converted", "Q42", 2), "D: Q7 ": ("converted", "Q7", 2), "de:berlin": ("converted", "Q64", 3), ":de:Berlin": ("failed", None, None),
    "doi:10.1/x": ("converted", "Q70", 3), "shared": ("mul_ambiguous", "Q80", None), "Alone": ("mul", "Q82", None), "guess": ("best", "Q90", None), "Wikt:x": ("wikt", None, None), "Loop": ("failed", None, None), "Lost": ("failed", None, None),
    "D1": ("failed", None, None), "Foo#Bar": ("failed", None, None), "L" * 400: ("failed", None, None),
}


def cascade(spark):
    links = spark.createDataFrame([("en", "Src", t) for t in WANTED] + [("en", "Src", "Direct"), ("en", "Nobody", "Direct"), ("en", "  ", "Direct")], "lang string, title string, target string")
    labels = spark.createDataFrame(LABELS, "lang string, label string, qid string")
    media = spark.createDataFrame([("X y.png",)], "filename string")
    return links, *R.resolve(links, labels, redirects(spark, HOPS), media)


def test_cascade(spark):
    links, rows, odd = cascade(spark)
    got = {r.target: (r.stream, r.dst, r.method) for r in rows.where("stream != 'src_not_found'").collect()}
    assert got == {t.strip(): w for t, w in WANTED.items()}
    assert rows_of(odd) == [("en", "D1", "depth_exceeded"), ("en", "Loop", "cycle")]
    assert rows.where("stream = 'src_not_found'").count() == 1
    assert G.lost_links(links.where("trim(title) != ''"), rows).count() == 0 and G.overlapping_streams(rows).count() == 0
    assert Counter({r.stream: r.n for r in R.stream_counts(rows).collect()}) == Counter([w[0] for w in WANTED.values()] + ["converted", "src_not_found"])
    assert R.stream_counts(rows).where("stream = 'failed'").first().too_long == 1


def test_streams(spark):
    _, rows, _ = cascade(spark)
    assert R.stream_rows(rows, "converted").where("dst = 'Q9'").count() == 1
    assert rows_of(R.stream_rows(rows, "src_not_found")) == [("en", "Nobody")]
    assert R.stream_rows(rows, "failed").where("length(target) > 384").count() == 0
    methods = R.witness_methods(rows)
    assert {r.method for r in methods.collect()} == {1, 2, 3}
    assert G.methods_without_link(methods, R.stream_rows(rows, "converted")).count() == 0
    quarantined = R.resolve_targets(spark.createDataFrame([("en", "mul:Alone")], "lang string, target string"), R.spaces(spark.createDataFrame(LABELS, "lang string, label string, qid string"), redirects(spark, HOPS), spark.createDataFrame([], "filename string"))[0], allow_pseudo_prefix=False)
    assert quarantined.first().stream == "failed"


def test_mul_statistics(spark):
    s = R.mul_statistics(spark.createDataFrame(LABELS, "lang string, label string, qid string")).first()
    assert (s.n, s.shared, s.pct) == (2, 1, 50.0)


def test_resource_links(spark):
    triples = spark.createDataFrame([("<r/Berlin>", "<p>", "<r/Berlin>"), ("<r/Berlin>", "<p>", "<r/No>")], "s string, p string, o string")
    assert rows_of(R.resource_links(triples, spark.createDataFrame(LABELS, "lang string, label string, qid string"), "de")) == [("Q64", "Q64", "<p>")]


def test_witnesses(spark):
    edges = spark.createDataFrame([(3, "Q1", "Q2"), (1, "Q1", "Q2"), (3, "Q1", "Q2"), (2, "Q2", "Q1")], "lang_id int, src string, dst string")
    links = G.witness_links(edges)
    assert rows_of(links) == [("Q1", "Q2", [1, 3], 2), ("Q2", "Q1", [2], 1)]
    assert G.repeated_keys(links, ["src", "dst"]).count() == 0 and G.bad_witnesses(links).count() == 0
    assert G.bad_witnesses(spark.createDataFrame([([2, 1], 2), ([], 0), ([1, 1], 2), ([1], 2), ([1, 2], 2)], "witnesses array<smallint>, wp_count int")).count() == 4


def test_combined_counts(spark):
    rows = spark.createDataFrame([("en", "a"), ("en", "a"), ("de", "a"), ("de", "b")], "lang string, target string")
    assert [tuple(r) for r in G.combined_counts(rows, ["target"]).collect()] == [("a", 2), ("b", 1)]


def test_loaders(spark):
    languages = spark.createDataFrame([(1, "en")], "id smallint, code string")
    rows = spark.createDataFrame([("en", "Q1", "t"), ("en", "Q1", "t"), ("en", "X1", "t"), ("en", "Q1", ""), ("en", None, "t"), ("en", "Q12345678901", "t"), ("xx", "Q1", "t")], "lang string, src string, target string")
    assert rows_of(G.loaded("obs_conv_failures", rows, languages)) == [("Q1", "t", 1)]
    assert {r.lang: (r.staged, r.inserted, r.rejected) for r in G.load_report("obs_conv_failures", rows).collect()} == {"en": (6, 1, 4), "xx": (1, 1, 0)}


def test_word_links(spark):
    rows = [("en", " a", "b "), ("en", "a", "b"), ("de", "a", "b"), ("en", "a:b", "c"), ("en", "", "c"), ("en", 'q"', "c"), ("en", "x" * 400, "c")]
    links = spark.createDataFrame(rows, "lang string, title string, target string")
    assert rows_of(G.word_links(links)) == [("a", "b", 3)]
    assert rows_of(G.word_links(links, distinct_per_language=True)) == [("a", "b", 2)]
    assert Counter(r.route for r in G.routed_word_links(links).collect()) == {"accept": 2, "reject": 3, "bad": 1}
    assert rows_of(G.word_entries(G.word_links(links))) == [("a",), ("b",)]


def snak(kind, value):
    return {"datatype": kind, "datavalue": {"value": value}} if value is not None else {"datatype": kind}


ENTITIES = [
    {
        "id": "Q1",
        "labels": {"de": {"value": "Eins"}, "mul": {"value": "One*"}},
        "sitelinks": {"enwiki": {"title": "One"}, "dewiki": {"title": "Eins"}, "enwikiquote": {"title": "no"}, "commonswiki": {"title": "c"}},
        "claims": {
            "P31": [{"mainsnak": snak("wikibase-item", {"id": "Q5"}), "qualifiers": {"P580": [snak("time", {"time": "+1952-00-00T00:00:00Z", "precision": 9})], "P642": [snak("wikibase-item", {"id": "Q7"})]}}, {"mainsnak": snak("wikibase-item", None)}],
            "P108": [{"mainsnak": snak("wikibase-item", {"id": "Q8"}), "qualifiers": {"P580": [snak("time", {"time": "-0044-03-15T00:00:00Z", "precision": 11})]}}],
            "P569": [{"mainsnak": snak("time", {"time": "+1900-01-01T00:00:00Z", "precision": 11})}, {"mainsnak": snak("time", {"time": "+" + "1" * 40, "precision": 11})}],
            "P356": [{"mainsnak": snak("external-id", None)}, {"mainsnak": snak("external-id", "10.1/x")}],
            "P625": [{"mainsnak": snak("globe-coordinate", {"latitude": 1.5, "longitude": 2, "altitude": None, "precision": 0.1, "globe": "http://x/entity/Q2"})}, {"mainsnak": snak("globe-coordinate", {"latitude": 1.5})}],
        },
    },
    {"id": "Q2", "labels": [], "sitelinks": [], "claims": []},
    {"id": "Q3", "labels": {"zz": {"value": "late"}, "aa": {"value": "early"}}},
    {"id": "Q4", "labels": {"mul": {"value": "only"}}},
]


def entities(spark):
    return E.entities(spark.createDataFrame([(json.dumps(e),) for e in ENTITIES] + [("broken",)], "value string"))


def test_entities(spark):
    e = entities(spark)
    assert rows_of(E.entity_rows(e)) == [("Q1", "One", 2), ("Q2", "Q2", 0), ("Q3", "early", 0), ("Q4", "only", 0)]
    assert rows_of(E.labels(e, ["en", "de", "mul", "doi", "best"])) == sorted(
        [("best", "One", "Q1"), ("best", "Q2", "Q2"), ("best", "early", "Q3"), ("best", "only", "Q4"), ("de", "Eins", "Q1"), ("doi", "10.1/x", "Q1"), ("en", "One", "Q1"), ("mul", "One*", "Q1"), ("mul", "only", "Q4")], key=str
    )
    assert rows_of(E.edges(e)) == [("Q1", "Q5", "P31"), ("Q1", "Q7", "P642"), ("Q1", "Q8", "P108")]
    assert rows_of(E.dates(e)) == sorted([("Q1", "P569", "+1900-01-01T00:00:00Z", 11, "", ""), ("Q1", "P580", "-0044-03-15T00:00:00Z", 11, "P108", "Q8")], key=str)
    assert rows_of(E.coordinates(e)) == [("Q1", 1.5, 2.0, None, 0.1, "Q2")]


def test_coordinates_keep_the_least(spark):
    rows = spark.createDataFrame([("Q1", 1.0, 2.0, None, 0.1, ""), ("Q1", 1.0, 2.0, 5.0, None, ""), ("Q1", 1.0, 2.0, 5.0, 0.5, "")], "qid string, latitude double, longitude double, altitude double, precision double, globe string")
    assert rows_of(E.distinct_coordinates(rows)) == [("Q1", 1.0, 2.0, 5.0, 0.5, "")]


def test_lexemes(spark):
    claim = lambda *ids: [{"mainsnak": snak("wikibase-entity", {"id": i})} for i in ids]
    lex = {
        "id": "L1", "lemmas": {"en": {"value": "run"}}, "claims": {"P5191": claim("L2", "L2", "Q1"), "P5137": claim("Q3", "L3"), "P31": claim("L9")},
        "forms": [{"representations": {"en": {"value": "runs"}, "de": {"value": "rennt"}}}], "senses": [{"id": "L1-S1", "claims": {"P9970": claim("Q4"), "P5973": claim("L7-S2", "L8")}}],
    }
    x = E.lexemes(spark.createDataFrame([(json.dumps(lex),), (json.dumps({"id": "L5", "lemmas": [], "claims": [], "forms": [], "senses": []}),)], "value string"))
    assert rows_of(E.lemmas(x)) == [("en", "run", "L1")]
    assert rows_of(E.forms(x)) == [("de", "rennt", "L1"), ("en", "runs", "L1")]
    assert rows_of(E.lexeme_lexeme(x)) == [("L1", "L2", "P5191")]
    assert rows_of(E.lexeme_item(x)) == [("L1", "Q3", "P5137")]
    assert rows_of(E.sense_item(x)) == [("L1", "L1-S1", "Q4", "P9970")]
    assert rows_of(E.sense_sense(x)) == [("L1", "L1-S1", "L7", "L7-S2", "P5973")]


def test_abstract_and_functions(spark):
    label = json.dumps({"Z2K3": {"Z12K1": ["Z11", {"Z11K1": "Z1002", "Z11K2": ' a\t"b" '}, {"Z11K1": "Z1430", "Z11K2": "  "}]}, "Z2K4": {"Z32K1": ["Z31", {"Z31K1": "Z1002", "Z31K2": ["Z6", "x", "y", "x"]}]}})
    pages = spark.createDataFrame([("Q1", 0, "Q2K1 Z3 Q2"), ("Q1x", 0, "Q9"), ("Q7", 1, "Q9"), ("Z5", 0, label), ("Z6", 0, "broken")], "title string, ns int, text string")
    assert rows_of(E.abstract_entries(pages)) == [("Q1",)]
    assert rows_of(E.abstract_refs(pages)) == [("Q1", "Q2"), ("Q1", "Z3")]
    assert rows_of(E.object_labels(pages)) == [("Z5", "Z1002", "A", "x"), ("Z5", "Z1002", "A", "y"), ("Z5", "Z1002", "L", "a  b")]
    assert rows_of(E.bad_objects(pages)) == [("Z6",)] and E.objects(pages).count() == 2


def test_first_per_key(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert rows_of(E.first_per_key(rows, ["k"], [F.col("v")])) == [("a", 1), ("b", 3)]


def test_counted_lines_are_measured_whole(spark):
    """A count, a space, the two sides and the tab between them: 384 bytes pass, 385 do not."""
    fits, long, counted = "a" * 380, "b" * 381, "c" * 380
    rows = [(fits, "x"), (long, "x")] + [(counted, "y")] * 10
    links = spark.createDataFrame(rows, "title string, target string")
    assert {(r.src[0], r.n): r.route for r in G.routed_word_links(links).collect()} == {("a", 1): "accept", ("b", 1): "reject", ("c", 10): "reject"}
    assert [(r.src[0], r.wkt_count) for r in G.word_links(links).collect()] == [("a", 1)]


def test_tables_in_place(spark, tmp_path):
    base = str(tmp_path / "db")
    G.create_tables(spark, base)
    one = spark.createDataFrame([("Q1", "x", 1)], "qid string, best_label string, wp_count int")
    G.replace_table(spark, base, "wd_entities", one)
    with pytest.raises(ValueError, match="key"):
        G.replace_table(spark, base, "wd_entities", one.union(one))
    assert G.read_table(spark, base, "wd_entities").count() == 1
    assert G.read_table(spark, base, "resolution_methods").count() == 3
