"""Column helpers, the template parser and link extraction."""

import pytest
from pyspark.sql import functions as F

from braidwork.functions import text as T
from braidwork.operators import wikitext as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("given, wanted", [("Foo", "Foo"), ("  Foo  ", "Foo"), ("File:bar.png", None), ("category:X", None), (":Foo", ":Foo"), ("", None), ("   x　", "x")])
def test_link_target(spark, given, wanted):
    assert one(spark, T.link_target(F.col("v")), v=given) == wanted


@pytest.mark.parametrize("given", ["See also", "See_also", "  See   _also  "])
def test_template_name(spark, given):
    assert one(spark, T.template_name(F.col("v")), v=given) == "see also"


@pytest.mark.parametrize("given, wanted", [("straße", "Straße"), ("ßx", "SSx"), ("ǆo", "Ǆo"), ("", ""), ("éa", "Éa"), ("𐐨b", "𐐀b")])
def test_capfirst(spark, given, wanted):
    assert one(spark, T.capfirst(F.col("v")), v=given) == wanted


@pytest.mark.parametrize("given, wanted", [("a\tb\nc\rd\be", "a b c d e"), ("x" * 384, "x" * 384), ("x" * 385, None)])
def test_diagnostic(spark, given, wanted):
    assert one(spark, T.diagnostic(F.col("v")), v=given) == wanted


@pytest.mark.parametrize("given, wanted", [("<http://x/resource/A%C3%A9_b>", "Aé b"), ("<http://x/resource/A+B>", "A+B"), ("<http://x/%FF>", None)])
def test_resource_title(spark, given, wanted):
    assert one(spark, T.resource_title(F.col("v")), v=given) == wanted


@pytest.mark.parametrize("given, wanted", [("q42", True), (" Q42 ", True), ("Q", False), ("Q4a", False), ("P4", False)])
def test_is_qid(spark, given, wanted):
    assert one(spark, T.is_qid(F.col("v")), v=given) is wanted


@pytest.mark.parametrize("given, wanted", [("enwiki", True), ("enwikiquote", False), ("commonswiki", False), ("wikidatawiki", False), ("simplewiki", True), ("enwiktionary", False)])
def test_is_encyclopedia(spark, given, wanted):
    assert one(spark, T.is_encyclopedia(F.col("v")), v=given) is wanted


@pytest.mark.parametrize("given, wanted", [("plain", "plain"), ("a,b", '"a,b"'), ('say "x"', '"say ""x"""'), ("a\nb", '"a\nb"')])
def test_csv_quoted(spark, given, wanted):
    assert one(spark, T.csv_quoted(F.col("v")), v=given) == wanted


def test_template_arguments():
    (t,) = X.templates("{{ill|Foo|de|Bar}}")
    assert (t["name"], t["positional"], t["named"]) == ("ill", ["Foo", "de", "Bar"], [])
    (t,) = X.templates("{{cite book|title=A B|title-link=A_B}}")
    assert t["positional"] == [] and t["named"] == [{"k": "title", "v": "A B"}, {"k": "title-link", "v": "A_B"}]
    assert [t["name"] for t in X.templates("{{l|en|{{m|en|x}}}}")] == ["m", "l"]
    assert X.templates("{{main|[[Foo|Bar]]}}")[0]["positional"] == ["[[Foo|Bar]]"]
    (t,) = X.templates("{{l|en|1=word}}")
    assert t["positional"] == ["en"] and t["named"] == []
    assert X.templates("{{x||b}}")[0]["positional"] == ["", "b"]


@pytest.mark.parametrize("text", ["{{foo|bar", "foo}}bar", "{{{foo}}}", "", None, "{{}}", "{{|a}}", "{{a|{{b|c}}", "}}{{"])
def test_broken_templates_do_not_fail(text):
    assert isinstance(X.templates(text), list)


CASES = [
    ("{{ill|Some Topic|de|Anderes}}", "encyclopedia", ["Some Topic"]),
    ("{{main|Article A|Article B}}", "encyclopedia", ["Article A", "Article B"]),
    ("{{redirect|TERM|use1|Tgt1|use2|Tgt2}}", "encyclopedia", ["Tgt1", "Tgt2"]),
    ("{{about|primary|use1|Tgt1|use2|Tgt2}}", "encyclopedia", ["Tgt1", "Tgt2"]),
    ("{{cite book|title=T|title-link=TL|author-link=AL|publisher=P}}", "encyclopedia", ["TL", "AL"]),
    ("{{l|en|word}} {{m|en|other}}", "dictionary", ["word", "other"]),
    ("{{der|en|la|cattus}}", "dictionary", ["cattus"]),
    ("{{alter|en|color|colour}}", "dictionary", ["color", "colour"]),
    ("{{alt form|en|target}}", "dictionary", ["target"]),
    ("{{syn|en|w1|w2|w3}}", "dictionary", ["w1", "w2", "w3"]),
    ("{{compound|en|head|line}}", "dictionary", ["head", "line"]),
    ("{{unknown|en|x}}", "dictionary", []),
]


def page(spark, text, title="T", ns=0, redirect=None):
    return spark.createDataFrame([(title, ns, redirect, text)], "title string, ns int, redirect string, text string")


@pytest.mark.parametrize("text, kind, wanted", CASES)
def test_template_links(spark, text, kind, wanted):
    assert [r.target for r in X.links(page(spark, text), kind).collect()] == wanted


def test_bracket_links(spark):
    text = "[[A|x]] [[A]] [[ b  ]] [[File:x.png]] [[{{t}}]] [[in [[Inner]] out]] [[two\nlines]] [[c|]]"
    assert [r.target for r in X.links(page(spark, text)).collect()] == ["A", "A", "b", "Inner", "two", "c"]


def test_redirects_and_namespaces(spark):
    pages = page(spark, "[[X]]", redirect="To").union(page(spark, "[[Y]]", ns=1)).union(page(spark, "[[Z]]", "C", 14)).union(page(spark, None, "N"))
    assert [tuple(r) for r in X.redirects(pages).collect()] == [("T", "To")]
    assert [tuple(r) for r in X.links(pages).collect()] == [("C", "Z")]


def test_template_delta(spark):
    pages = page(spark, "{{main|A|B}} [[A]] {{see also|A}}")
    assert [tuple(r) for r in X.template_delta(pages).collect()] == [("T", "main", "B")]
    s = X.delta_summary(pages).first()
    assert (s.pages, s.wikilinks, s.template_links, s.delta, s.pct) == (1, 1, 3, 1, 100.0)
    assert [tuple(r) for r in X.top_templates(pages).collect()] == [("main", 1)]
