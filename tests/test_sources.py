"""Readers, the language registry, schemas and property classes."""

import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from braidwork import schemas
from braidwork.functions import properties as P
from braidwork.operators import graph as G
from braidwork.sources import readers as S
from braidwork.sources import registry as L

PAGE = '<page><title>{}</title><ns>{}</ns>{}<revision><text>{}</text></revision></page>'


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id":"Q1"},\n  {"id":"Q2"},,,\n\nbroken\n]\n')
    lines = S.json_lines(spark, str(tmp_path / "a.json"))
    assert [r.value for r in S.good_json(lines).collect()] == ['{"id":"Q1"}', '{"id":"Q2"}']
    assert [r.value for r in S.bad_json(lines).collect()] == ["broken"]


def test_pages_of_concatenated_documents(spark, tmp_path):
    one = "<mediawiki><siteinfo/>" + PAGE.format("A &amp; B", 0, "", "x\n[[C]]") + PAGE.format("R", 0, '<redirect title="A &amp; B" />', "") + "</mediawiki>"
    two = "<mediawiki>" + PAGE.format("T", "bad", "", "y") + "<page><title>E</title><ns>0</ns><revision><text /></revision></page></mediawiki>"
    (tmp_path / "w.xml.bz2").write_bytes(bz2.compress(one.encode()) + bz2.compress(two.encode()))
    rows = [tuple(r) for r in S.wiki_pages(spark, str(tmp_path / "w.xml.bz2")).collect()]
    assert rows == [("A & B", 0, None, "x\n[[C]]"), ("R", 0, "A & B", ""), ("T", -1, None, "y"), ("E", 0, None, "")]


def test_malformed_page(spark, tmp_path):
    (tmp_path / "w.xml").write_text("<mediawiki><page><title>A</title><ns>0</wrong></page>" + PAGE.format("B", 0, "", "") + "</mediawiki>")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.wiki_pages(spark, str(tmp_path / "w.xml")).collect()
    assert [r.title for r in S.wiki_pages(spark, str(tmp_path / "w.xml"), "PERMISSIVE").collect()] == ["B"]


def test_media_titles(spark, tmp_path):
    (tmp_path / "t.gz").write_bytes(gzip.compress(b"page_title\nA_b.png\n\nC.jpg\n"))
    assert [r.filename for r in S.media_titles(spark, str(tmp_path / "t.gz")).collect()] == ["A b.png", "C.jpg"]


def test_triples(spark, tmp_path):
    (tmp_path / "t.ttl").write_text("# c\n@prefix x: <y> .\n\n<a> <p> <b> .\n<a> <p>\n  <c> <q> <d> and more .\n")
    assert [tuple(r) for r in S.triples(spark, str(tmp_path / "t.ttl")).collect()] == [("<a>", "<p>", "<b>"), ("<c>", "<q>", "<d>")]


def test_tab_files(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("a\tb\tc\nshort\n\nx\ty\r\n")
    assert [tuple(r) for r in S.tab_file(spark, str(tmp_path / "r.tsv"), ["title", "target"]).collect()] == [("a", "b\tc"), ("x", "y")]
    assert S.tab_file(spark, str(tmp_path / "none"), ["a"], missing_ok=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.tab_file(spark, str(tmp_path / "none"), ["a"]).count()


def test_counted_lines_and_counts_last(spark):
    lines = spark.createDataFrame([("  12 a\tb",), ("plain",), ("  3 x y",), ("p q",)], "value string")
    assert [tuple(r) for r in S.counted_lines(lines).collect()] == [(12, "a\tb"), (None, "plain"), (3, "x y"), (None, "p q")]
    assert [r.value for r in G.counts_last(lines).collect()] == ["a,b,12", "plain", "x,y,3", "p,q"]


REGISTRY = {"wikipedia": ["en", "fr"], "wiktionary": ["en"], "dbpedia": ["en"], "wikipedia_no_export": ["cr", "kl"]}


def test_registry(tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(REGISTRY))
    (tmp_path / "o.json").write_text(json.dumps({"wikipedia": ["fr", "xx"]}))
    assert L.load(str(tmp_path / "r.json"), "wikipedia") == ["en", "fr"]
    assert L.load(str(tmp_path / "r.json"), "wikipedia", str(tmp_path / "o.json")) == ["fr"]
    assert L.load(str(tmp_path / "r.json"), "wikipedia", str(tmp_path / "none.json")) == ["en", "fr"]
    with pytest.raises(ValueError):
        L.languages(REGISTRY, "other")
    assert L.label_chain(REGISTRY) == ["en", "fr", "cr", "kl", "mul", "doi", "best"]
    assert L.label_chain({k: v for k, v in REGISTRY.items() if k != "wikipedia_no_export"} | {"wikipedia": ["en"]}) == ["en", "mul", "doi", "best"]


def test_index_pages():
    page = '<a href="enwiki/">x</a><a href="enwiki/"><a href="zh_min_nanwiki/"><a href="simplewiki/"><a href="enwiktionary/"><a href="Bad/">'
    assert L.wiki_ids(page) == ["enwiki", "enwiktionary", "simplewiki", "zh_min_nanwiki"]
    assert L.with_suffix(L.wiki_ids(page), "wiki") == ["en", "simple"]
    assert L.export_dates('href="2026-01-02/" href="2026-03-01/" href="2026-01-02/"') == ["2026-03-01", "2026-01-02"]
    assert L.resource_languages("?lang=de&x lang%3Den lang=de") == ["de", "en"]
    assert L.manifest("ab12  shard-1.bz2\ncd34 *shard-2.bz2\n\n") == {"shard-1.bz2": "ab12", "shard-2.bz2": "cd34"}
    assert L.title_url("http://x/w/", "A b/c") == "http://x/w/A_b%2Fc"


def test_discovery_by_a_stub():
    pages = {"r": 'href="enwiki/" href="dewiki/" href="enwiktionary/"', "r/enwiki/": 'href="2026-01-01/"', "r/dewiki/": None, "r/enwiktionary/": 'href="2026-01-01/"'}
    assert L.discovered("r", pages.get) == {"wikipedia": ["en"], "wiktionary": ["en"], "wikipedia_no_export": ["de"], "dbpedia": []}


def test_language_ids_only_grow(spark):
    known = spark.createDataFrame([(1, "en"), (4, "de")], "id smallint, code string")
    codes = spark.createDataFrame([("fr",), ("en",), ("aa",), ("fr",), (None,)], "code string")
    grown = L.with_new_codes(known, codes)
    assert {r.code: r.id for r in grown.collect()} == {"en": 1, "de": 4, "aa": 5, "fr": 6}
    assert G.changed_ids(known, grown).count() == 0
    assert {r.id for r in L.with_new_codes(known.limit(0), codes).collect()} == {1, 2, 3}


def test_schemas_and_properties(spark):
    assert schemas.key("wp_links") == ["src", "dst"]
    assert all(set(k) <= set(s.names) for s, k in schemas.TABLES.values())
    assert (len(P.CAUSAL), len(P.STARTS), len(P.ENDS), len(P.POINTS), len(P.TIMES), len(P.DATED), len(P.TIMES_AND_DATED), len(P.UNSPECIFIC)) == (49, 12, 9, 2, 72, 8, 80, 6)
    assert P.ALL_INVERSES["P50"] == "P50i" and P.ALL_INVERSES["P50i"] == "P50" and P.INVERSES["P22"] == "P40"
    dim = P.dimension(spark)
    assert dim.where("is_time").count() == 72 and dim.count() == dim.select("prop").distinct().count()


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("Q2", "b,c"), ("Q1", 'say "x"')], "qid string, label string")
    G.write_text(df.coalesce(1), str(tmp_path / "csv"), ",", quoted=True)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part*"))
    assert text == 'Q2,"b,c"\nQ1,"say ""x"""\n'
    G.write_text(df.coalesce(1), str(tmp_path / "tsv"))
    assert "".join(p.read_text() for p in (tmp_path / "tsv").glob("part*")) == 'Q2\tb,c\nQ1\tsay "x"\n'
    G.write_table(df, str(tmp_path / "t"), sort=["qid"])
    assert [r.qid for r in spark.read.parquet(str(tmp_path / "t")).orderBy("qid").collect()] == ["Q1", "Q2"]
    w = spark.createDataFrame([([1, 5],)], "w array<smallint>")
    assert w.select(G.array_literal(F.col("w")).alias("x")).first().x == "{1,5}"


def test_tagged_streams(spark, tmp_path):
    (tmp_path / "en.txt").write_text("a\tb\r\n\nb\tc\n")
    (tmp_path / "de").mkdir()
    (tmp_path / "de" / "part-0").write_text("x\nx\nw\n")
    streams = S.tagged_streams(spark, {"en": str(tmp_path / "en.txt"), "de": str(tmp_path / "de")})
    assert sorted((r.lang, r.value) for r in streams.collect()) == [("de", "w"), ("de", "x"), ("de", "x"), ("en", "a\tb"), ("en", "b\tc")]
    assert [tuple(r) for r in S.order_faults(streams).collect()] == [("de", 2)]
    with pytest.raises(ValueError, match="de"):
        S.sorted_unique(streams)
    assert S.sorted_unique(streams.where("lang = 'en'")).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.tagged_streams(spark, {"fr": str(tmp_path / "none")})


def test_order_across_blocks(spark, tmp_path):
    lines = [f"{i:07d}" for i in range(3000)]
    (tmp_path / "a").write_text("\n".join(lines))
    (tmp_path / "b").write_text("\n".join([*lines[:1500], lines[3], *lines[1500:]]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        assert [tuple(r) for r in S.order_faults(S.tagged_streams(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})).collect()] == [("b", 1)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_discovery_lists_resource_languages():
    pages = {"i": '<a href="enwiki/">', "i/enwiki/": '<a href="2020-01-01/">', "r": '<a href="?lang%3Dde">'}
    found = L.discovered("i", pages.get, "r")
    assert (found["wikipedia"], found["dbpedia"]) == (["en"], ["de"])
    with pytest.raises(ValueError, match="r"):
        L.discovered("i", (pages | {"r": ""}).get, "r")


def test_downloads_are_verified(tmp_path):
    import hashlib

    files = {"a.xml": b"one", "b.xml": b"two"}
    sums = "".join(f"{hashlib.sha256(x).hexdigest()}  {n}\n" for n, x in files.items())
    pages = {"i/enwiki/": '<a href="2021-01-01/"><a href="2020-06-01/">', "i/enwiki/2020-06-01/SHA256SUMS": sums}
    got = []

    def fetch_to(url, path):
        got.append(url)
        path.write_bytes(files[url.rsplit("/", 1)[1]])

    (tmp_path / "enwiki" / "2019-01-01").mkdir(parents=True)
    paths = L.download("i", "enwiki", str(tmp_path), pages.get, fetch_to)
    assert [p.rsplit("/", 2)[1:] for p in paths] == [["2020-06-01", "a.xml"], ["2020-06-01", "b.xml"]]
    assert not (tmp_path / "enwiki" / "2019-01-01").exists()
    L.download("i", "enwiki", str(tmp_path), pages.get, fetch_to)
    assert len(got) == 2
    files["a.xml"] = b"spoilt"
    (tmp_path / "enwiki" / "2020-06-01" / "a.xml").write_bytes(b"x")
    with pytest.raises(ValueError, match="a.xml"):
        L.download("i", "enwiki", str(tmp_path), pages.get, fetch_to)
    with pytest.raises(FileNotFoundError):
        L.download("i", "dewiki", str(tmp_path), pages.get, fetch_to)
