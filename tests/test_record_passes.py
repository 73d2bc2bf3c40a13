"""Records are written by many tasks, parsed once, and large files that cannot be split are dealt out."""

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from braidwork.functions import text as T
from braidwork.operators import entities as E
from braidwork.plans import record_queries as D
from braidwork.sources import readers as S


def test_one_task_writes_many_files(spark, sf):
    path = D._lines(D._parts(spark, sf), "name", codec="gzip")
    assert len(list(Path(path.removeprefix("file:")).glob("*.gz"))) > 8
    assert spark.read.text(path).count() == D._parts(spark, sf).count()


@pytest.mark.parametrize("make", [lambda e: E.labels(e, D.CHAIN), E.entity_rows, E.edges, E.dates, E.coordinates])
def test_entities_are_parsed_once(spark, make):
    lines = spark.createDataFrame([('{"id":"Q1"}',)], "value string")
    assert make(E.entities(lines))._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


@pytest.mark.parametrize("make", [E.words, E.lexeme_links, E.sense_links])
def test_lexemes_are_parsed_once(spark, make):
    lines = spark.createDataFrame([('{"id":"L1"}',)], "value string")
    assert make(E.lexemes(lines))._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_one_pass_gives_what_two_gave(spark):
    snak = lambda x: '[{"mainsnak":{"datatype":"wikibase-item","datavalue":{"value":{"id":"%s"}}}}]' % x
    claims = '{"P5191":%s,"P5137":%s,"P6684":null}' % (snak("L2"), snak("Q3"))
    sense = '{"P9970":%s,"P5972":%s,"P5137":%s}' % (snak("Q1"), snak("L4-S1"), snak("Q-S"))
    lines = spark.createDataFrame(
        [('{"id":"L1","lemmas":{"en":{"value":"a"}},"claims":%s,"forms":[{"representations":{"en":{"value":"a"}}},null,{}],"senses":[{"id":"L1-S1","claims":%s},{"id":"L1-S2","claims":[]}]}' % (claims, sense),), ('{"id":"L2"}',), ("{",), ('{"id":"L3","lemmas":{"de":{}},"forms":[],"claims":{"P5137":[null]}}',)],
        "value string",
    )
    x = E.lexemes(lines)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(E.words(x).select("lang", "lemma", "lid")) == sorted(rows(E.lemmas(x)) + rows(E.forms(x)))
    links = E.lexeme_links(x).select("src", "dst", "prop")
    assert rows(links) == sorted(rows(E.lexeme_lexeme(x)) + rows(E.lexeme_item(x)))
    items = E.sense_item(x).selectExpr("src_lid", "src_sid", "'' dst_lid", "dst dst_sid", "prop")
    assert rows(E.sense_links(x)) == sorted(rows(E.sense_sense(x)) + rows(items))


def test_large_file_is_dealt_out(spark, tmp_path, monkeypatch):
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        out.writelines('{"id":"Q%d"},\n' % i for i in range(1000))
    few = S.json_lines(spark, str(tmp_path))
    monkeypatch.setattr(S, "LARGE", 100)
    lines = S.json_lines(spark, str(tmp_path))
    assert few.rdd.getNumPartitions() == 1 and lines.rdd.getNumPartitions() > 8
    assert sorted(r.value for r in lines.collect()) == sorted('{"id":"Q%d"}' % i for i in range(1000))


def test_trim(spark):
    space = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    own = ["", "a", " ", "!", "é", "​", "a b", "~\x1f", "\x7f", None]
    texts = own + [a + (x or "") + b for x in own for c in space for a, b in ((c, ""), ("", c), (c + c, c + " "))]
    out = spark.createDataFrame([(x,) for x in texts], "x string").select("x", T.utrim(F.col("x")).alias("y")).collect()
    assert all(r.y == (None if r.x is None else r.x.strip(space)) for r in out)
