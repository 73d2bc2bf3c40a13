"""Driver queries over dump records: each writes lines, pages or fields made from every row of a driver table, reads them back with the engine's readers
and runs one operator. ORACLES says what must come out, from the table's columns alone. Numbers are 64-bit on both sides."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import properties as P
from ..functions import text as T
from ..operators import entities as E
from ..operators import graph as G
from ..operators import resolve as R
from ..operators import wikitext as X
from ..sources import readers as S
from ..sources import registry as L

CHAIN = ["en", "eo", "it", "kl", "mul", "doi", "best"]


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or, on one machine and where that is unset, a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        base = tempfile.mkdtemp(prefix="braidwork-")
    return f"{base.rstrip('/')}/records-{uuid.uuid4().hex}"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "part").selectExpr("p_partkey k", "p_name name", "p_brand brand", "p_type kind", "p_size size")


def _lines(rows: DataFrame, *exprs: str, codec: str = "none") -> str:
    """A folder of text files that hold the expressions' values, one after the other, for each row; nulls are left out."""
    path = scratch(rows.sparkSession)
    value = F.explode(F.array_compact(F.array(*[F.expr(e) for e in exprs])))
    # the table may come in one task, but its rows become long lines, and compressed files are read whole
    S.dealt(rows, "k").select(value.alias("value")).write.option("compression", codec).text(path)
    return path


def _kept(rows: DataFrame) -> DataFrame:
    """rows, written and read again: for queries that read them several times."""
    path = scratch(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _wide(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c, t in df.dtypes if t in ("int", "smallint")})


def _union(first: DataFrame, *more: DataFrame) -> DataFrame:
    for df in more:
        first = first.unionByName(df)
    return first


# ---- entities


def _item(target: str) -> str:
    return f'{{"datatype":"wikibase-item","datavalue":{{"value":{{"id":"{target}"}}}}}}'


def _time(time: str, precision: int) -> str:
    return f'{{"datatype":"time","datavalue":{{"value":{{"time":"{time}","precision":{precision}}}}}}}'


def _when(condition: str, text: str) -> str:
    """SQL for the text, in which <x> stands for the value of x, or null."""
    parts = text.replace("'", "''").replace(">", "<").split("<")
    return f"CASE WHEN {condition} THEN concat({', '.join(f'CAST({p} AS STRING)' if i % 2 else repr(p) for i, p in enumerate(parts) if p)}) END"


def _members(*parts: str) -> str:
    return f"array_join(array_compact(array({', '.join(parts)})), ',')"


def _entity_lines(spark: SparkSession, sf: str) -> DataFrame:
    labels = _members(_when("k % 2 = 0", '"en":{"value":"<name> <k>"}'), _when("k % 3 = 0", '"de":{"value":"<brand>"}'), _when("k % 7 = 0", '"mul":{"value":"<kind> <k>"}'), _when("k % 5 = 1", '"zz":{"value":"z"},"aa":{"value":"a <k>"}'))
    links = _members(_when("k % 4 = 0", '"enwiki":{"title":"<name> <k>"}'), _when("k % 3 = 1", '"eowiki":{"title":"E<k>"}'), _when("k % 6 = 0", '"itwiki":{"title":"<brand>"}'), _when("k % 2 = 1", '"enwikiquote":{"title":"x"}'), _when("k % 5 = 0", '"commonswiki":{"title":"y"}'))
    claims = _members(
        _when("true", f'"P31":[{{"mainsnak":{_item("Q<1000 + size>")},"qualifiers":{{"P1001":[{_item("Q<k % 3>")}],"P580":[{_time("+2000-01-01T00:00:00Z", 11)}]}}}}]'),
        _when("k % 2 = 1", f'"P569":[{{"mainsnak":{_time("+<1900 + k % 100>-00-00T00:00:00Z", 9)}}},{{"mainsnak":{_time("+00000000000<1900 + k % 100>-00-00T00:00:00Z", 9)}}},{{"mainsnak":{_time("+000000000000<1900 + k % 100>-00-00T00:00:00Z", 9)}}}]'),
        _when("k % 10 = 7", f'"P108":[{{"mainsnak":{_item("Q7")},"qualifiers":{{"P580":[{_time("+1999-00-00T00:00:00Z", 9)}]}}}}]'),
        _when("k % 10 = 2", f'"P108":[{{"mainsnak":{{"datatype":"wikibase-item"}},"qualifiers":{{"P582":[{_time("+1998-00-00T00:00:00Z", 10)}]}}}}]'),
        _when("k % 4 = 3", '"P625":[{"mainsnak":{"datatype":"globe-coordinate","datavalue":{"value":{"latitude":<k % 90>.5,"longitude":<k % 180>,"altitude":null,"precision":0.25,"globe":"http://www.example.org/entity/Q2"}}}},{"mainsnak":{"datatype":"globe-coordinate","datavalue":{"value":{"latitude":<k % 90>.5,"longitude":<k % 180>,"altitude":<k % 50>,"globe":"http://www.example.org/entity/Q2"}}}}]'),
        _when("k % 18 = 0", '"P356":[{"mainsnak":{"datatype":"external-id"}},{"mainsnak":{"datatype":"external-id","datavalue":{"value":"10.1/<k>"}}}]'),
        _when("k % 18 = 9", '"P356":[{"mainsnak":{"datatype":"external-id","datavalue":{"value":"10.2/<k>"}}}]'),
        _when("k % 11 = 0", '"P1647":[{"mainsnak":{"datatype":"wikibase-property","datavalue":{"value":{"id":"P<size>"}}}}]'),
        _when("k % 13 = 0", '"P22":[{"mainsnak":{"datatype":"wikibase-item"}}]'),
    )
    line = f"""concat('{{"id":"Q', k, '","labels":', CASE WHEN k % 10 = 9 THEN '[]' ELSE concat('{{', {labels}, '}}') END, ',"sitelinks":{{', {links}, '}},"claims":{{', {claims}, '}}}},', CASE WHEN k % 2 = 0 THEN ',' ELSE '' END)"""
    path = _lines(_parts(spark, sf), "CASE WHEN k = 0 THEN '[' END", line, "CASE WHEN k % 8 = 0 THEN '{\"id\":\"broken' END", "CASE WHEN k = 1 THEN '  ' END", "CASE WHEN k = 0 THEN ']' END", codec="gzip")
    return S.json_lines(spark, path)


def q_json_lines(spark, sf):
    lines = _entity_lines(spark, sf)
    return S.json_report(lines)


def _entities(spark, sf, *fields):
    return E.entities(_entity_lines(spark, sf), *fields)


def q_entity_labels(spark, sf):
    return E.labels(_entities(spark, sf, "labels", "sitelinks", "claims"), CHAIN)


def q_entity_items(spark, sf):
    return _wide(E.entity_rows(_entities(spark, sf, "labels", "sitelinks")))


def q_entity_edges(spark, sf):
    return E.edges(_entities(spark, sf, "claims"))


def q_entity_dates(spark, sf):
    return _wide(E.dates(_entities(spark, sf, "claims")))


def q_entity_coordinates(spark, sf):
    return E.coordinates(_entities(spark, sf, "claims"))


_BEST = "CASE WHEN k % 4 = 0 THEN name || ' ' || k WHEN k % 6 = 0 THEN brand WHEN k % 10 = 9 THEN 'Q' || k WHEN k % 7 = 0 THEN kind || ' ' || k WHEN k % 2 = 0 THEN name || ' ' || k WHEN k % 3 = 0 THEN brand WHEN k % 5 = 1 THEN 'a ' || k ELSE 'Q' || k END"
PARTS = "p AS (SELECT p_partkey k, p_name AS name, p_brand brand, p_type kind, p_size AS size FROM part)"

ORACLES = {
    "json_lines": f"WITH {PARTS} SELECT count(*) good, count(*) FILTER (k % 8 = 0) bad FROM p",
    "entity_labels": f"""WITH {PARTS} SELECT 'en' lang, name || ' ' || k AS label, 'Q' || k qid FROM p WHERE k % 4 = 0 UNION SELECT 'eo', 'E' || k, 'Q' || k FROM p WHERE k % 3 = 1 UNION SELECT 'it', brand, 'Q' || k FROM p WHERE k % 6 = 0
 UNION SELECT 'mul', kind || ' ' || k, 'Q' || k FROM p WHERE k % 7 = 0 AND k % 10 <> 9 UNION SELECT 'doi', CASE WHEN k % 18 = 0 THEN '10.1/' ELSE '10.2/' END || k, 'Q' || k FROM p WHERE k % 9 = 0 UNION SELECT 'best', {_BEST}, 'Q' || k FROM p""",
    "entity_items": f"WITH {PARTS} SELECT 'Q' || k qid, {_BEST} best_label, CAST((k % 4 = 0)::INT + (k % 3 = 1)::INT + (k % 6 = 0)::INT AS BIGINT) wp_count FROM p",
    "entity_edges": f"""WITH {PARTS} SELECT 'Q' || k src, 'Q' || (1000 + size) dst, 'P31' prop FROM p UNION SELECT 'Q' || k, 'Q' || k % 3, 'P1001' FROM p UNION SELECT 'Q' || k, 'Q7', 'P108' FROM p WHERE k % 10 = 7 UNION SELECT 'Q' || k, 'P' || size, 'P1647' FROM p WHERE k % 11 = 0""",
    "entity_dates": f"""WITH {PARTS}, d AS (SELECT k, 'P569' property, '+' || (1900 + k % 100) || '-00-00T00:00:00Z' time_value, 9 AS precision, '' source_property, '' source_target FROM p WHERE k % 2 = 1
 UNION ALL SELECT k, 'P569', '+00000000000' || (1900 + k % 100) || '-00-00T00:00:00Z', 9, '', '' FROM p WHERE k % 2 = 1
 UNION ALL SELECT k, 'P580', '+1999-00-00T00:00:00Z', 9, 'P108', 'Q7' FROM p WHERE k % 10 = 7 UNION ALL SELECT k, 'P582', '+1998-00-00T00:00:00Z', 10, 'P108', '' FROM p WHERE k % 10 = 2)
 SELECT DISTINCT 'Q' || k qid, property, time_value, CAST(precision AS BIGINT) AS precision, source_property, source_target FROM d WHERE length(time_value) <= 32""",
    "entity_coordinates": f"WITH {PARTS} SELECT 'Q' || k qid, k % 90 + 0.5::DOUBLE latitude, CAST(k % 180 AS DOUBLE) longitude, CAST(k % 50 AS DOUBLE) altitude, CAST(NULL AS DOUBLE) AS precision, 'Q2' globe FROM p WHERE k % 4 = 3",
}


# ---- lexemes, function objects


def _lexemes(spark: SparkSession, sf: str) -> DataFrame:
    snak = lambda x: f'[{{"mainsnak":{_item(x)}}}]'
    lemmas = _members(_when("true", '"en":{"value":"<name>"}'), _when("k % 2 = 0", '"de":{"value":"<brand>"}'))
    claims = _members(_when("k % 3 = 0", f'"P5191":{snak("L<k + 1>")}'), _when("k % 3 = 1", f'"P5191":{snak("Q5")}'), _when("k % 5 = 0", f'"P5238":{snak("L5-F1")}'), _when("k % 4 = 0", f'"P5137":{snak("Q<k>")}'), _when("k % 6 = 0", f'"P6684":{snak("Q1")}'), _when("true", f'"P1":{snak("L1")}'))
    forms = _members(_when("k % 7 > 0", '{"representations":{"en":{"value":"<name>s"}}}'), _when("k % 7 > 3", '{"representations":{"en":{"value":"<name>s"},"fr":{"value":"f<k>"}}}'))
    sense = _members(_when("k % 4 = 1", f'"P5137":{snak("Q<k>")}'), _when("k % 3 = 0", f'"P9970":{snak("Q9")}'), _when("k % 3 = 1", f'"P5973":{snak("L7-S<size>")}'), _when("k % 3 = 2", f'"P5974":{snak("L8")}'))
    line = f"""concat('{{"id":"L', k, '","lemmas":{{', {lemmas}, '}},"claims":{{', {claims}, '}},"forms":[', {forms}, '],"senses":[{{"id":"L', k, '-S1","claims":', CASE WHEN k % 9 = 0 THEN '[]' ELSE concat('{{', {sense}, '}}') END, '}}]}},')"""
    return E.lexemes(S.json_lines(spark, _lines(_parts(spark, sf), line, codec="bzip2")))


def q_lexeme_words(spark, sf):
    x = _lexemes(spark, sf)
    return E.words(x)


def q_lexeme_links(spark, sf):
    x = _lexemes(spark, sf)
    return E.lexeme_links(x)


def q_sense_links(spark, sf):
    x = _lexemes(spark, sf)
    return E.sense_links(x)


def _object_pages(spark: SparkSession, sf: str) -> DataFrame:
    label = '{"Z1K1":"Z11","Z11K1":"Z<1002 + k % 3>","Z11K2":" <name>\\tno. <k> "}'
    alias = '{"Z1K1":"Z32","Z31K1":"Z1002","Z31K2":["Z6","one \\"<k>\\"","","one \\"<k>\\"","two"]}'
    text = f"""concat('{{"Z2K3":{{"Z12K1":["Z11"', coalesce({_when("k % 4 > 0", "," + label)}, ''), ']}},"Z2K4":{{"Z32K1":["Z32"', coalesce({_when("k % 5 = 0", "," + alias)}, ''), ']}}}}')"""
    return _parts(spark, sf).select(F.expr("CASE WHEN k % 10 = 6 THEN concat('Foo', k) ELSE concat('Z', k) END").alias("title"), F.expr("CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END").alias("ns"), F.expr(f"CASE WHEN k % 9 = 4 THEN '{{\"Z2K3\":' ELSE {text} END").alias("text"))


def q_object_labels(spark, sf):
    return E.object_labels(_object_pages(spark, sf))


def q_objects(spark, sf):
    pages = _object_pages(spark, sf)
    return E.objects(pages).select("zid", F.lit("object").alias("kind")).unionByName(E.bad_objects(pages).select("zid", F.lit("bad").alias("kind")))


ORACLES |= {
    "lexeme_words": f"WITH {PARTS} SELECT DISTINCT 'en' lang, name lemma, 'L' || k lid, 'lemma' kind FROM p UNION SELECT 'de', brand, 'L' || k, 'lemma' FROM p WHERE k % 2 = 0 UNION SELECT 'en', name || 's', 'L' || k, 'form' FROM p WHERE k % 7 > 0 UNION SELECT 'fr', 'f' || k, 'L' || k, 'form' FROM p WHERE k % 7 > 3",
    "lexeme_links": f"WITH {PARTS} SELECT 'L' || k src, 'L' || (k + 1) dst, 'P5191' prop, 'lexeme' kind FROM p WHERE k % 3 = 0 UNION SELECT 'L' || k, 'L5-F1', 'P5238', 'lexeme' FROM p WHERE k % 5 = 0 UNION SELECT 'L' || k, 'Q' || k, 'P5137', 'item' FROM p WHERE k % 4 = 0 UNION SELECT 'L' || k, 'Q1', 'P6684', 'item' FROM p WHERE k % 6 = 0",
    "sense_links": f"WITH {PARTS}, s AS (SELECT * FROM p WHERE k % 9 <> 0) SELECT 'L' || k src_lid, 'L' || k || '-S1' src_sid, 'L7' dst_lid, 'L7-S' || size dst_sid, 'P5973' prop FROM s WHERE k % 3 = 1 UNION SELECT 'L' || k, 'L' || k || '-S1', '', 'Q' || k, 'P5137' FROM s WHERE k % 4 = 1 UNION SELECT 'L' || k, 'L' || k || '-S1', '', 'Q9', 'P9970' FROM s WHERE k % 3 = 0",
    "object_labels": f"WITH {PARTS}, o AS (SELECT * FROM p WHERE k % 10 NOT IN (3, 6) AND k % 9 <> 4) SELECT 'Z' || k zid, 'Z' || (1002 + k % 3) lang, 'L' kind, name || ' no. ' || k AS label FROM o WHERE k % 4 > 0 UNION SELECT 'Z' || k, 'Z1002', 'A', 'one  ' || k FROM o WHERE k % 5 = 0 UNION SELECT 'Z' || k, 'Z1002', 'A', 'two' FROM o WHERE k % 5 = 0",
    "function_objects": f"WITH {PARTS}, o AS (SELECT * FROM p WHERE k % 10 NOT IN (3, 6)) SELECT 'Z' || k zid, 'object' kind FROM o UNION ALL SELECT 'Z' || k, 'bad' FROM o WHERE k % 9 = 4",
}


# ---- pages


def _page_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of export files in which documents follow each other."""
    ns = "CASE k % 5 WHEN 1 THEN '14' WHEN 2 THEN '1' WHEN 3 THEN 'x' ELSE '0' END"
    text = "concat('<text bytes=\"9\">[[Link ', k, '|label]] &amp; [[ ', name, ' ]] [[File:x.png]] [[:Up]] [[a{{b}}]] [[Link ', k, ']]\n{{Main|T ', k, '| A &amp; ', brand, ' }}{{cite web|url=u|title-link=C ', k, '}} [[talk:x]]</text>')"
    page = f"concat('<page><title>', CASE WHEN k % 6 = 0 THEN concat('A &amp; B ', k) ELSE concat('Page ', k) END, '</title><ns>', {ns}, '</ns><id>', k, '</id>', CASE WHEN k % 7 = 0 THEN concat('<redirect title=\"R &amp; ', k, '\" />') ELSE '' END, '<revision><id>1</id>', CASE WHEN k % 11 = 0 THEN '<text />' ELSE {text} END, '</revision></page>')"
    return S.wiki_pages(spark, _lines(_parts(spark, sf), "CASE WHEN k % 3 = 0 THEN '<mediawiki><siteinfo><sitename>x</sitename></siteinfo>' END", page, "CASE WHEN k % 3 = 2 THEN '</mediawiki>' END", codec="bzip2"))


def q_page_scan(spark, sf):
    return _wide(_page_scan(spark, sf).select("title", "ns", "redirect", F.char_length("text").alias("n_chars")))


def q_page_links(spark, sf):
    pages = _page_scan(spark, sf)
    links = X.links(pages).groupBy("title", "target").agg(F.count("*").alias("n"))
    return links.unionByName(X.redirects(pages).select("title", "target", F.lit(0).cast("bigint").alias("n")))


def _word_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf).select(F.expr("concat('  word ', k, ' ')").alias("title"), F.expr("CASE k % 5 WHEN 1 THEN 14 WHEN 2 THEN 1 ELSE 0 END").alias("ns"), F.expr("CASE WHEN k % 8 = 0 THEN concat(' to ', name) END").alias("redirect"), F.expr("concat('[[ ', name, ' |x]] {{m|en| mm ', k, ' }} {{der|en|la|d ', k, '}} {{syn|en|s1||s2}} {{ll|en}}')").alias("text"))


def q_dictionary_links(spark, sf):
    pages = _word_pages(spark, sf)
    links = X.links(pages, "dictionary").groupBy("title", "target").agg(F.count("*").alias("n"))
    return links.unionByName(X.redirects(pages, trim=True).select("title", "target", F.lit(0).cast("bigint").alias("n")))


#: A template of each kind of argument, and the targets it must give, by name: what the reference documents, written out for the rows.
_FAMILIES = {
    "encyclopedia": (
        (("ill", "illm", "ill-wd", "interlanguage link", "interlanguage link multi", "interwiki link", "link-interwiki"), ("a",)),
        (("main", "see also", "further", "details", "broader"), ("a", "b", "c", "d", "e")),
        (("redirect", "redirect2", "redirect-distinguish", "about"), ("c", "e")),
        (("cite book", "cite web", "citation"), ("TL", "CL", "AL", "EL", "PL", "SL", "NL", "YL", "WL")),
        (("infobox", "main article"), ()),
    ),
    "dictionary": (
        (("l", "link", "ll", "m", "mention", "m+", "l-self", "m-self", "alt form", "alternative spelling of", "inflection of"), ("b",)),
        (("der", "inh", "bor", "cog", "borrowed", "inherited", "derived", "calque", "noncog"), ("c",)),
        (("syn", "ant", "alt", "alter", "hyper", "hypo", "mero", "holo", "compound", "affix", "prefix", "suffix", "confix"), ("b", "c", "d", "e")),
        (("quote", "derive"), ()),
    ),
}
_CITED = "title-link=TL |chapter-link=CL |author-link=AL |editor-link=EL |publisher-link=PL |subject-link=SL |contribution-link=NL |encyclopedia-link=YL |work-link=WL "


def q_template_families(spark, sf):
    """Every family, once for each part."""
    out = []
    for kind, families in _FAMILIES.items():
        names = [n for ns, _ in families for n in ns]
        texts = F.array(*[F.concat(F.lit("{{" + n.replace(" ", "_").capitalize() + " |"), *[x for c in "abcde" for x in (F.lit(f"{c} "), F.col("k").cast("string"), F.lit("|"))], F.lit(f"|7=n|{_CITED}}}}}")) for n in names])
        # the table may come in one task, but each row becomes many templates
        pages = S.dealt(_parts(spark, sf), "k").select("k", F.array_join(texts, "\n").alias("text"))
        rows = X.with_templates(pages).select("k", T.template_name(F.col("t.name")).alias("template"), F.explode(X.template_targets(F.col("t"), kind)).alias("target"))
        out.append(rows.select(F.lit(kind).alias("kind"), "template", F.split_part("target", F.lit(" "), F.lit(1)).alias("letter"), (F.split_part("target", F.lit(" "), F.lit(2)) == F.col("k").cast("string")).alias("own")).groupBy("kind", "template", "letter", "own").agg(F.count("*").alias("n")))
    return _union(*out)


def _delta_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf).select(F.expr("concat('D', lpad(k, 9, '0'))").alias("title"), F.expr("CASE WHEN k % 5 = 1 THEN 1 ELSE 0 END").alias("ns"), F.expr("CASE WHEN k % 7 = 2 THEN 'r' END").alias("redirect"), F.expr("concat('[[A]] [[B ', k, ']] [[A|x]] {{main|A|C ', k, '}} {{See_also|B ', k, '|File:x|D}}')").alias("text"))


def q_delta_summary(spark, sf):
    return _wide(X.delta_summary(_delta_pages(spark, sf)))


def q_delta_limited(spark, sf):
    return X.template_delta(X.first_pages(_delta_pages(spark, sf), 50))


def q_top_templates(spark, sf):
    return X.top_templates(_delta_pages(spark, sf), most=1)


_PAGE = f"""{PARTS}, x AS (SELECT *, CASE WHEN k % 6 = 0 THEN 'A & B ' || k ELSE 'Page ' || k END title, CASE k % 5 WHEN 1 THEN 14 WHEN 2 THEN 1 WHEN 3 THEN -1 ELSE 0 END ns, CASE WHEN k % 7 = 0 THEN 'R & ' || k END redirect,
 CASE WHEN k % 11 = 0 THEN '' ELSE '[[Link ' || k || '|label]] & [[ ' || name || ' ]] [[File:x.png]] [[:Up]] [[a{{{{b}}}}]] [[Link ' || k || ']]' || chr(10) || '{{{{Main|T ' || k || '| A & ' || brand || ' }}}}{{{{cite web|url=u|title-link=C ' || k || '}}}} [[talk:x]]' END body FROM p), own AS (SELECT * FROM x WHERE ns IN (0, 14))"""
_FAMILY_ROWS = ", ".join(f"('{kind}', '{n}', '{letter}')" for kind, families in _FAMILIES.items() for ns, letters in families for n in ns for letter in letters)
_DELTA = f"{PARTS}, o AS (SELECT *, 'D' || lpad(CAST(k AS VARCHAR), 9, '0') title FROM p WHERE k % 5 <> 1 AND k % 7 <> 2)"
ORACLES |= {
    "page_scan": f"WITH {_PAGE} SELECT title, CAST(ns AS BIGINT) ns, redirect, CAST(length(body) AS BIGINT) n_chars FROM x",
    "page_links": f"""WITH {_PAGE}, t AS (SELECT title, 'Link ' || k target, 2 n FROM own WHERE redirect IS NULL AND body <> '' UNION ALL SELECT title, name, 1 FROM own WHERE redirect IS NULL AND body <> '' UNION ALL SELECT title, ':Up', 1 FROM own WHERE redirect IS NULL AND body <> ''
 UNION ALL SELECT title, 'T ' || k, 1 FROM own WHERE redirect IS NULL AND body <> '' UNION ALL SELECT title, 'A & ' || brand, 1 FROM own WHERE redirect IS NULL AND body <> '' UNION ALL SELECT title, 'C ' || k, 1 FROM own WHERE redirect IS NULL AND body <> '' UNION ALL SELECT title, redirect, 0 FROM own WHERE redirect IS NOT NULL)
 SELECT title, target, CAST(n AS BIGINT) n FROM t""",
    "dictionary_links": f"""WITH {PARTS}, o AS (SELECT *, 'word ' || k title FROM p WHERE k % 5 <> 2), l AS (SELECT title, unnest([name, 'mm ' || k, 'd ' || k, 's1', 's2']) target FROM o WHERE k % 8 <> 0) SELECT title, target, count(*) n FROM l GROUP BY ALL UNION ALL SELECT title, 'to ' || name, 0 FROM o WHERE k % 8 = 0""",
    "template_families": f"WITH f(kind, template, letter) AS (VALUES {_FAMILY_ROWS}) SELECT kind, template, letter, length(letter) = 1 AS own, (SELECT count(*) FROM part) n FROM f",
    "delta_summary": f"WITH {_DELTA} SELECT count(*) pages, 2 * count(*) wikilinks, 4 * count(*) template_links, 2 * count(*) delta, CASE WHEN count(*) > 0 THEN 100.0::DOUBLE ELSE 0 END pct FROM o",
    "delta_limited": f"WITH {_DELTA}, f AS (SELECT * FROM o ORDER BY title LIMIT 50) SELECT title, 'main' template, 'C ' || k target FROM f UNION ALL SELECT title, 'See_also', 'D' FROM f",
    "top_templates": f"WITH {_DELTA} SELECT 'main' template, count(*) AS count FROM o",
}


# ---- smaller readers and writers


def q_media_titles(spark, sf):
    path = _lines(_parts(spark, sf), "CASE WHEN k = 0 THEN 'page_title' END", "concat(replace(name, ' ', '_'), '_', k, '.png')", "CASE WHEN k % 4 = 0 THEN '' END", codec="gzip")
    return S.media_titles(spark, path).unionByName(S.media_titles(spark, scratch(spark), missing_ok=True))


def _triple_lines(spark, sf):
    return _lines(_parts(spark, sf), "CASE WHEN k % 5 = 0 THEN '# note' END", "CASE WHEN k % 6 = 0 THEN '@prefix x: <y> .' END", "CASE WHEN k % 7 = 0 THEN '<a> <b>' END", "concat('  <http://r.example/resource/T_', k, '> <http://o.example/p', k % 3, '> <http://r.example/resource/', CASE k % 4 WHEN 0 THEN '%C3%A9_' WHEN 1 THEN 'a+b_' WHEN 2 THEN '%FF_' ELSE 'x_' END, k, '> .')", codec="bzip2")


def q_triples(spark, sf):
    return S.triples(spark, _triple_lines(spark, sf))


def q_resource_links(spark, sf):
    p = _parts(spark, sf)
    labels = p.selectExpr("'en' lang", "concat('T ', k) label", "concat('Q', k) qid").unionByName(p.selectExpr("'en' lang", "concat(CASE k % 4 WHEN 0 THEN 'é ' WHEN 1 THEN 'a+b ' ELSE 'y ' END, k) label", "concat('Q9', k) qid")).unionByName(p.selectExpr("'de' lang", "concat('x ', k) label", "'Q5' qid"))
    return R.resource_links(S.triples(spark, _triple_lines(spark, sf)), labels, "en")


def q_tab_files(spark, sf):
    path = _lines(_parts(spark, sf), "concat('en\t', name, ' ', k, '\tQ', k, CASE WHEN k % 3 = 0 THEN '\tmore' ELSE '' END, CASE WHEN k % 2 = 0 THEN '\r' ELSE '' END)", "CASE WHEN k % 5 = 0 THEN 'short\tline' END", "CASE WHEN k % 9 = 0 THEN '' END")
    return S.tab_file(spark, path, ["lang", "label", "qid"]).unionByName(S.tab_file(spark, scratch(spark), ["lang", "label", "qid"], missing_ok=True))


def q_streams_merged(spark, sf):
    """Sorted streams of three languages, merged; the check of order finds nothing."""
    p, base = _parts(spark, sf), scratch(spark)
    for lang, every in (("en", 1), ("de", 2), ("fr", 3)):
        own = p.where(f"k % {every} = 0").selectExpr("concat('Q', lpad(k, 9, '0'), '\tQ', size, CASE WHEN k % 2 = 0 THEN '\r' ELSE '' END) value")
        own.repartition(1).sortWithinPartitions("value").write.text(f"{base}/{lang}")
    lines = S.tagged_streams(spark, {lang: f"{base}/{lang}" for lang in ("en", "de", "fr")})
    ids = spark.createDataFrame([("en", 1), ("de", 2), ("fr", 3)], "lang string, lang_id smallint")
    rows = S.sorted_unique(lines).join(F.broadcast(ids), "lang").select("lang_id", *S.split_fields(F.col("value"), ["src", "dst"]))
    return _wide(G.witness_links(rows).withColumn("witnesses", G.array_literal(F.col("witnesses"))))


def q_order_faults(spark, sf):
    """Streams of two languages with rows out of order and repeated."""
    p, base = _parts(spark, sf), scratch(spark)
    p.repartition(1).sortWithinPartitions("k").selectExpr("lpad(CASE WHEN k % 10 = 5 THEN k - 2 WHEN k % 10 = 8 THEN k - 1 ELSE k END, 9, '0') value").write.text(f"{base}/en")
    p.repartition(1).sortWithinPartitions("k").selectExpr("lpad(k, 9, '0') value").write.text(f"{base}/de")
    return S.order_faults(S.tagged_streams(spark, {"en": f"{base}/en", "de": f"{base}/de"}))


def _count_lines(spark, sf):
    return _lines(_parts(spark, sf), "CASE k % 4 WHEN 0 THEN concat('   ', size, ' Q', k, ' Q1') WHEN 1 THEN concat('Q', k, '  Q2') WHEN 2 THEN concat(' ', size, ' a b ', k, '\tc d') ELSE concat('x ', k, '\ty\tz w') END", "CASE WHEN k % 6 = 0 THEN ' ' END")


def q_counts_last(spark, sf):
    return G.counts_last(spark.read.text(_count_lines(spark, sf)))


def q_counted_lines(spark, sf):
    return S.counted_lines(spark.read.text(_count_lines(spark, sf)).where("value != ' '"))


def q_text_exchange(spark, sf):
    """Comma-separated text with quotes where they are needed, written and read again as lines."""
    path, p = scratch(spark), _parts(spark, sf)
    rows = p.select(F.expr("concat('Q', k)").alias("qid"), F.expr("CASE k % 4 WHEN 0 THEN concat(name, ', ', k) WHEN 1 THEN concat('say \"', name, '\"') ELSE name END").alias("best_label"), (F.col("k") % 7).alias("wp_count"))
    G.write_text(rows, path, sep=",", quoted=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_csv_quoted(spark, sf):
    raw = F.expr("CASE k % 5 WHEN 0 THEN concat(name, ',', k) WHEN 1 THEN concat('\"', name) WHEN 2 THEN concat(name, '\n', k) WHEN 3 THEN '' ELSE name END")
    return _parts(spark, sf).select("k", T.csv_quoted(raw).alias("quoted"))


_LINE = "CASE k % 4 WHEN 0 THEN 'Q' || k || ',Q1,' || size WHEN 1 THEN 'Q' || k || ',Q2' WHEN 2 THEN 'a b ' || k || ',c d,' || size ELSE 'x ' || k || ',y,z w' END"
_OBJECT = "CASE k % 4 WHEN 0 THEN '%C3%A9_' WHEN 1 THEN 'a+b_' WHEN 2 THEN '%FF_' ELSE 'x_' END"
ORACLES |= {
    "media_titles": f"WITH {PARTS} SELECT replace(name, '_', ' ') || ' ' || k || '.png' filename FROM p",
    "triples_scan": f"WITH {PARTS} SELECT '<http://r.example/resource/T_' || k || '>' s, '<http://o.example/p' || k % 3 || '>' p, '<http://r.example/resource/' || {_OBJECT} || k || '>' o FROM p",
    "resource_links": f"WITH {PARTS} SELECT 'Q' || k src, 'Q9' || k dst, '<http://o.example/p' || k % 3 || '>' predicate FROM p WHERE k % 4 IN (0, 1)",
    "tab_files": f"WITH {PARTS} SELECT 'en' lang, name || ' ' || k AS label, 'Q' || k || CASE WHEN k % 3 = 0 THEN chr(9) || 'more' ELSE '' END qid FROM p",
    "streams_merged": f"WITH {PARTS} SELECT 'Q' || lpad(CAST(k AS VARCHAR), 9, '0') src, 'Q' || size dst, '{{1' || CASE WHEN k % 2 = 0 THEN ',2' ELSE '' END || CASE WHEN k % 3 = 0 THEN ',3' ELSE '' END || '}}' witnesses, CAST(1 + (k % 2 = 0)::INT + (k % 3 = 0)::INT AS BIGINT) wp_count FROM p",
    "order_faults": f"WITH {PARTS}, v AS (SELECT k, CASE WHEN k % 10 = 5 THEN k - 2 WHEN k % 10 = 8 THEN k - 1 ELSE k END v FROM p), w AS (SELECT v <= lag(v) OVER (ORDER BY k) bad FROM v) SELECT 'en' lang, count(*) FILTER (bad) faults FROM w",
    "counts_last": f"WITH {PARTS} SELECT {_LINE} AS value FROM p",
    "counted_lines": f"WITH {PARTS} SELECT CAST(CASE WHEN k % 2 = 0 THEN size END AS BIGINT) n, CASE k % 4 WHEN 0 THEN 'Q' || k || ' Q1' WHEN 1 THEN 'Q' || k || '  Q2' WHEN 2 THEN 'a b ' || k || chr(9) || 'c d' ELSE 'x ' || k || chr(9) || 'y' || chr(9) || 'z w' END rest FROM p",
    "text_exchange": f"""WITH {PARTS} SELECT 'Q' || k || ',' || CASE k % 4 WHEN 0 THEN '"' || name || ', ' || k || '"' WHEN 1 THEN '"say ""' || name || '""' || '"' ELSE name END || ',' || k % 7 AS line FROM p""",
    "csv_quoted": f"""WITH {PARTS} SELECT k, CASE k % 5 WHEN 0 THEN '"' || name || ',' || k || '"' WHEN 1 THEN '"' || '""' || name || '"' WHEN 2 THEN '"' || name || chr(10) || k || '"' WHEN 3 THEN '' ELSE name END quoted FROM p""",
}


# ---- resolution


def _cascade(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Links that take every branch of the cascade, once for each part; labels, redirects and media for them."""
    p = _parts(spark, sf)
    label = lambda lang, text, qid: p.selectExpr(f"'{lang}' lang", f"concat({text}) label", f"concat({qid}) qid")
    labels = _union(
        label("en", "'T', k", "'Q', k"), label("en", "'S p ', k", "'Q1', k"), label("de", "'D ', k", "'Q2', k"), label("mul", "'M ', k", "'Q3', k"), label("mul", "'M ', k", "'Q4', k").where("try_cast(substring(label, 3) AS int) % 2 = 0"),
        label("best", "'Best ', k", "'Q5', k"), label("doi", "'10.1/', k", "'Q6', k"),
    )
    hop = lambda a, b: p.selectExpr("'en' lang", f"concat({a}) title", f"concat({b}) target")
    redirects = _union(hop("'R1 ', k", "'T', k"), hop("'R2 ', k", "'R1 ', k"), hop("'R3 ', k", "'t', k"), hop("'L ', k", "'L ', k"), hop("'X0 ', k", "'X1 ', k"), hop("'X1 ', k", "'X2 ', k"), hop("'X2 ', k", "'X3 ', k"), hop("'X3 ', k", "'X4 ', k"), hop("'X4 ', k", "'X5 ', k"), hop("'X5 ', k", "'T', k"))
    media = p.selectExpr("concat('pic ', k, '.png') filename")
    targets = [
        "'T', k", "'t', k", "'R1 ', k", "'r2 ', k", "'R3 ', k", "'S_p&nbsp;', k", "'x:File:pic ', k, '.png'", "':pic ', k, '.png'", "'d:q', k", "'de:D ', k", "'de:d ', k", "'doi:10.1/', k", "'M ', k", "'m ', k", "'best ', k", "'Wikt:w ', k", "'none ', k",
        "'tab\t', repeat('z', 300 + k % 200)", "'L ', k", "'X0 ', k",
    ]
    # the table may come in one task, but each row becomes many links
    links = S.dealt(p, "k").select(F.expr("CASE WHEN k % 17 = 0 THEN concat('U ', k) ELSE concat(' T', k) END").alias("title"), F.explode(F.array(*[F.expr(f"concat({t})") for t in targets])).alias("target")).withColumn("lang", F.lit("en"))
    return links, labels, redirects, media


def q_cascade(spark, sf):
    rows, _ = R.resolve(*_cascade(spark, sf))
    return _wide(rows.groupBy("title", "src", "target", "dst", "method", "stream").agg(F.count("*").alias("n")))


def q_cascade_anomalies(spark, sf):
    _, odd = R.resolve(*_cascade(spark, sf))
    return odd


def q_cascade_files(spark, sf):
    """The nine per-language streams as files, read again: lines by stream."""
    rows, odd = R.resolve(*_cascade(spark, sf))
    base = scratch(spark)
    R.write_streams(rows, odd, base)
    return R.read_streams(spark, base).groupBy("stream", "lang").agg(F.count("*").alias("n"))


def q_cascade_failed(spark, sf):
    rows, _ = R.resolve(*_cascade(spark, sf))
    return R.stream_rows(rows, "failed")


def q_cascade_counters(spark, sf):
    rows, _ = R.resolve(*_cascade(spark, sf))
    return R.stream_counts(rows)


def q_witness_methods(spark, sf):
    rows, _ = R.resolve(*_cascade(spark, sf))
    return _wide(R.witness_methods(rows))


def q_invariants(spark, sf):
    """Violations of each invariant: none in what the engine makes, all in rows that were spoilt. Every rule reads the rows, so they are made once."""
    links, labels, redirects, media = _cascade(spark, sf)
    rows = _kept(R.resolve(links, labels, redirects, media)[0])
    own = links.select("lang", T.utrim(F.col("title")).alias("title"), T.utrim(F.col("target")).alias("target"))
    methods, converted = R.witness_methods(rows), R.stream_rows(rows, "converted")
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
    graph = G.witness_links(_parts(spark, sf).selectExpr("cast(k % 3 AS smallint) lang_id", "concat('Q', k) src", "'Q1' dst"))
    spoilt = graph.withColumn("wp_count", F.col("wp_count") + 1)
    return _union(
        n("lost links", G.lost_links(own, rows)), n("lost links, spoilt", G.lost_links(own, rows.where("stream != 'failed'"))), n("streams overlap", G.overlapping_streams(rows)), n("streams overlap, spoilt", G.overlapping_streams(rows.unionByName(rows.where("stream = 'wikt'").withColumn("stream", F.lit("mul"))))),
        n("methods without link", G.methods_without_link(methods, converted)), n("methods without link, spoilt", G.methods_without_link(methods, converted.where("src != 'Q1'"))), n("witnesses", G.bad_witnesses(graph)), n("witnesses, spoilt", G.bad_witnesses(spoilt)),
    )


def q_mul_statistics(spark, sf):
    return _wide(R.mul_statistics(_cascade(spark, sf)[1]))


def q_single_redirects(spark, sf):
    o = _t(spark, sf, "orders").selectExpr("'en' lang", "concat('C', o_custkey) title", "concat('T', o_orderkey) target")
    return R.one_redirect(o)


_FOUND = """links AS (SELECT k, CASE WHEN k % 17 = 0 THEN 'U ' || k ELSE 'T' || k END title, CASE WHEN k % 17 = 0 THEN NULL ELSE 'Q' || k END src, unnest([
 {'t': 'T' || k, 'd': 'Q' || k, 'm': NULL, 's': 'converted'}, {'t': 't' || k, 'd': 'Q' || k, 'm': NULL, 's': 'converted'}, {'t': 'R1 ' || k, 'd': 'Q' || k, 'm': NULL, 's': 'converted'}, {'t': 'r2 ' || k, 'd': 'Q' || k, 'm': 1, 's': 'converted'},
 {'t': 'R3 ' || k, 'd': 'Q' || k, 'm': NULL, 's': 'converted'}, {'t': 'S_p&nbsp;' || k, 'd': 'Q1' || k, 'm': NULL, 's': 'converted'}, {'t': 'x:File:pic ' || k || '.png', 'd': 'pic ' || k || '.png', 'm': NULL, 's': 'commons'}, {'t': ':pic ' || k || '.png', 'd': 'pic ' || k || '.png', 'm': NULL, 's': 'commons'},
 {'t': 'd:q' || k, 'd': 'Q' || k, 'm': 2, 's': 'converted'}, {'t': 'de:D ' || k, 'd': 'Q2' || k, 'm': 3, 's': 'converted'}, {'t': 'de:d ' || k, 'd': 'Q2' || k, 'm': 3, 's': 'converted'}, {'t': 'doi:10.1/' || k, 'd': 'Q6' || k, 'm': 3, 's': 'converted'},
 {'t': 'M ' || k, 'd': 'Q3' || k, 'm': NULL, 's': CASE WHEN k % 2 = 0 THEN 'mul_ambiguous' ELSE 'mul' END}, {'t': 'm ' || k, 'd': 'Q3' || k, 'm': NULL, 's': CASE WHEN k % 2 = 0 THEN 'mul_ambiguous' ELSE 'mul' END}, {'t': 'best ' || k, 'd': 'Q5' || k, 'm': NULL, 's': 'best'},
 {'t': 'Wikt:w ' || k, 'd': NULL, 'm': NULL, 's': 'wikt'}, {'t': 'none ' || k, 'd': NULL, 'm': NULL, 's': 'failed'}, {'t': 'tab' || chr(9) || repeat('z', 300 + k % 200), 'd': NULL, 'm': NULL, 's': 'failed'}, {'t': 'L ' || k, 'd': NULL, 'm': NULL, 's': 'failed'}, {'t': 'X0 ' || k, 'd': NULL, 'm': NULL, 's': 'failed'}]) x FROM p),
 r AS (SELECT k, title, src, x.t target, CASE WHEN src IS NOT NULL THEN x.d END dst, CASE WHEN src IS NOT NULL THEN CAST(x.m AS BIGINT) END AS method, CASE WHEN src IS NULL THEN 'src_not_found' ELSE x.s END stream FROM links)"""
_CASCADE = f"WITH {PARTS}, {_FOUND}"
ORACLES |= {
    "cascade": f"{_CASCADE} SELECT title, src, target, dst, method, stream, count(*) n FROM r GROUP BY ALL",
    "cascade_anomalies": f"{_CASCADE} SELECT 'en' lang, 'L ' || k title, 'cycle' kind FROM p WHERE k % 17 <> 0 UNION SELECT 'en', 'X0 ' || k, 'depth_exceeded' FROM p WHERE k % 17 <> 0",
    "cascade_files": f"{_CASCADE}, f AS (SELECT DISTINCT stream, src, CASE WHEN stream = 'failed' THEN target ELSE dst END x FROM r WHERE src IS NOT NULL AND stream <> 'wikt' AND (stream <> 'failed' OR length(target) <= 384)), every AS (SELECT stream FROM f UNION ALL SELECT 'src_not_found' FROM p WHERE k % 17 = 0 UNION ALL SELECT 'witness_methods' FROM (SELECT DISTINCT src, dst, method FROM r WHERE method IS NOT NULL) UNION ALL SELECT unnest(['redirect_anomalies', 'redirect_anomalies']) FROM p WHERE k % 17 <> 0) SELECT stream, 'en' lang, count(*) n FROM every GROUP BY 1",
    "cascade_failed": f"{_CASCADE} SELECT DISTINCT 'en' lang, src, replace(target, chr(9), ' ') target FROM r WHERE stream = 'failed' AND length(target) <= 384",
    "cascade_counters": f"{_CASCADE} SELECT 'en' lang, stream, count(*) n, count(*) FILTER (stream = 'failed' AND length(target) > 384) too_long FROM r GROUP BY ALL",
    "witness_methods": f"{_CASCADE} SELECT DISTINCT 'en' lang, src, dst, method FROM r WHERE method IS NOT NULL",
    "invariants": f"{_CASCADE}, d AS (SELECT DISTINCT title, target FROM r WHERE stream = 'wikt') SELECT unnest(['lost links', 'streams overlap', 'methods without link', 'witnesses']) rule, CAST(0 AS BIGINT) n UNION ALL SELECT 'lost links, spoilt', 1 UNION ALL SELECT 'streams overlap, spoilt', count(*) FROM d UNION ALL SELECT 'methods without link, spoilt', count(*) FROM (SELECT DISTINCT src, dst, method FROM r WHERE method IS NOT NULL AND src = 'Q1') UNION ALL SELECT 'witnesses, spoilt', count(*) FROM p",
    "mul_statistics": f"WITH {PARTS} SELECT count(*) n, count(*) FILTER (k % 2 = 0) shared, round(100.0 * count(*) FILTER (k % 2 = 0) / count(*), 2)::DOUBLE pct FROM p",
    "single_redirects": "SELECT 'en' lang, 'C' || o_custkey title, min('T' || o_orderkey) target FROM orders GROUP BY ALL",
}


# ---- loads, languages, text helpers


def _staged(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Rows for each diagnostic table: good, repeated, and bad in each way its checks know."""
    p = _parts(spark, sf).withColumn("lang", F.expr("concat('l', chr(97 + k % 5))"))
    twice = p.unionByName(p)
    src = "CASE WHEN k % 10 = 1 THEN concat('x', k) WHEN k % 10 = 2 THEN concat('Q', 10000000000 + k) ELSE concat('Q', k) END"
    title = "CASE WHEN k % 10 = 3 THEN '' WHEN k % 10 = 4 THEN repeat('t', 385) ELSE concat(name, ' ', k) END"
    return {
        "obs_conv_failures": twice.selectExpr("lang", f"{src} src", f"{title} target"),
        "obs_src_not_found": twice.selectExpr("lang", f"{title} title"),
        "obs_redirect_anomalies": twice.selectExpr("lang", f"{title} title", "CASE k % 10 WHEN 5 THEN 'odd' WHEN 6 THEN 'depth_exceeded' ELSE 'cycle' END kind"),
        "wp_witness_methods": twice.selectExpr("lang", f"{src} src", "'Q1' dst", "cast(CASE WHEN k % 10 = 7 THEN 9 ELSE k % 3 + 1 END AS smallint) method"),
    }


def q_load_reports(spark, sf):
    return _union(*[G.load_report(name, rows).withColumn("table", F.lit(name)) for name, rows in _staged(spark, sf).items()])


def q_loaded(spark, sf):
    """Rows of each table after a load that makes the languages it lacks."""
    known = spark.createDataFrame([(1, "lb"), (7, "ld")], "id smallint, code string")
    out = []
    for name, rows in _staged(spark, sf).items():
        own, langs = G.loaded_with_languages(name, rows, known)
        out.append(own.groupBy("lang_id").agg(F.count("*").alias("n")).withColumn("table", F.lit(name)))
        known = langs
    return _wide(_union(*out))


def q_replaced_table(spark, sf):
    """A table loaded twice: the second load replaces the first, its key is checked, and spoilt rows leave it as it was."""
    p, base = _parts(spark, sf), scratch(spark)
    G.replace_table(spark, base, "wd_entities", p.selectExpr("concat('Q', k) qid", "name best_label", "1 wp_count"))
    G.replace_table(spark, base, "wd_entities", p.where("k % 2 = 0").selectExpr("concat('Q', k) qid", "name best_label", "2 wp_count"))
    try:
        G.replace_table(spark, base, "wd_entities", p.selectExpr("'Q1' qid", "name best_label", "3 wp_count"))
    except ValueError:
        pass
    return _wide(G.read_table(spark, base, "wd_entities"))


def q_catalogue(spark, sf):
    """Every table made twice in one place; tables that hold rows keep them."""
    base = scratch(spark)
    G.create_tables(spark, base)
    G.replace_table(spark, base, "languages", _t(spark, sf, "nation").selectExpr("cast(n_nationkey + 1 AS smallint) id", "n_name code"))
    G.create_tables(spark, base)
    names = ["languages", "wd_links", "wp_links", "resolution_methods"]
    return _union(*[G.read_table(spark, base, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n in names])


def q_label_chain(spark, sf):
    """Codes of the registry kept by an override, and the chain of label languages: the registry holds all nations."""
    codes = [r.n_name for r in _t(spark, sf, "nation").orderBy("n_nationkey").collect()]
    registry = {"wikipedia": codes, "wiktionary": codes[:3], "dbpedia": [], "wikipedia_no_export": ["kl"]}
    chain = L.label_chain(registry, {"wikipedia": codes[::2]})
    return spark.createDataFrame([(i, c) for i, c in enumerate(chain)], "place bigint, code string")


def q_index_pages(spark, sf):
    """What the parsers of index pages find in a page that names every nation."""
    n = _t(spark, sf, "nation").orderBy("n_nationkey").collect()
    page = "".join(f'<a href="{chr(97 + r.n_nationkey % 26)}{chr(97 + r.n_regionkey)}{"wiki" if r.n_nationkey % 2 else "wiktionary"}/">x</a>' for r in n) + '<a href="simplewiki/">x</a><a href="Badwiki/">x</a><a href="x1wiki/">x</a>'
    dates = "".join(f'<a href="20{r.n_nationkey:02d}-01-0{r.n_regionkey + 1}/">x</a><a href="20{r.n_nationkey:02d}0101/">y</a>' for r in n)
    resource = "".join(f'<a href="?lang={chr(97 + r.n_nationkey % 26)}{chr(97 + r.n_regionkey)}&x">' for r in n) + '<a href="?lang%3Dzh-yue">'
    found = [("wikipedia", c) for c in L.with_suffix(L.wiki_ids(page), "wiki")] + [("wiktionary", c) for c in L.with_suffix(L.wiki_ids(page), "wiktionary")]
    found += [("newest", L.export_dates(dates)[0]), ("oldest", L.export_dates(dates)[-1])] + [("resource", c) for c in L.resource_languages(resource)]
    return spark.createDataFrame(found, "kind string, code string")


def q_property_classes(spark, sf):
    d = P.dimension(spark)
    flags = ["is_causal", "is_start", "is_end", "is_time", "is_dated", "is_unspecific"]
    return d.select(F.explode(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags])).alias("class")).where("class IS NOT NULL").groupBy("class").agg(F.count("*").alias("n"))


def q_refreshed(spark, sf):
    """The counts of failed targets, made anew from a table that was loaded twice."""
    base = scratch(spark)
    rows = _parts(spark, sf).selectExpr("cast(k % 3 AS smallint) lang_id", "concat('Q', k) src", "name target")
    for part in (rows.limit(1), rows):
        G.replace_table(spark, base, "obs_conv_failures", part)
        G.refresh_failed_targets(spark, base)
    return G.read_table(spark, base, "obs_failed_targets")


def q_titles(spark, sf):
    """Every helper of titles and targets, over a value of its own for each part."""
    raw = F.expr("concat(CASE k % 8 WHEN 0 THEN '  ' WHEN 1 THEN 'File:' WHEN 2 THEN 'category:' WHEN 3 THEN ':' WHEN 4 THEN 'é' WHEN 5 THEN 'Q' WHEN 6 THEN 'foo_&nbsp;' ELSE 'WP:' END, CASE WHEN k % 8 = 5 THEN '' ELSE name END, ' ', k, CASE WHEN k % 3 = 0 THEN chr(160) ELSE '' END)")
    x = F.col("raw")
    return _parts(spark, sf).select("k", raw.alias("raw")).select(
        "k", T.link_target(x).alias("target"), T.template_name(x).alias("template"), T.spaced(x).alias("spaced"), T.capfirst(x).alias("capital"), T.is_qid(F.replace(x, F.lit(" "), F.lit(""))).alias("qid"), F.char_length(T.diagnostic(F.repeat(x, 20))).cast("bigint").alias("diagnostic"),
        T.last_segment(F.concat(F.lit("http://e/"), x)).alias("segment"), T.is_language_code(F.concat(F.lit("a"), F.substring("raw", 1, 1))).alias("code"), T.before_colon(x).alias("prefix"), T.after_colon(x).alias("suffix"),
    )


_RAW = "CASE k % 8 WHEN 0 THEN '  ' WHEN 1 THEN 'File:' WHEN 2 THEN 'category:' WHEN 3 THEN ':' WHEN 4 THEN 'é' WHEN 5 THEN 'Q' WHEN 6 THEN 'foo_&nbsp;' ELSE 'WP:' END || CASE WHEN k % 8 = 5 THEN '' ELSE name END || ' ' || k || CASE WHEN k % 3 = 0 THEN chr(160) ELSE '' END"
_STAGED = f"""{PARTS}, s AS (SELECT k, 'l' || chr(CAST(97 + k % 5 AS INT)) lang, k % 10 NOT IN (1, 2) src_ok, k % 10 NOT IN (3, 4) title_ok, k % 10 m FROM p),
 g AS (SELECT 'obs_conv_failures' AS "table", *, src_ok AND title_ok ok FROM s UNION ALL SELECT 'obs_src_not_found', *, title_ok FROM s UNION ALL SELECT 'obs_redirect_anomalies', *, title_ok AND m <> 5 FROM s UNION ALL SELECT 'wp_witness_methods', *, src_ok AND m <> 7 FROM s)"""
ORACLES |= {
    "load_reports": f'WITH {_STAGED} SELECT "table", lang, 2 * count(*) staged, count(*) FILTER (ok) inserted, 2 * count(*) FILTER (NOT ok) rejected FROM g GROUP BY ALL',
    "loaded_tables": f"""WITH {_STAGED}, l AS (SELECT 'lb' lang, 1 id UNION ALL SELECT 'ld', 7 UNION ALL SELECT 'la', 8 UNION ALL SELECT 'lc', 9 UNION ALL SELECT 'le', 10) SELECT "table", CAST(id AS BIGINT) lang_id, count(*) n FROM g JOIN l USING (lang) WHERE ok GROUP BY ALL""",
    "replaced_table": f"WITH {PARTS} SELECT 'Q' || k qid, name best_label, CAST(2 AS BIGINT) wp_count FROM p WHERE k % 2 = 0",
    "catalogue": "SELECT 'languages' AS \"table\", (SELECT count(*) FROM nation) n UNION ALL SELECT 'wd_links', 0 UNION ALL SELECT 'wp_links', 0 UNION ALL SELECT 'resolution_methods', 3",
    "refreshed_targets": "SELECT p_name target, count(DISTINCT p_partkey % 3) n_langs, count(*) n_pairs FROM part GROUP BY 1",
    "label_chain": "WITH c AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 place, n_name code FROM nation WHERE n_nationkey % 2 = 0) SELECT place, code FROM c UNION ALL SELECT (SELECT count(*) FROM c) + i, x FROM (SELECT unnest([0, 1, 2, 3]) i, unnest(['kl', 'mul', 'doi', 'best']) x)",
    "index_pages": """WITH c AS (SELECT *, chr(97 + n_nationkey % 26) || chr(97 + n_regionkey) code FROM nation) SELECT 'wikipedia' kind, code FROM c WHERE n_nationkey % 2 = 1 UNION SELECT 'wikipedia', 'simple' UNION SELECT 'wiktionary', code FROM c WHERE n_nationkey % 2 = 0 UNION SELECT 'resource', code FROM c UNION SELECT 'resource', 'zh-yue'
 UNION ALL SELECT 'newest', max(d) FROM (SELECT '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '0101' d FROM nation UNION SELECT '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '-01-0' || (n_regionkey + 1) FROM nation)
 UNION ALL SELECT 'oldest', min(d) FROM (SELECT '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '0101' d FROM nation UNION SELECT '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '-01-0' || (n_regionkey + 1) FROM nation)""",
    "property_classes": "SELECT unnest(['is_causal', 'is_start', 'is_end', 'is_time', 'is_dated', 'is_unspecific']) AS class, CAST(unnest([49, 12, 9, 72, 8, 6]) AS BIGINT) n",
    "titles": f"""WITH {PARTS}, x AS (SELECT k, name, {_RAW} raw FROM p), y AS (SELECT *, regexp_replace(raw, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') bare FROM x) SELECT k, CASE WHEN k % 8 IN (1, 2, 7) THEN NULL ELSE bare END target, trim(regexp_replace(lower(raw), '[\\s_\\x{{00A0}}]+', ' ', 'g')) AS template,
 replace(replace(raw, '&nbsp;', ' '), '_', ' ') spaced, CASE k % 8 WHEN 2 THEN 'C' || raw[2:] WHEN 4 THEN 'É' || raw[2:] WHEN 6 THEN 'F' || raw[2:] ELSE raw END capital, k % 8 = 5 qid, CAST(CASE WHEN 20 * length(raw) <= 384 THEN 20 * length(raw) END AS BIGINT) diagnostic, raw segment, k % 8 IN (2, 6) AS code,
 CASE k % 8 WHEN 1 THEN 'File' WHEN 2 THEN 'category' WHEN 3 THEN '' WHEN 7 THEN 'WP' ELSE raw END AS prefix, CASE WHEN k % 8 IN (1, 2, 3, 7) THEN raw[instr(raw, ':') + 1:] ELSE raw END suffix FROM y""",
}

QUERIES = {
    "json_lines": q_json_lines, "entity_labels": q_entity_labels, "entity_items": q_entity_items, "entity_edges": q_entity_edges, "entity_dates": q_entity_dates, "entity_coordinates": q_entity_coordinates,
    "lexeme_words": q_lexeme_words, "lexeme_links": q_lexeme_links, "sense_links": q_sense_links, "object_labels": q_object_labels, "function_objects": q_objects,
    "page_scan": q_page_scan, "page_links": q_page_links, "dictionary_links": q_dictionary_links, "template_families": q_template_families, "delta_summary": q_delta_summary, "delta_limited": q_delta_limited, "top_templates": q_top_templates,
    "media_titles": q_media_titles, "triples_scan": q_triples, "resource_links": q_resource_links, "tab_files": q_tab_files, "streams_merged": q_streams_merged, "order_faults": q_order_faults, "counts_last": q_counts_last, "counted_lines": q_counted_lines,
    "text_exchange": q_text_exchange, "csv_quoted": q_csv_quoted, "cascade": q_cascade, "cascade_anomalies": q_cascade_anomalies, "cascade_files": q_cascade_files, "cascade_failed": q_cascade_failed, "cascade_counters": q_cascade_counters,
    "witness_methods": q_witness_methods, "invariants": q_invariants, "mul_statistics": q_mul_statistics, "single_redirects": q_single_redirects, "load_reports": q_load_reports, "loaded_tables": q_loaded, "replaced_table": q_replaced_table,
    "catalogue": q_catalogue, "refreshed_targets": q_refreshed, "label_chain": q_label_chain, "index_pages": q_index_pages, "property_classes": q_property_classes, "titles": q_titles,
}
