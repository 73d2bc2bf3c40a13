"""What entity, lexeme, object and abstract-text records hold, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import properties as P
from ..functions.text import is_encyclopedia, last_segment, object_label

_SNAK = "struct<datatype:string,datavalue:struct<value:string>>"
_CLAIMS = f"map<string,array<struct<mainsnak:{_SNAK},qualifiers:map<string,array<{_SNAK}>>>>>"
_VALUE = "struct<value:string>"
ENTITY = {"labels": f"map<string,{_VALUE}>", "sitelinks": "map<string,struct<title:string>>", "claims": _CLAIMS}
LEXEME = f"struct<id:string,lemmas:map<string,{_VALUE}>,claims:{_CLAIMS},forms:array<struct<representations:map<string,{_VALUE}>>>,senses:array<struct<id:string,claims:{_CLAIMS}>>>"


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Empty maps are written as [] in dumps; they parse as null and count as empty. Each line is parsed once: inline keeps the filter behind it."""
    return lines.select(F.inline(F.array(F.from_json(F.col("value"), schema)))).where("id IS NOT NULL")


def entities(lines: DataFrame, *fields: str) -> DataFrame:
    """id and fields of ENTITY, all of them where none is named; what is not named is passed over in parsing."""
    return _parsed(lines, f"struct<id:string,{','.join(f'{k}:{ENTITY[k]}' for k in fields or ENTITY)}>")


def lexemes(lines: DataFrame) -> DataFrame:
    return _parsed(lines, LEXEME)


def _field(value: Column, path: str) -> Column:
    return F.get_json_object(value, f"$.{path}")


def sitelink_labels(e: DataFrame, chain: list[str]) -> DataFrame:
    """lang, label, qid of encyclopedia titles in the chain's languages."""
    return e.select(F.inline(_sitelink_labels(chain)), F.col("id").alias("qid"))


def _sitelink_labels(chain: list[str]) -> Column:
    sites = [c + "wiki" for c in chain if c not in ("mul", "doi", "best")]
    own = F.filter(F.map_entries("sitelinks"), lambda s: s["key"].isin(sites) & s["value"]["title"].isNotNull())
    return _full(F.transform(own, lambda s: F.struct(F.regexp_replace(s["key"], "wiki$", "").alias("lang"), s["value"]["title"].alias("label"))), "lang string, label string")


def _full(rows: Column, kind: str) -> Column:
    """Rows of an array, none where it is null; kind: their fields."""
    return F.coalesce(rows, F.array().cast(f"array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>"))


def _first_along(order: tuple[str, ...], get) -> list[Column]:
    return [get(c) for c in order]


def best_label(order: tuple[str, ...] = P.LABEL_ORDER) -> Column:
    """First title along the order, the label for all languages, first label along the order, that of the smallest code, the id."""
    title = lambda c: F.col("sitelinks")[c + "wiki"]["title"]
    label = lambda c: F.col("labels")[c]["value"]
    rest = F.array_sort(F.filter(F.map_entries("labels"), lambda x: x["value"]["value"].isNotNull()))
    return F.coalesce(*_first_along(order, title), label("mul"), *_first_along(order, label), F.get(rest, F.lit(0))["value"]["value"], F.col("id"))


def doi_label() -> Column:
    own = F.filter(F.transform(F.col("claims")["P356"], lambda c: c["mainsnak"]["datavalue"]["value"]), lambda v: v.isNotNull() & ~v.startswith("{"))
    return F.get(own, F.lit(0))


def labels(e: DataFrame, chain: list[str], order: tuple[str, ...] = P.LABEL_ORDER) -> DataFrame:
    """lang, label, qid of every kind, once each."""
    named = lambda kind, value: F.struct(F.lit(kind).alias("lang"), value.alias("label"))
    rows = F.concat(_sitelink_labels(chain), F.array(named("mul", F.col("labels")["mul"]["value"]), named("doi", doi_label()), named("best", best_label(order))))
    return e.select(F.inline(rows), F.col("id").alias("qid")).where("label IS NOT NULL").distinct()


def sitelink_count() -> Column:
    return F.size(F.filter(F.map_keys(F.coalesce("sitelinks", F.expr("cast(map() as map<string,struct<title:string>>)"))), is_encyclopedia)).cast("int")


def entity_rows(e: DataFrame, order: tuple[str, ...] = P.LABEL_ORDER) -> DataFrame:
    return e.select(F.col("id").alias("qid"), best_label(order).alias("best_label"), sitelink_count().alias("wp_count"))


def statements(e: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """id, prop, mainsnak, qualifiers of each claim."""
    by_prop = e.select(*keep, F.explode(F.map_entries("claims")).alias("c"))
    return by_prop.select(*keep, F.col("c.key").alias("prop"), F.explode("c.value").alias("s")).select(*keep, "prop", "s.*")


_QUALIFIER = f"array<struct<qprop:string,snak:{_SNAK}>>"


def qualifiers() -> Column:
    """array<struct<qprop, snak>> of the qualifiers of a statement."""
    none = F.array().cast(_QUALIFIER)
    each = F.transform(F.map_entries("qualifiers"), lambda q: F.coalesce(F.transform(q["value"], lambda x: F.struct(q["key"].alias("qprop"), x.alias("snak"))), none))
    return F.coalesce(F.flatten(each), none)


def _target(snak: Column) -> Column:
    return F.when(snak["datatype"].isin("wikibase-item", "wikibase-property"), _field(snak["datavalue"]["value"], "id"))


def edges(e: DataFrame) -> DataFrame:
    """src, dst, prop of claims and of their qualifiers (under the qualifier's property), once each; ranks play no part."""
    own = F.array(F.struct(F.col("prop").alias("qprop"), F.col("mainsnak").alias("snak")))
    snaks = statements(e).select(F.col("id").alias("src"), F.inline(F.concat(own, qualifiers())))
    return snaks.select("src", _target(F.col("snak")).alias("dst"), F.col("qprop").alias("prop")).where("dst IS NOT NULL").distinct()


def _dated(snak: Column) -> tuple[Column, Column]:
    value = snak["datavalue"]["value"]
    return _field(value, "time"), _field(value, "precision").try_cast("smallint")


def dates(e: DataFrame) -> DataFrame:
    """qid, property, time_value, precision, source_property, source_target: of claims, and of qualifiers of times and dated statements."""
    none = F.lit("")
    # a claim stands beside its qualifiers, but has no source
    own = F.array(F.struct(F.col("prop").alias("qprop"), F.col("mainsnak").alias("snak"), none.alias("source_property"), none.alias("source_target")))
    source = F.coalesce(_target(F.col("mainsnak")), none)
    more = F.transform(qualifiers(), lambda q: F.struct(q["qprop"].alias("qprop"), q["snak"].alias("snak"), F.col("prop").alias("source_property"), source.alias("source_target")))
    # TIMES_AND_DATED has all of TIMES
    snaks = statements(e).where(F.col("prop").isin(list(P.TIMES_AND_DATED))).select(F.col("id").alias("qid"), F.inline(F.concat(own, more))).where(F.col("qprop").isin(list(P.TIMES)))
    time, precision = _dated(F.col("snak"))
    rows = snaks.select("qid", F.col("qprop").alias("property"), time.alias("time_value"), precision.alias("precision"), "source_property", "source_target")
    return rows.where("time_value IS NOT NULL AND precision IS NOT NULL AND octet_length(time_value) <= 32").distinct()


def coordinates(e: DataFrame) -> DataFrame:
    """qid, latitude, longitude, altitude, precision, globe; one row a key."""
    value = F.col("mainsnak.datavalue.value")
    number = lambda name: _field(value, name).try_cast("double").alias(name)
    rows = statements(e).where("prop = 'P625'").select(F.col("id").alias("qid"), number("latitude"), number("longitude"), number("altitude"), number("precision"), F.coalesce(last_segment(_field(value, "globe")), F.lit("")).alias("globe"))
    return distinct_coordinates(rows.where("latitude IS NOT NULL AND longitude IS NOT NULL"))


def distinct_coordinates(rows: DataFrame) -> DataFrame:
    """Of rows with one key, the least (altitude, precision), nulls last. Partial minima before the shuffle."""
    own = F.struct(F.col("altitude").isNull().alias("a"), F.col("altitude"), F.col("precision").isNull().alias("p"), F.col("precision"))
    best = rows.groupBy("qid", "latitude", "longitude", "globe").agg(F.min(own).alias("b"))
    return best.select("qid", "latitude", "longitude", F.col("b.altitude").alias("altitude"), F.col("b.precision").alias("precision"), "globe")


# ---- lexemes


def lemmas(x: DataFrame) -> DataFrame:
    return x.select(F.explode(F.map_entries("lemmas")).alias("m"), F.col("id").alias("lid")).select(F.col("m.key").alias("lang"), F.col("m.value.value").alias("lemma"), "lid").where("lemma IS NOT NULL").distinct()


def forms(x: DataFrame) -> DataFrame:
    each = x.select(F.explode("forms").alias("f"), F.col("id").alias("lid")).select(F.explode(F.map_entries("f.representations")).alias("m"), "lid")
    return each.select(F.col("m.key").alias("lang"), F.col("m.value.value").alias("lemma"), "lid").where("lemma IS NOT NULL").distinct()


def words(x: DataFrame) -> DataFrame:
    """lang, lemma, lid, kind (lemma or form), once each."""
    made = f"array<struct<kind:string,m:array<struct<key:string,value:{_VALUE}>>>>"
    own = F.array(F.struct(F.lit("lemma").alias("kind"), F.map_entries("lemmas").alias("m")))
    more = F.transform("forms", lambda f: F.struct(F.lit("form").alias("kind"), F.map_entries(f["representations"]).alias("m")))
    each = x.select(F.col("id").alias("lid"), F.inline(F.concat(own, F.coalesce(more, F.array().cast(made))))).select("lid", "kind", F.explode("m").alias("m"))
    return each.select(F.col("m.key").alias("lang"), F.col("m.value.value").alias("lemma"), "lid", "kind").where("lemma IS NOT NULL").distinct()


def _claimed(s: DataFrame, props: frozenset[str]) -> DataFrame:
    return s.where(F.col("prop").isin(list(props))).withColumn("dst", _field(F.col("mainsnak.datavalue.value"), "id")).where("dst IS NOT NULL")


def lexeme_lexeme(x: DataFrame) -> DataFrame:
    return _claimed(statements(x), P.LEXEME_TO_LEXEME).where("startswith(dst, 'L')").select(F.col("id").alias("src"), "dst", "prop").distinct()


def lexeme_item(x: DataFrame) -> DataFrame:
    return _claimed(statements(x), P.LEXEME_TO_ITEM).where("startswith(dst, 'Q')").select(F.col("id").alias("lid"), F.col("dst").alias("qid"), "prop").distinct()


def _either(s: DataFrame, links: tuple[frozenset[str], Column, str], items: tuple[frozenset[str], Column, str]) -> DataFrame:
    """Claims of two sorts (properties, what their dst must be, kind); a claim may be of both."""
    kinds = F.array_compact(F.array(*[F.when(F.col("prop").isin(list(props)) & ok, F.lit(kind)) for props, ok, kind in (links, items)]))
    return _claimed(s, links[0] | items[0]).withColumn("kind", F.explode(kinds))


def lexeme_links(x: DataFrame) -> DataFrame:
    """src, dst, prop, kind (lexeme or item) of lexeme_lexeme() and lexeme_item() in one pass."""
    dst = F.col("dst")
    rows = _either(statements(x), (P.LEXEME_TO_LEXEME, dst.startswith("L"), "lexeme"), (P.LEXEME_TO_ITEM, dst.startswith("Q"), "item"))
    return rows.select(F.col("id").alias("src"), "dst", "prop", "kind").distinct()


def sense_links(x: DataFrame) -> DataFrame:
    """src_lid, src_sid, dst_lid (empty for items), dst_sid, prop of sense_sense() and sense_item() in one pass."""
    dst = F.col("dst")
    rows = _either(_senses(x), (P.SENSE_TO_SENSE, dst.contains("-"), "sense"), (P.SENSE_TO_ITEM, dst.startswith("Q"), "item"))
    to = F.when(F.col("kind") == "sense", F.split_part("dst", F.lit("-"), F.lit(1))).otherwise("")
    return rows.select(F.col("lid").alias("src_lid"), F.col("id").alias("src_sid"), to.alias("dst_lid"), F.col("dst").alias("dst_sid"), "prop", "kind").distinct().drop("kind")


def _senses(x: DataFrame) -> DataFrame:
    own = x.select(F.col("id").alias("lid"), F.explode("senses").alias("s")).select("lid", F.col("s.id").alias("id"), F.col("s.claims").alias("claims"))
    return statements(own, ("lid", "id"))


def sense_item(x: DataFrame) -> DataFrame:
    return _claimed(_senses(x), P.SENSE_TO_ITEM).where("startswith(dst, 'Q')").select(F.col("lid").alias("src_lid"), F.col("id").alias("src_sid"), "dst", "prop").distinct()


def sense_sense(x: DataFrame) -> DataFrame:
    found = _claimed(_senses(x), P.SENSE_TO_SENSE).where("contains(dst, '-')")
    return found.select(F.col("lid").alias("src_lid"), F.col("id").alias("src_sid"), F.split_part("dst", F.lit("-"), F.lit(1)).alias("dst_lid"), F.col("dst").alias("dst_sid"), "prop").distinct()


# ---- abstract texts and functions


def abstract_entries(pages: DataFrame) -> DataFrame:
    return pages.where("ns = 0").where(F.col("title").rlike("^Q[0-9]+$")).select(F.col("title").alias("qid")).distinct()


def abstract_refs(pages: DataFrame) -> DataFrame:
    own = pages.where("ns = 0").where(F.col("title").rlike("^Q[0-9]+$"))
    return own.select(F.col("title").alias("src_qid"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([QZ][0-9]+)"), F.lit(1)))).alias("ref")).distinct()


def objects(pages: DataFrame) -> DataFrame:
    return pages.where("ns = 0").where(F.col("title").rlike("^Z[0-9]+$")).select(F.col("title").alias("zid"), "text")


def bad_objects(pages: DataFrame) -> DataFrame:
    """zid of objects whose text is no JSON; they count as objects all the same."""
    return objects(pages).where(F.try_parse_json("text").isNull()).select("zid")


def object_labels(pages: DataFrame) -> DataFrame:
    """zid, lang, kind (L label, A alias), label. Typed lists carry their type first."""
    own = objects(pages)
    after = lambda arr: F.when(F.size(arr) > 1, F.slice(arr, 2, F.size(arr)))
    array = lambda path: F.from_json(F.get_json_object("text", path), "array<string>")
    label = own.select("zid", F.explode(after(array("$.Z2K3.Z12K1"))).alias("x")).select("zid", F.get_json_object("x", "$.Z11K1").alias("lang"), F.lit("L").alias("kind"), F.get_json_object("x", "$.Z11K2").alias("label"))
    lists = own.select("zid", F.explode(after(array("$.Z2K4.Z32K1"))).alias("x")).select("zid", F.get_json_object("x", "$.Z31K1").alias("lang"), F.lit("A").alias("kind"), F.explode(after(F.from_json(F.get_json_object("x", "$.Z31K2"), "array<string>"))).alias("label"))
    return label.unionByName(lists).withColumn("label", object_label(F.col("label"))).where("lang IS NOT NULL AND label IS NOT NULL AND label != ''").distinct()


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key by a total order."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
