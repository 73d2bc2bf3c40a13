"""Driver queries: each shapes a relation out of the star-schema tables and calls the engine's own function on it. ORACLES has the same in
SQL for DuckDB; arrays appear as comma-joined text and counts as 64-bit integers on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import entities as E
from ..operators import graph as G
from ..operators import resolve as R
from ..operators import wikitext as X
from ..sources import readers as S
from ..sources import registry as L
from . import analysis as A
from . import record_queries as D


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """One row a line item: lang_id, src, dst and what the other relations need."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    part = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    rows = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        (F.col("c_nationkey") + 1).alias("lang_id"),
        F.concat(F.lit("Q"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("Q"), (F.substring("p_brand", 7, 9).cast("int") + 100000).cast("string")).alias("dst"),
        "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "o_orderpriority", "p_partkey", "p_name",
    )


BASE = """base AS (SELECT c_nationkey + 1 lang_id, 'Q' || l_suppkey src, 'Q' || (CAST(substr(p_brand, 7) AS INT) + 100000) dst, l_linenumber, l_quantity, l_returnflag, l_linestatus, o_orderpriority, p_partkey, p_name
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
edges AS (SELECT DISTINCT lang_id, src, dst FROM base),
wp_links AS (SELECT src, dst, list_sort(list(lang_id)) witnesses, count(*) wp_count FROM edges GROUP BY ALL),
wd_links AS (SELECT DISTINCT CASE WHEN l_linestatus = 'F' THEN dst ELSE src END src, CASE WHEN l_linestatus = 'F' THEN src ELSE dst END dst, CASE WHEN l_linenumber = 1 THEN 'P31' ELSE 'P' || l_linenumber END prop
 FROM base WHERE o_orderpriority = '1-URGENT' AND l_returnflag = 'R'),
wd_entities AS (SELECT DISTINCT 'Q' || s_suppkey qid, s_name best_label, s_nationkey wp_count FROM supplier UNION SELECT DISTINCT 'Q' || (CAST(substr(p_brand, 7) AS INT) + 100000), p_brand, 0 FROM part),
languages AS (SELECT n_nationkey + 1 id, n_name code FROM nation)"""


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf).select("lang_id", "src", "dst")


def wp_links(spark: SparkSession, sf: str) -> DataFrame:
    return G.witness_links(edges(spark, sf))


def wd_links(spark: SparkSession, sf: str) -> DataFrame:
    own = _base(spark, sf).where("o_orderpriority = '1-URGENT' AND l_returnflag = 'R'")
    back = F.col("l_linestatus") == "F"
    prop = F.when(F.col("l_linenumber") == 1, "P31").otherwise(F.concat(F.lit("P"), F.col("l_linenumber").cast("string")))
    return own.select(F.when(back, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(back, F.col("src")).otherwise(F.col("dst")).alias("dst"), prop.alias("prop")).distinct()


def wd_entities(spark: SparkSession, sf: str) -> DataFrame:
    a = _t(spark, sf, "supplier").select(F.concat(F.lit("Q"), F.col("s_suppkey").cast("string")).alias("qid"), F.col("s_name").alias("best_label"), F.col("s_nationkey").alias("wp_count"))
    b = _t(spark, sf, "part").select(F.concat(F.lit("Q"), (F.substring("p_brand", 7, 9).cast("int") + 100000).cast("string")).alias("qid"), F.col("p_brand").alias("best_label"), F.lit(0).alias("wp_count")).distinct()
    return a.union(b)


def languages(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "nation").select((F.col("n_nationkey") + 1).cast("smallint").alias("id"), F.col("n_name").alias("code"))


def few_links(spark: SparkSession, sf: str) -> DataFrame:
    return G.witness_links(_base(spark, sf).where("l_returnflag = 'N'").select("lang_id", "src", "dst"))


def failures(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf).where("l_returnflag = 'R'").select("lang_id", "src", F.col("p_name").alias("target")).distinct()


def _w(df: DataFrame) -> DataFrame:
    out = df
    for c in ("witnesses", "wd_props"):
        if c in df.columns:
            out = out.withColumn(c, A.flat(F.col(c)))
    return out.withColumns({c: F.col(c).cast("bigint") for c, t in out.dtypes if t in ("int", "smallint")})


def q_wp_not_wd(spark, sf):
    return _w(A.wp_not_wd(wp_links(spark, sf), wd_links(spark, sf)))


def q_common_item_type(spark, sf):
    out = A.common_item_type(wd_entities(spark, sf), wp_links(spark, sf), wd_links(spark, sf))
    return _w(out).withColumn("avg_wp_count", F.round("avg_wp_count", 3))


def q_witnesses_overlap(spark, sf):
    return _w(A.witnesses_overlap(wp_links(spark, sf), languages(spark, sf), ["NATION_3", "NATION_7"]))


def q_language_recall(spark, sf):
    return _w(A.language_recall(wp_links(spark, sf), 5, 12))


def q_failed_targets(spark, sf):
    return _w(G.failed_targets(failures(spark, sf)))


def q_missing_targets(spark, sf):
    return _w(A.missing_targets(G.failed_targets(failures(spark, sf)), 40))


def q_promotable(spark, sf):
    guesses = G.witness_links(_base(spark, sf).where("l_returnflag = 'A'").select("lang_id", "src", "dst"), "n")
    return _w(A.promotable_best_guesses(guesses, few_links(spark, sf), wd_links(spark, sf), 3))


def q_coverage(spark, sf):
    methods = _base(spark, sf).select("lang_id", "src", "dst", (F.col("l_linenumber") % 3 + 1).alias("method")).distinct()
    return _w(A.coverage_violations(methods, few_links(spark, sf), None))


def q_hubs(spark, sf):
    lost = _base(spark, sf).where("l_returnflag = 'A'").select("lang_id", F.col("p_name").alias("title")).distinct()
    return _w(A.unconnected_hubs(lost, failures(spark, sf), languages(spark, sf)))


def q_neighbours(spark, sf):
    return A.neighbours(wp_links(spark, sf), wd_links(spark, sf), "Q3")


def q_neighbour_links(spark, sf):
    return _w(A.neighbour_links(wp_links(spark, sf), "Q3"))


def q_neighbour_statements(spark, sf):
    return A.neighbour_statements(wd_links(spark, sf), "Q3")


def _redirects(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey")
    n = part.count()
    return part.where("p_partkey % 3 != 0").select(F.lit("en").alias("lang"), F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("title"), F.concat(F.lit("T"), ((F.col("p_partkey") * 7 + 3) % n).cast("string")).alias("target"))


def q_redirects(spark, sf):
    return _w(R.redirect_closure(_redirects(spark, sf)).drop("lang"))


def _pages(spark, sf):
    html = F.regexp_replace("html", r'<a href="/([^"]*)"[^>]*>([^<]*)</a>', r"[[$1|$2]]")
    return _t(spark, sf, "pages").select(F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"), F.col("page_id").cast("string").alias("title"), F.lit(0).alias("ns"), F.lit(None).cast("string").alias("redirect"), html.alias("text"))


def q_wikilinks(spark, sf):
    return X.links(_pages(spark, sf), with_template_links=False)


def _template_pages(spark, sf):
    text = F.regexp_replace("html", r'<a href="/([^"]*)"[^>]*>([^<]*)</a>', r"{{Main|$1|2=x|{{l|en|$2}}}} [[$2]]")
    return _pages(spark, sf).drop("text").join(_t(spark, sf, "pages").select(F.col("page_id").cast("string").alias("title"), text.alias("text")), "title")


def q_template_links(spark, sf):
    rows = X.with_templates(_template_pages(spark, sf)).select("title", T.template_name(F.col("t.name")).alias("template"), F.explode(X.template_targets(F.col("t"), "dictionary")).alias("target"))
    return rows.groupBy("title", "template", "target").agg(F.count("*").alias("n"))


def q_template_delta(spark, sf):
    text = F.regexp_replace("html", r'<a href="/([^"]*)"[^>]*>([^<]*)</a>', r"{{See_also|$1|$1 $2}} [[$2]]")
    pages = _pages(spark, sf).drop("text").join(_t(spark, sf, "pages").select(F.col("page_id").cast("string").alias("title"), text.alias("text")), "title")
    return X.template_delta(pages).groupBy("title", "template", "target").agg(F.count("*").alias("n"))


def _resolution(spark, sf):
    pages = _pages(spark, sf)
    links = X.links(pages, with_template_links=False, keep=("lang",))
    # every third page has an item; anchors are titles in their language where their length is even
    own = pages.where("try_cast(title as int) % 3 != 0").select("lang", F.col("title").alias("label"), F.concat(F.lit("Q"), F.col("title")).alias("qid"))
    anchors = links.groupBy("lang", F.col("target").alias("label")).agg(F.concat(F.lit("Q9"), F.min(F.col("title").try_cast("int")).cast("string")).alias("qid"))
    titles = anchors.where("char_length(label) % 2 = 0")
    mul = anchors.where("char_length(label) % 3 = 0").select(F.lit("mul").alias("lang"), "label", "qid")
    media = links.where("char_length(target) % 5 = 0").select(F.col("target").alias("filename"))
    redirects = links.where("char_length(target) = 7").select("lang", F.col("target").alias("title"), F.lit("the").alias("target"))
    return links, own.unionByName(titles).unionByName(mul), redirects, media


def q_resolve(spark, sf):
    rows, _ = R.resolve(*_resolution(spark, sf))
    return rows.groupBy("lang", "src", "target", "dst", "method", "stream").agg(F.count("*").alias("n")).withColumn("method", F.col("method").cast("bigint"))


def q_stream_counts(spark, sf):
    rows, _ = R.resolve(*_resolution(spark, sf))
    return R.stream_counts(rows)


def q_uniq_counts(spark, sf):
    lines = _t(spark, sf, "documents").select("lang", F.explode(F.split("text", "\n")).alias("line")).where("line != ''")
    return G.combined_counts(lines, ["line"])


def _word_links(spark, sf):
    """Each word of every text, and the word after it."""
    # no filter on the number of words: it would look for them a second time
    rows = _t(spark, sf, "documents").select("lang", F.regexp_extract_all("text", F.lit("[^ \n]+"), F.lit(0)).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("w", F.lit(1), n).alias("title"), F.slice("w", F.lit(2), n).alias("target"))
    return rows.select("lang", F.inline(pairs))


def q_wkt_links(spark, sf):
    return _w(G.word_links(_word_links(spark, sf)))


def q_wkt_entries(spark, sf):
    return G.word_entries(G.accepted_words(_word_links(spark, sf)))


def q_coords(spark, sf):
    c = _t(spark, sf, "customer")
    rows = c.select(F.concat(F.lit("Q"), F.col("c_nationkey").cast("string")).alias("qid"), (F.col("c_custkey") % 5).cast("double").alias("latitude"), (F.col("c_custkey") % 3).cast("double").alias("longitude"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("altitude"), F.lit(None).cast("double").alias("precision"), F.col("c_mktsegment").alias("globe"))
    return E.distinct_coordinates(rows)


def q_mul(spark, sf):
    p = _t(spark, sf, "part").select(F.lit("mul").alias("lang"), F.col("p_name").alias("label"), F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("qid"))
    return R.dictionary(p).drop("lang")


def q_json(spark, sf):
    lines = S.good_json(_t(spark, sf, "events").select("event_id", F.col("props").alias("value")))
    return lines.select("event_id", F.get_json_object("value", "$.k").try_cast("bigint").alias("k"))


def q_languages(spark, sf):
    known = languages(spark, sf).where("id <= 10")
    return _w(L.with_new_codes(known, languages(spark, sf).select("code").union(_t(spark, sf, "region").select(F.col("r_name").alias("code")))))


def q_names(spark, sf):
    return _t(spark, sf, "pages").select("page_id", T.resource_title(F.concat(F.lit("<"), "url", F.lit(">"))).alias("name"))


def q_abstract(spark, sf):
    pages = _t(spark, sf, "events").select(F.concat(F.lit("Q"), F.col("event_id").cast("string")).alias("title"), F.lit(0).alias("ns"), F.concat(F.lit("{Q"), F.col("user_id").cast("string"), F.lit("K1} Z"), (F.col("user_id") % 7).cast("string"), F.lit(" Q"), F.col("user_id").cast("string")).alias("text"))
    return E.abstract_refs(pages)


def q_keys(spark, sf):
    return G.repeated_keys(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


def q_load_report(spark, sf):
    rows = failures(spark, sf).select(F.col("lang_id").cast("string").alias("lang"), F.when(F.col("lang_id") % 2 == 0, F.concat(F.lit("x"), "src")).otherwise(F.col("src")).alias("src"), "target")
    return G.load_report("obs_conv_failures", rows)


def q_witnesses(spark, sf):
    return _w(wp_links(spark, sf))


QUERIES = {
    "wp_not_wd": q_wp_not_wd, "witness_aggregate": q_witnesses, "common_item_type": q_common_item_type, "witnesses_overlap": q_witnesses_overlap,
    "language_recall": q_language_recall, "failed_targets": q_failed_targets, "missing_targets": q_missing_targets, "promotable_best_guesses": q_promotable,
    "coverage_violations": q_coverage, "unconnected_hubs": q_hubs, "neighbors": q_neighbours, "neighbor_links": q_neighbour_links,
    "neighbor_statements": q_neighbour_statements, "redirect_closure": q_redirects, "wikilinks": q_wikilinks, "template_links": q_template_links,
    "template_delta": q_template_delta, "resolve_links": q_resolve, "stream_counts": q_stream_counts, "uniq_count_lines": q_uniq_counts,
    "wkt_links": q_wkt_links, "wkt_entries": q_wkt_entries, "coords_dedup": q_coords, "mul_ambiguity": q_mul, "json_props": q_json,
    "language_dim": q_languages, "uri_names": q_names, "abstract_refs": q_abstract, "dq_primary_keys": q_keys, "load_report": q_load_report,
}

_FAIL = "failures AS (SELECT DISTINCT lang_id, src, p_name target FROM base WHERE l_returnflag = 'R')"
_PART = "few AS (SELECT src, dst, list_sort(list(DISTINCT lang_id)) witnesses, count(DISTINCT lang_id) wp_count FROM base WHERE l_returnflag = 'N' GROUP BY ALL)"
_ANCHORS = r"""links AS (SELECT regexp_extract(html, '<html lang="([^"]*)"', 1) lang, CAST(page_id AS VARCHAR) title, trim(unnest(regexp_extract_all(html, '<a href="/([^"]*)"[^>]*>[^<]*</a>', 1))) target FROM pages)"""
_PAIRS = r"""words AS (SELECT lang, regexp_extract_all(text, '[^ \n]+') w FROM documents), pairs AS (SELECT unnest(w[:-2]) title, unnest(w[2:]) target FROM words WHERE len(w) > 1),
 counted AS (SELECT title, target, count(*) n FROM pairs GROUP BY ALL),
 clean AS (SELECT regexp_replace(title, '^\s+|\s+$', '', 'g') src, regexp_replace(target, '^\s+|\s+$', '', 'g') dst, n FROM counted WHERE strlen(regexp_replace(n || ' ' || title || chr(9) || target, '\s+$', '')) <= 384),
 good AS (SELECT src, dst, n FROM clean WHERE src <> '' AND dst <> '' AND NOT regexp_matches(src, '[:"\t]') AND NOT regexp_matches(dst, '[:"\t]'))"""
_J = "list_aggregate(witnesses, 'string_agg', ',') witnesses"
ORACLES = {
    "wp_not_wd": f"WITH {BASE} SELECT src, dst, {_J}, wp_count FROM wp_links w WHERE wp_count > 10 AND NOT EXISTS (SELECT 1 FROM wd_links d WHERE (d.src = w.src AND d.dst = w.dst) OR (d.src = w.dst AND d.dst = w.src))",
    "witness_aggregate": f"WITH {BASE} SELECT src, dst, {_J}, wp_count FROM wp_links",
    "common_item_type": f"WITH {BASE}, stats AS (SELECT src qid, count(*) total_links, avg(wp_count) a FROM wp_links WHERE wp_count > 10 GROUP BY 1 HAVING count(*) > 5) SELECT e.qid, e.best_label, CAST(e.wp_count AS BIGINT) entity_wp_count, t.dst type_qid, n.best_label type_label, total_links, round(a, 3) avg_wp_count FROM wd_entities e JOIN stats s ON s.qid = e.qid LEFT JOIN wd_links t ON t.src = e.qid AND t.prop = 'P31' LEFT JOIN wd_entities n ON n.qid = t.dst ORDER BY a DESC, e.qid, t.dst NULLS FIRST LIMIT 500",
    "witnesses_overlap": f"WITH {BASE} SELECT src, dst, wp_count, {_J} FROM wp_links WHERE list_has_any(witnesses, (SELECT list(id) FROM languages WHERE code IN ('NATION_3', 'NATION_7')))",
    "language_recall": f"WITH {BASE} SELECT CAST(5 AS BIGINT) lang_id, CAST(12 AS BIGINT) min_count, count(*) FILTER (list_contains(witnesses, 5)) witnessed, count(*) FILTER (NOT list_contains(witnesses, 5)) not_witnessed FROM wp_links WHERE wp_count >= 12",
    "failed_targets": f"WITH {BASE}, {_FAIL} SELECT target, count(DISTINCT lang_id) n_langs, count(*) n_pairs FROM failures GROUP BY 1",
    "missing_targets": f"WITH {BASE}, {_FAIL} SELECT target, count(DISTINCT lang_id) n_langs, count(*) n_pairs FROM failures GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 40",
    "promotable_best_guesses": f"WITH {BASE}, {_PART}, guess AS (SELECT src, dst, count(DISTINCT lang_id) n FROM base WHERE l_returnflag = 'A' GROUP BY ALL), props AS (SELECT src, dst, string_agg(prop, ',' ORDER BY prop) wd_props FROM wd_links GROUP BY ALL) SELECT src, dst, n bg_witnesses, wp_count, wd_props FROM guess LEFT JOIN few USING (src, dst) LEFT JOIN props USING (src, dst) WHERE n >= 3",
    "coverage_violations": f"WITH {BASE}, {_PART}, m AS (SELECT DISTINCT lang_id, src, dst FROM base WHERE l_linenumber % 3 + 1 IN (2, 3)) SELECT src, dst, wp_count, count(DISTINCT lang_id) violating, round(CAST(count(DISTINCT lang_id) AS DOUBLE) / wp_count, 3) violation_fraction FROM m JOIN few USING (src, dst) WHERE list_contains(witnesses, lang_id) GROUP BY src, dst, wp_count",
    "unconnected_hubs": f"WITH {BASE}, {_FAIL}, lost AS (SELECT DISTINCT lang_id, p_name title FROM base WHERE l_returnflag = 'A') SELECT code lang, title, count(*) inbound_failed FROM lost JOIN failures f ON f.lang_id = lost.lang_id AND f.target = title JOIN languages l ON l.id = lost.lang_id GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 500",
    "neighbors": f"WITH {BASE}, p AS (SELECT src, dst FROM wp_links UNION ALL SELECT src, dst FROM wd_links), n AS (SELECT * FROM p WHERE 'Q3' IN (src, dst)) SELECT src qid FROM n UNION SELECT dst FROM n",
    "neighbor_links": f"WITH {BASE} SELECT src, dst, wp_count FROM wp_links WHERE 'Q3' IN (src, dst)",
    "neighbor_statements": f"WITH {BASE} SELECT src, dst, prop FROM wd_links WHERE 'Q3' IN (src, dst)",
    "redirect_closure": """WITH RECURSIVE r AS (SELECT 'T' || p_partkey title, 'T' || ((p_partkey * 7 + 3) % (SELECT count(*) FROM part)) target FROM part WHERE p_partkey % 3 <> 0),
 walk AS (SELECT title, [title] seen, title cur, 0 d FROM r UNION ALL SELECT w.title, list_append(seen, target), target, d + 1 FROM walk w JOIN r ON r.title = w.cur WHERE d < 4 AND NOT list_contains(list_slice(seen, 1, d), w.cur)),
 last AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY d DESC) k FROM walk)
 SELECT l.title, CASE WHEN list_contains(list_slice(seen, 1, d), cur) THEN 'cycle' WHEN r.title IS NULL THEN 'resolved' ELSE 'depth_exceeded' END kind, CASE WHEN r.title IS NULL THEN cur END AS "final", CASE WHEN r.title IS NULL THEN CAST(d AS BIGINT) END depth FROM last l LEFT JOIN r ON r.title = l.cur WHERE k = 1""",
    "wikilinks": f"WITH {_ANCHORS} SELECT title, target FROM links WHERE target <> ''",
    "template_links": r"""WITH a AS (SELECT CAST(page_id AS VARCHAR) title, unnest(regexp_extract_all(html, '<a href="/[^"]*"[^>]*>([^<]*)</a>', 1)) target FROM pages) SELECT title, 'l' template, trim(target) target, count(*) n FROM a WHERE trim(target) <> '' GROUP BY ALL""",
    "template_delta": r"""WITH a AS (SELECT CAST(page_id AS VARCHAR) title, unnest(regexp_extract_all(html, '<a href="/([^"]*)"[^>]*>[^<]*</a>', 1)) x, unnest(regexp_extract_all(html, '<a href="/[^"]*"[^>]*>([^<]*)</a>', 1)) y FROM pages), b AS (SELECT DISTINCT title, trim(y) y FROM a), c AS (SELECT title, trim(x) target FROM a UNION ALL SELECT title, trim(x || ' ' || y) FROM a) SELECT title, 'See_also' template, target, count(*) n FROM c WHERE target <> '' AND NOT EXISTS (SELECT 1 FROM b WHERE b.title = c.title AND b.y = c.target) GROUP BY ALL""",
    "stream_counts": None,
    "resolve_links": f"""WITH {_ANCHORS}, own AS (SELECT lang, title, 'Q' || title src FROM (SELECT DISTINCT regexp_extract(html, '<html lang="([^"]*)"', 1) lang, CAST(page_id AS VARCHAR) title, page_id FROM pages) WHERE page_id % 3 <> 0),
 anchors AS (SELECT lang, target, min(CAST(title AS INT)) m FROM links GROUP BY ALL), t AS (SELECT lang, target, 'Q9' || m qid FROM anchors WHERE length(target) % 2 = 0),
 mul AS (SELECT target, 'Q9' || min(m) qid, count(DISTINCT m) > 1 amb FROM anchors WHERE length(target) % 3 = 0 GROUP BY 1), c AS (SELECT DISTINCT lang, target FROM links),
 up AS (SELECT lang, target, CASE WHEN target[1] = 'ß' THEN 'SS' ELSE upper(target[1]) END || target[2:] cap FROM c),
 hit AS (SELECT up.lang, up.target, coalesce(a.qid, b.qid, r1.qid, r1b.qid, r2.qid, r2b.qid) conv, coalesce(m1.qid, m2.qid) mq, coalesce(m1.amb, m2.amb) amb FROM up LEFT JOIN t a ON a.lang = up.lang AND a.target = up.target LEFT JOIN t b ON b.lang = up.lang AND b.target = cap
  LEFT JOIN t r1 ON length(up.target) = 7 AND r1.lang = up.lang AND r1.target = 'the' LEFT JOIN t r1b ON length(up.target) = 7 AND r1b.lang = up.lang AND r1b.target = 'The'
  LEFT JOIN (SELECT lang, target FROM c WHERE length(target) = 7) x ON x.lang = up.lang AND x.target = cap LEFT JOIN t r2 ON x.target IS NOT NULL AND r2.lang = up.lang AND r2.target = 'the' LEFT JOIN t r2b ON x.target IS NOT NULL AND r2b.lang = up.lang AND r2b.target = 'The'
  LEFT JOIN mul m1 ON m1.target = up.target LEFT JOIN mul m2 ON m2.target = cap)
 SELECT l.lang, src, l.target, CASE WHEN src IS NULL THEN NULL ELSE coalesce(conv, mq) END dst, CAST(NULL AS BIGINT) AS method, CASE WHEN src IS NULL THEN 'src_not_found' WHEN conv IS NOT NULL THEN 'converted' WHEN mq IS NOT NULL THEN CASE WHEN amb THEN 'mul_ambiguous' ELSE 'mul' END ELSE 'failed' END stream, count(*) n
 FROM links l LEFT JOIN own USING (lang, title) LEFT JOIN hit h ON h.lang = l.lang AND h.target = l.target WHERE l.target <> '' GROUP BY ALL""",
    "uniq_count_lines": r"WITH l AS (SELECT DISTINCT lang, unnest(string_split(text, chr(10))) line FROM documents) SELECT line, count(*) n FROM l WHERE line <> '' GROUP BY 1",
    "wkt_links": f"WITH {_PAIRS} SELECT src, dst, CAST(sum(n) AS BIGINT) wkt_count FROM good GROUP BY ALL",
    "wkt_entries": f"WITH {_PAIRS} SELECT src entry FROM good UNION SELECT dst FROM good",
    "coords_dedup": "SELECT 'Q' || c_nationkey qid, CAST(c_custkey % 5 AS DOUBLE) latitude, CAST(c_custkey % 3 AS DOUBLE) longitude, min(CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END) altitude, CAST(NULL AS DOUBLE) AS precision, c_mktsegment globe FROM customer GROUP BY ALL",
    "mul_ambiguity": "SELECT p_name AS label, 'Q' || min(p_partkey) qid, count(DISTINCT p_partkey) > 1 ambiguous FROM part GROUP BY 1",
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) k FROM events WHERE json_valid(props)",
    "language_dim": "WITH known AS (SELECT n_nationkey + 1 id, n_name code FROM nation WHERE n_nationkey < 10), new AS (SELECT n_name code FROM nation WHERE n_nationkey >= 10 UNION SELECT r_name FROM region) SELECT CAST(id AS BIGINT) id, code FROM known UNION ALL SELECT 10 + row_number() OVER (ORDER BY code), code FROM new WHERE code NOT IN (SELECT code FROM known)",
    "uri_names": "SELECT page_id, replace(url_decode(replace(regexp_extract(regexp_replace('<' || url || '>', '^<+|>+$', '', 'g'), '([^/]*)$', 1), '+', '%2B')), '_', ' ') AS name FROM pages",
    "abstract_refs": "SELECT 'Q' || event_id src_qid, 'Q' || user_id ref FROM events UNION SELECT 'Q' || event_id, 'Z' || (user_id % 7) FROM events",
    "dq_primary_keys": "SELECT l_orderkey, l_linenumber, count(*) n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "load_report": f"WITH {BASE}, {_FAIL} SELECT CAST(lang_id AS VARCHAR) lang, count(*) staged, CASE WHEN lang_id % 2 = 0 THEN CAST(0 AS BIGINT) ELSE count(*) END inserted, CASE WHEN lang_id % 2 = 0 THEN count(*) ELSE CAST(0 AS BIGINT) END rejected FROM failures GROUP BY lang_id",
}
QUERIES |= D.QUERIES
ORACLES |= D.ORACLES
ORACLES["stream_counts"] = f"SELECT lang, stream, CAST(sum(n) AS BIGINT) n, CAST(0 AS BIGINT) too_long FROM ({ORACLES['resolve_links']}) GROUP BY ALL"
