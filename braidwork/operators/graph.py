"""The witness graph and its side tables: aggregation, diagnostics, dictionaries of word pages, checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import utrim
from ..schemas import RESOLUTION_METHODS, TABLES, TITLE_CHARS, key, schema
from ..sources.registry import with_new_codes

# ---- aggregation


def witness_links(edges: DataFrame, count: str = "wp_count") -> DataFrame:
    """src, dst, sorted distinct witnesses, and how many, of edges (lang_id, src, dst). One shuffle; repeats need no distinct before."""
    ids = F.sort_array(F.collect_set(F.col("lang_id").cast("smallint")))
    return edges.groupBy("src", "dst").agg(ids.alias("witnesses")).withColumn(count, F.size("witnesses"))


def combined_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, n: in how many languages each record occurs, most frequent first."""
    return rows.select("lang", *by).distinct().groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def with_language_ids(rows: DataFrame, languages: DataFrame, lang: str = "lang") -> DataFrame:
    """lang becomes lang_id. The dimension has one row a language; beyond the session's broadcast limit the join is shuffled."""
    return rows.join(languages.select(F.col("id").alias("lang_id"), F.col("code").alias(lang)), lang).drop(lang)


def failed_targets(failures: DataFrame) -> DataFrame:
    return failures.groupBy("target").agg(F.count_distinct("lang_id").alias("n_langs"), F.count("*").alias("n_pairs"))


# ---- diagnostics loaders: rows that hold, and counts of those that do not

_QID = "^Q[0-9]+$"


def _qid_ok(c: str) -> Column:
    return F.col(c).rlike(_QID) & (F.char_length(c) <= 11)


CHECKS = {
    "obs_conv_failures": lambda: _qid_ok("src") & (F.col("target") != "") & (F.char_length("target") <= TITLE_CHARS),
    "obs_src_not_found": lambda: (F.col("title") != "") & (F.char_length("title") <= TITLE_CHARS),
    "obs_redirect_anomalies": lambda: (F.col("title") != "") & (F.char_length("title") <= TITLE_CHARS) & F.col("kind").isin("cycle", "depth_exceeded"),
    "wp_witness_methods": lambda: _qid_ok("src") & _qid_ok("dst") & F.col("method").isin(1, 2, 3),
}


def loaded(table: str, rows: DataFrame, languages: DataFrame) -> DataFrame:
    """Distinct rows of a diagnostic table (lang as its id) that hold."""
    return with_language_ids(rows.where(F.coalesce(CHECKS[table](), F.lit(False))), languages).distinct()


def load_report(table: str, rows: DataFrame) -> DataFrame:
    """lang, staged, inserted, rejected."""
    good = F.coalesce(CHECKS[table](), F.lit(False))
    fields = F.struct(*[c for c in rows.columns if c != "lang"])
    return rows.groupBy("lang").agg(F.count("*").alias("staged"), F.count_distinct(F.when(good, fields)).alias("inserted"), F.count_if(~good).alias("rejected"))


def loaded_with_languages(table: str, rows: DataFrame, languages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """loaded() after languages (id, code) got a row for each code it lacked; and these languages."""
    every = with_new_codes(languages, rows.select(F.col("lang").alias("code")))
    return loaded(table, rows, every), every


# ---- tables in place


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(f"{base}/{name}")


def replace_table(spark: SparkSession, base: str, name: str, rows: DataFrame) -> None:
    """Put rows in the place of a table of the catalogue. They are written aside and their key is checked first: where it repeats or is null, the
    table stays as it was."""
    staged = f"{base}/_staged/{name}-{uuid.uuid4().hex}"
    rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(name).fields]).write.parquet(staged)
    own = spark.read.schema(schema(name)).parquet(staged)
    if bad := repeated_keys(own, key(name)).limit(3).collect():
        raise ValueError(f"{name}: key repeated or null, as in {bad}")
    own.write.mode("overwrite").parquet(f"{base}/{name}")


def create_tables(spark: SparkSession, base: str) -> None:
    """Every table of the catalogue, empty, where there is none yet; the names of resolution methods are filled in."""
    for name in TABLES:
        rows = RESOLUTION_METHODS if name == "resolution_methods" else []
        spark.createDataFrame(rows, schema(name)).write.mode("ignore").parquet(f"{base}/{name}")


def refresh_failed_targets(spark: SparkSession, base: str) -> None:
    replace_table(spark, base, "obs_failed_targets", failed_targets(read_table(spark, base, "obs_conv_failures")))


# ---- word pages


def routed_word_links(links: DataFrame) -> DataFrame:
    """src, dst, n, route of links (title, target), each kind counted once: reject where its counted line is too long or it is of a namespace,
    bad where a side is empty, else accept. A counted line is the count, a space and the two sides, without white space at its end."""
    kinds = links.groupBy("title", "target").agg(F.count("*").alias("n"))
    src, dst = F.col("src"), F.col("dst")
    line = F.regexp_replace(F.concat_ws("\t", "title", "target"), r"(?U)\s+$", "")
    long = F.length(F.col("n").cast("string")) + 1 + F.octet_length(line) > TITLE_CHARS
    return kinds.select("n", long.alias("long"), _sides()).select("src", "dst", "n", F.when(F.col("long") | _odd(src) | _odd(dst), "reject").when((src == "") | (dst == ""), "bad").otherwise("accept").alias("route"))


def _odd(x: Column) -> Column:
    """Of a namespace, or with a mark that exchange files cannot hold."""
    return x.contains(":") | x.contains('"') | x.contains("\t")


def _sides() -> Column:
    """src, dst: trimmed title and target. Through inline, else whatever looks at them trims them anew."""
    return F.inline(F.array(F.struct(utrim(F.col("title")).alias("src"), utrim(F.col("target")).alias("dst"))))


def accepted_words(links: DataFrame) -> DataFrame:
    """src, dst, n of links (title, target) that routed_word_links() accepts, a pair in one row or more. The count of a pair bears on its route by
    the length of its line alone, so only pairs near that length are counted first."""
    size = F.coalesce(F.octet_length("title"), F.lit(0)) + F.coalesce(F.octet_length("target"), F.lit(0)) + 1
    short = size <= TITLE_CHARS - len(" 9223372036854775807")
    own = links.where(short).select(_sides()).select("src", "dst", F.lit(1).cast("long").alias("n"))
    src, dst = F.col("src"), F.col("dst")
    own = own.where(~F.coalesce(_odd(src) | _odd(dst) | (src == "") | (dst == ""), F.lit(False)))
    return own.unionByName(routed_word_links(links.where(~short)).where("route = 'accept'").drop("route"))


def word_links(links: DataFrame, distinct_per_language: bool = False) -> DataFrame:
    """src, dst, wkt_count: how often a pair occurs (or in how many languages) among accepted links."""
    if distinct_per_language:
        links = links.select("lang", utrim(F.col("title")).alias("title"), utrim(F.col("target")).alias("target")).distinct()
    return accepted_words(links).groupBy("src", "dst").agg(F.sum("n").cast("int").alias("wkt_count"))


def word_entries(pairs: DataFrame) -> DataFrame:
    """Words of word_links(), or of accepted_words(), which need not be counted for this."""
    return pairs.select(F.explode(F.array("src", "dst")).alias("entry")).distinct()


# ---- text exchange


def array_literal(witnesses: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(witnesses.cast("array<string>"), ","), F.lit("}"))


def counts_last(lines: DataFrame) -> DataFrame:
    """value: counted lines with the count moved behind the fields, comma-separated."""
    words = F.filter(F.split(utrim(F.col("value")), r"(?U)\s+"), lambda x: x != "")
    tabs = F.split(utrim(F.col("value")), "\t")
    w = lambda i: F.get("w", F.lit(i))
    lead = F.regexp_extract(F.get("t", F.lit(0)), r"^\s*(\d+)\s+(.*)$", 1)
    first = F.regexp_extract(F.get("t", F.lit(0)), r"^\s*(\d+)\s+(.*)$", 2)
    moved = F.concat_ws(",", first, F.array_join(F.slice("t", 2, F.size("t")), ","), lead)
    out = (
        F.when((F.size("w") == 3) & w(0).rlike("^[0-9]+$"), F.concat_ws(",", w(1), w(2), w(0)))
        .when(F.size("w") == 2, F.concat_ws(",", w(0), w(1)))
        .when((F.size("t") > 1) & (lead != ""), moved)
        .otherwise(F.array_join("t", ","))
    )
    return lines.where(utrim(F.col("value")) != "").withColumns({"w": words, "t": tabs}).select(out.alias("value"))


def write_table(df: DataFrame, path: str, by: list[str] | None = None, sort: list[str] | None = None) -> None:
    """Overwrite a table as Parquet, in folders by `by`, files in order of `sort` (range-dealt, so that scans skip by it)."""
    out = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_text(df: DataFrame, path: str, sep: str = "\t", quoted: bool = False) -> None:
    """Headerless text exchange; quoted only where a value needs it."""
    writer = df.write.mode("overwrite").option("sep", sep).option("emptyValue", "").option("nullValue", "")
    (writer.option("quote", '"').option("escape", '"') if quoted else writer.option("quote", "\u0000")).csv(path)


# ---- checks


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur twice or more, or hold a null: empty where key is a primary key."""
    null = F.greatest(*[F.col(c).isNull() for c in key]) if len(key) > 1 else F.col(key[0]).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | null)


def bad_witnesses(links: DataFrame) -> DataFrame:
    """Links whose witnesses are empty, unsorted, repeated or not as many as counted."""
    w = F.col("witnesses")
    return links.where((F.size(w) == 0) | (w != F.array_sort(F.array_distinct(w))) | (F.size(w) != F.col("wp_count")))


def methods_without_link(methods: DataFrame, converted: DataFrame) -> DataFrame:
    return methods.join(converted.select("lang", "src", "dst").distinct(), ["lang", "src", "dst"], "left_anti")


def changed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """Codes whose id is not what it was."""
    return before.select("code", F.col("id").alias("was")).join(after, "code", "left").where("id IS NULL OR id != was")


def lost_links(links: DataFrame, rows: DataFrame) -> DataFrame:
    """lang, n, routed where the streams together hold another number of links than there were."""
    a, b = links.groupBy("lang").agg(F.count("*").alias("n")), rows.groupBy("lang").agg(F.count("*").alias("routed"))
    return a.join(b, "lang", "full").where("NOT n <=> routed")


def overlapping_streams(rows: DataFrame) -> DataFrame:
    """(lang, title, target) that are in more than one stream."""
    return rows.groupBy("lang", "title", "target").agg(F.count_distinct("stream").alias("n")).where("n > 1")
