"""The analytical queries, over tables of the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def related(wd_links: DataFrame) -> DataFrame:
    """Pairs related in either direction. Two equi-joins would do as well; one of the union needs one shuffle of the graph."""
    pairs = wd_links.select("src", "dst")
    return pairs.union(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def wp_not_wd(wp_links: DataFrame, wd_links: DataFrame, min_count: int = 10, limit: int | None = None) -> DataFrame:
    """Pairs that more than min_count editions link and no statement relates, in either direction."""
    out = wp_links.where(F.col("wp_count") > min_count).join(related(wd_links), ["src", "dst"], "left_anti")
    return _limited(out.select("src", "dst", "witnesses", "wp_count").orderBy(F.desc("wp_count"), "src", "dst"), limit)


def common_item_type(wd_entities: DataFrame, wp_links: DataFrame, wd_links: DataFrame, min_count: int = 10, min_links: int = 5, limit: int | None = 500) -> DataFrame:
    stats = wp_links.where(F.col("wp_count") > min_count).groupBy(F.col("src").alias("qid")).agg(F.count("*").alias("total_links"), F.avg("wp_count").alias("avg_wp_count")).where(F.col("total_links") > min_links)
    kinds = wd_links.where("prop = 'P31'").select(F.col("src").alias("qid"), F.col("dst").alias("type_qid"))
    names = wd_entities.select(F.col("qid").alias("type_qid"), F.col("best_label").alias("type_label"))
    out = wd_entities.join(stats, "qid").join(kinds, "qid", "left").join(names, "type_qid", "left")
    out = out.select("qid", "best_label", F.col("wp_count").alias("entity_wp_count"), "type_qid", "type_label", "total_links", "avg_wp_count")
    return _limited(out.orderBy(F.desc("avg_wp_count"), "qid", "type_qid"), limit)


def witnesses_overlap(wp_links: DataFrame, languages: DataFrame, langs: list[str]) -> DataFrame:
    """Links that any of the languages witnesses. Their ids are looked up first and become a literal, which the scan can use."""
    ids = [r.id for r in languages.where(F.col("code").isin(langs)).select("id").collect()]
    wanted = F.array(*[F.lit(i).cast("smallint") for i in sorted(ids)]).cast("array<smallint>")
    return wp_links.where(F.arrays_overlap("witnesses", wanted)).select("src", "dst", "wp_count", "witnesses").orderBy(F.desc("wp_count"), "src", "dst")


def language_recall(wp_links: DataFrame, lang_id: int, min_count: int) -> DataFrame:
    """One row, also over no links."""
    has = F.array_contains("witnesses", F.lit(lang_id).cast("smallint"))
    return wp_links.where(F.col("wp_count") >= min_count).agg(F.count_if(has).alias("witnessed"), F.count_if(~has).alias("not_witnessed")).select(F.lit(lang_id).alias("lang_id"), F.lit(min_count).alias("min_count"), "witnessed", "not_witnessed")


def missing_targets(failed_targets: DataFrame, limit: int | None = 500) -> DataFrame:
    return _limited(failed_targets.select("target", "n_langs", "n_pairs").orderBy(F.desc("n_langs"), F.desc("n_pairs"), "target"), limit)


def promotable_best_guesses(best_guesses: DataFrame, wp_links: DataFrame, wd_links: DataFrame, threshold: int = 5) -> DataFrame:
    """Guessed links of many witnesses, with what the graph and the statements say of them (null where nothing)."""
    props = wd_links.groupBy("src", "dst").agg(F.sort_array(F.collect_list("prop")).alias("wd_props"))
    out = best_guesses.where(F.col("n") >= threshold).select("src", "dst", F.col("n").alias("bg_witnesses"))
    out = out.join(wp_links.select("src", "dst", "wp_count"), ["src", "dst"], "left").join(props, ["src", "dst"], "left")
    return out.select("src", "dst", "bg_witnesses", "wp_count", "wd_props").orderBy(F.desc("bg_witnesses"), "src", "dst")


def coverage_violations(methods: DataFrame, wp_links: DataFrame, limit: int | None = 500) -> DataFrame:
    """Links of which many witnesses reached another edition's article rather than their own."""
    own = methods.where("method IN (2, 3)").select("lang_id", "src", "dst").distinct()
    hit = own.join(wp_links, ["src", "dst"]).where(F.array_contains("witnesses", F.col("lang_id").cast("smallint")))
    out = hit.groupBy("src", "dst", "wp_count").agg(F.count("*").alias("violating"))
    share = F.round(F.col("violating") / F.col("wp_count"), 3).alias("violation_fraction")
    return _limited(out.select("src", "dst", "wp_count", "violating", share).orderBy(F.desc("violation_fraction"), F.desc("wp_count"), "src", "dst"), limit)


def unconnected_hubs(src_not_found: DataFrame, conv_failures: DataFrame, languages: DataFrame, limit: int | None = 500) -> DataFrame:
    """Pages without an item to which failed links point."""
    failed = conv_failures.groupBy("lang_id", F.col("target").alias("title")).agg(F.count("*").alias("inbound_failed"))
    out = failed.join(src_not_found.select("lang_id", "title"), ["lang_id", "title"]).join(languages.select(F.col("id").alias("lang_id"), F.col("code").alias("lang")), "lang_id")
    return _limited(out.select("lang", "title", "inbound_failed").orderBy(F.desc("inbound_failed"), "lang", "title"), limit)


def neighbour_links(wp_links: DataFrame, qid: str) -> DataFrame:
    return wp_links.where((F.col("src") == qid) | (F.col("dst") == qid)).select("src", "dst", "wp_count").orderBy(F.desc("wp_count"), "src", "dst")


def neighbour_statements(wd_links: DataFrame, qid: str) -> DataFrame:
    return wd_links.where((F.col("src") == qid) | (F.col("dst") == qid)).select("src", "dst", "prop").orderBy("src", "dst", "prop")


def neighbours(wp_links: DataFrame, wd_links: DataFrame, qid: str) -> DataFrame:
    """Ids one link or statement away from qid, and itself."""
    pairs = neighbour_links(wp_links, qid).select("src", "dst").union(neighbour_statements(wd_links, qid).select("src", "dst"))
    return pairs.select(F.col("src").alias("qid")).union(pairs.select("dst")).distinct()


def flat(witnesses: Column) -> Column:
    return F.array_join(witnesses.cast("array<string>"), ",")
