"""Titles to ids: redirect closure and the cascade of strategies.

Each distinct (lang, target) is resolved once, then joined back, since the answer does not depend on the source. A target becomes at most
a dozen candidates (rank, space, key), which meet one dictionary of all spaces in a single equi-join; the smallest rank that
hits decides. Languages are a column, never a loop, so a large edition is spread like any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import after_colon, before_colon, capfirst, diagnostic, is_qid, qid_number, spaced, utrim

MAX_DEPTH = 5


def _merged(made: DataFrame) -> DataFrame:
    """Rows made here (exploded, spread over names) are many times what the planner guesses from the table below them. A broadcast chosen by that guess
    does not fit the driver, so these are joined by sorting, whatever their guessed size."""
    return made.hint("merge")


def dictionary(labels: DataFrame) -> DataFrame:
    """lang, label, qid, ambiguous: one id a label, the smallest number; ambiguous where several ids share it."""
    own = labels.groupBy("lang", "label").agg(F.min(F.struct(qid_number(F.col("qid")).alias("n"), "qid")).alias("m"), (F.min("qid") != F.max("qid")).alias("ambiguous"))
    return own.select("lang", "label", F.col("m.qid").alias("qid"), "ambiguous")


def mul_statistics(labels: DataFrame) -> DataFrame:
    """One row: labels for all languages, how many are shared, and their share in percent."""
    own = dictionary(labels.where("lang = 'mul'")).agg(F.count("*").alias("n"), F.count_if("ambiguous").alias("shared"))
    return own.withColumn("pct", F.when(F.col("n") > 0, F.round(100 * F.col("shared") / F.col("n"), 2)).otherwise(F.lit(0.0)))


def one_redirect(redirects: DataFrame) -> DataFrame:
    """lang, title, target: of several targets of a title the smallest."""
    return redirects.groupBy("lang", "title").agg(F.min("target").alias("target"))


def redirect_closure(redirects: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """lang, title, kind (resolved, cycle, depth_exceeded), final, depth for each redirecting title.

    Follows up to max_depth titles, so chains of max_depth - 1 hops still resolve; self-joins of the redirects alone, unrolled."""
    step = one_redirect(redirects)
    now = step.select("lang", "title", F.array("title").alias("seen"), F.col("title").alias("at"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("final"), F.lit(None).cast("int").alias("depth"))
    hop = step.select("lang", F.col("title").alias("at"), F.col("target").alias("next"))
    for d in range(max_depth):
        now = now.join(_merged(hop), ["lang", "at"], "left")
        live = F.col("kind").isNull()
        looped = live & F.array_contains(F.slice("seen", 1, F.lit(d)), F.col("at")) if d else F.lit(False)
        ended = live & ~looped & F.col("next").isNull()
        now = now.select(
            "lang", "title",
            F.when(live & ~looped & ~ended, F.concat("seen", F.array("next"))).otherwise(F.col("seen")).alias("seen"),
            F.when(live & ~looped & ~ended, F.col("next")).otherwise(F.col("at")).alias("at"),
            F.when(looped, "cycle").when(ended, "resolved").otherwise(F.col("kind")).alias("kind"),
            F.when(ended, F.col("at")).otherwise(F.col("final")).alias("final"),
            F.when(ended, F.lit(d)).otherwise(F.col("depth")).alias("depth"),
        )
    return now.select("lang", "title", F.coalesce("kind", F.lit("depth_exceeded")).alias("kind"), "final", "depth")


def _candidate(rank: int, space: Column | str, key: Column, ok: Column | None = None) -> Column:
    made = F.struct(F.lit(rank).alias("rank"), (F.lit(space) if isinstance(space, str) else space).alias("space"), key.alias("key"))
    return made if ok is None else F.when(ok, made)


def spaces(labels: DataFrame, redirects: DataFrame, media: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(space, key, qid, flag, depth) of everything a candidate may hit; and the anomalies of redirects (lang, title, kind)."""
    titles = dictionary(labels)
    own = titles.select(F.concat(F.lit("t:"), "lang").alias("space"), F.col("label").alias("key"), "qid", "ambiguous", F.lit(None).cast("int").alias("depth"))
    closure = redirect_closure(redirects)
    direct = titles.select("lang", F.col("label").alias("final"), F.col("qid").alias("q1"))
    capital = titles.select("lang", F.col("label").alias("capital"), F.col("qid").alias("q2"))
    ended = closure.where("kind = 'resolved' AND depth > 0").withColumn("capital", capfirst(F.col("final"))).join(_merged(direct), ["lang", "final"], "left").join(_merged(capital), ["lang", "capital"], "left")
    hops = ended.select(F.concat(F.lit("r:"), "lang").alias("space"), F.col("title").alias("key"), F.coalesce("q1", "q2").alias("qid"), F.lit(False).alias("ambiguous"), "depth").where("qid IS NOT NULL")
    files = media.select(F.lit("media").alias("space"), F.col("filename").alias("key")).distinct().select("space", "key", F.lit(None).cast("string").alias("qid"), F.lit(False).alias("ambiguous"), F.lit(None).cast("int").alias("depth"))
    return own.unionByName(hops).unionByName(files), closure.where("kind != 'resolved'").select("lang", "title", "kind")


def candidates(allow_pseudo_prefix: bool = True) -> Column:
    """array<struct<rank, space, key>> of columns lang, target, in the order of the strategies."""
    t, lang = F.col("target"), F.col("lang")
    cap, neat = capfirst(t), spaced(t)
    prefix, suffix = before_colon(t), after_colon(t)
    colon = F.locate(":", t) > 0
    bare = F.regexp_replace(suffix, "^File:", "")
    crossed = colon & (prefix != "")
    if not allow_pseudo_prefix:
        crossed = crossed & ~prefix.isin("mul", "best")
    other = F.concat(F.lit("t:"), prefix)
    title, hop = F.concat(F.lit("t:"), lang), F.concat(F.lit("r:"), lang)
    return F.array_compact(
        F.array(
            _candidate(2, title, cap, cap != t), _candidate(3, hop, t), _candidate(4, hop, cap, cap != t), _candidate(5, title, neat, neat != t),
            _candidate(6, "media", suffix, colon), _candidate(7, "media", bare, colon & (bare != suffix)),
            _candidate(9, other, suffix, crossed), _candidate(10, other, capfirst(suffix), crossed & (capfirst(suffix) != suffix)),
            _candidate(11, "t:mul", t), _candidate(12, "t:mul", cap, cap != t), _candidate(13, "t:best", t), _candidate(14, "t:best", cap, cap != t),
        )
    )


def resolve_targets(targets: DataFrame, found_in: DataFrame, allow_pseudo_prefix: bool = True) -> DataFrame:
    """targets (lang, target, distinct) with stream, qid (or file name) and method (1 redirect chain, 2 literal id, 3 other language).

    Most targets are titles as they stand: these are joined first, and only the others become candidates."""
    own = F.col("space").startswith("t:")
    direct = found_in.where(own).select(F.substring("space", F.lit(3), F.length("space")).alias("lang"), F.col("key").alias("target"), F.col("qid").alias("own"))
    first = targets.join(_merged(direct), ["lang", "target"], "left")
    done = first.where("own IS NOT NULL").select("lang", "target", F.lit("converted").alias("stream"), F.col("own").alias("dst"), F.lit(None).cast("smallint").alias("method"), F.lit(1).alias("rank"))
    return done.unionByName(_by_candidates(first.where("own IS NULL").drop("own"), found_in, allow_pseudo_prefix))


def _by_candidates(targets: DataFrame, found_in: DataFrame, allow_pseudo_prefix: bool) -> DataFrame:
    asked = targets.select("lang", "target", F.explode(candidates(allow_pseudo_prefix)).alias("c")).select("lang", "target", "c.*")
    hits = asked.join(_merged(found_in), ["space", "key"]).groupBy("lang", "target").agg(F.min(F.struct("rank", "qid", "key", "ambiguous", "depth")).alias("h"))
    out = targets.join(_merged(hits), ["lang", "target"], "left")
    t, rank = F.col("target"), F.col("h.rank")
    prefix, suffix = before_colon(t), utrim(after_colon(t))
    literal = (F.locate(":", t) > 0) & prefix.isin("d", "D") & is_qid(suffix) & (rank.isNull() | (rank > 7))
    stream = (
        F.when(literal, "converted")
        .when(rank.isNull(), F.when(t.rlike("^[Ww]ikt:"), "wikt").otherwise("failed"))
        .when(rank.isin(6, 7), "commons")
        .when(rank.isin(11, 12), F.when(F.col("h.ambiguous"), "mul_ambiguous").otherwise("mul"))
        .when(rank.isin(13, 14), "best")
        .otherwise("converted")
    )
    method = F.when(literal, 2).when(rank.isin(9, 10), 3).when(rank.isin(3, 4) & (F.col("h.depth") >= 2), 1)
    value = F.when(literal, F.upper(suffix)).when(rank.isin(6, 7), F.regexp_replace(F.col("h.key"), "^File:", "")).otherwise(F.col("h.qid"))
    return out.select("lang", "target", stream.alias("stream"), value.alias("dst"), method.cast("smallint").alias("method"), F.coalesce(rank, F.lit(99)).alias("rank"))


def resolve(links: DataFrame, labels: DataFrame, redirects: DataFrame, media: DataFrame, allow_pseudo_prefix: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, anomalies) of links (lang, title, target).

    rows: lang, title, src, target, dst, method, stream. Every link is in one stream: src_not_found, converted, commons, mul, mul_ambiguous,
    best, wikt or failed. anomalies: lang, title, kind of redirects met on the way that go in circles or too deep."""
    found_in, odd = spaces(labels, redirects, media)
    names = dictionary(labels).select("lang", F.col("label").alias("title"), F.col("qid").alias("src"))
    own = links.select("lang", utrim(F.col("title")).alias("title"), utrim(F.col("target")).alias("target")).where("title != '' AND target != ''")
    own = own.join(_merged(names), ["lang", "title"], "left")
    known = own.where("src IS NOT NULL")
    targets = resolve_targets(known.select("lang", "target").distinct(), found_in, allow_pseudo_prefix)
    rows = known.join(_merged(targets), ["lang", "target"], "left").select("lang", "title", "src", "target", "dst", "method", "stream")
    lost = own.where("src IS NULL").select("lang", "title", "src", "target", F.lit(None).cast("string").alias("dst"), F.lit(None).cast("smallint").alias("method"), F.lit("src_not_found").alias("stream"))
    return rows.unionByName(lost), _anomalies(known.select("lang", "target"), odd, found_in, allow_pseudo_prefix)


def _anomalies(targets: DataFrame, odd: DataFrame, found_in: DataFrame, allow_pseudo_prefix: bool) -> DataFrame:
    """lang, title, kind of odd redirects (lang, title, kind) that targets (lang, target) come across. Only targets that name one are resolved."""
    names = F.array_distinct(F.array("target", capfirst(F.col("target"))))
    near = targets.select("lang", "target", F.explode(names).alias("title")).join(_merged(odd), ["lang", "title"]).distinct()
    ranks = resolve_targets(near.select("lang", "target").distinct(), found_in, allow_pseudo_prefix).select("lang", "target", "rank")
    # the capitalised title is looked up only where the redirect of the target itself led nowhere
    met = near.join(_merged(ranks), ["lang", "target"]).where(F.col("rank") > F.when(F.col("title") == F.col("target"), 2).otherwise(3))
    return met.select("lang", diagnostic(F.col("title")).alias("title"), "kind").where("title IS NOT NULL").groupBy("lang", "title").agg(F.min("kind").alias("kind"))


def stream_rows(rows: DataFrame, stream: str) -> DataFrame:
    """Distinct rows of one stream, as its interchange file has them."""
    own = rows.where(F.col("stream") == stream)
    if stream == "failed":
        return own.select("lang", "src", diagnostic(F.col("target")).alias("target")).where("target IS NOT NULL").distinct()
    if stream == "src_not_found":
        return own.select("lang", diagnostic(F.col("title")).alias("title")).where("title IS NOT NULL").distinct()
    return own.select("lang", "src", "dst").distinct()


def write_streams(rows: DataFrame, anomalies: DataFrame, path: str) -> None:
    """Every stream of resolve() as text, in folders by stream and language: fields parted by tabs, each line once. One pass over the rows."""
    is_stream = lambda name: F.col("stream") == name
    target, title = diagnostic(F.col("target")), diagnostic(F.col("title"))
    line = (
        F.when(is_stream("failed"), F.when(target.isNotNull(), F.concat_ws("\t", "src", target, target)))
        .when(is_stream("src_not_found"), title)
        .when(~is_stream("wikt"), F.concat_ws("\t", "src", "dst"))
    )
    method = F.when(is_stream("converted") & F.col("method").isNotNull(), F.struct(F.lit("witness_methods").alias("stream"), F.concat_ws("\t", "src", "dst", F.col("method").cast("string")).alias("value")))
    both = F.array_compact(F.array(F.when(line.isNotNull(), F.struct("stream", line.alias("value"))), method))
    lines = rows.select("lang", F.explode(both).alias("x")).select("x.stream", "lang", "x.value").distinct()
    odd = anomalies.select(F.lit("redirect_anomalies").alias("stream"), "lang", F.concat_ws("\t", "title", "kind").alias("value"))
    lines.unionByName(odd).write.partitionBy("stream", "lang").text(path)


def read_streams(spark: SparkSession, path: str) -> DataFrame:
    """stream, lang, value of what write_streams() wrote."""
    return spark.read.schema("value string, stream string, lang string").text(path).select("stream", "lang", "value")


def witness_methods(rows: DataFrame) -> DataFrame:
    return rows.where("stream = 'converted' AND method IS NOT NULL").select("lang", "src", "dst", "method").distinct()


def stream_counts(rows: DataFrame) -> DataFrame:
    """lang, stream, n, too_long: links in each stream, and those whose titles no diagnostic table holds."""
    long = F.when(F.col("stream") == "failed", diagnostic(F.col("target")).isNull()).when(F.col("stream") == "src_not_found", diagnostic(F.col("title")).isNull()).otherwise(F.lit(False))
    return rows.groupBy("lang", "stream").agg(F.count("*").alias("n"), F.count_if(long).alias("too_long"))


def resource_links(triples: DataFrame, labels: DataFrame, lang: str) -> DataFrame:
    """src, dst, predicate of triples between resources whose titles both have ids in one language."""
    from ..functions.text import resource_title

    names = dictionary(labels.where(F.col("lang") == lang)).select("label", "qid")
    rows = triples.select(resource_title(F.col("s")).alias("a"), F.col("p").alias("predicate"), resource_title(F.col("o")).alias("b"))
    src, dst = names.select(F.col("label").alias("a"), F.col("qid").alias("src")), names.select(F.col("label").alias("b"), F.col("qid").alias("dst"))
    return rows.join(_merged(src), "a").join(_merged(dst), "b").select("src", "dst", "predicate").distinct()
