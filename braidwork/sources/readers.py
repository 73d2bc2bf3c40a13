"""Readers of dump formats. Each gives a DataFrame of records; compressed files are read by their extension."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import utrim

#: Bytes of files a task, as they are stored, from which dealing out their lines is worth a shuffle.
LARGE = 4 << 20
PAGE = "title string, ns string, redirect struct<_title:string>, revision struct<text:string>"


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """rows in two tasks a core (a number that adaptive execution leaves alone)."""
    return rows.repartition(max(16, 2 * rows.sparkSession.sparkContext.defaultParallelism), *by)


def _spread(lines: DataFrame) -> DataFrame:
    """Lines as they are, or dealt out where large files that cannot be split leave half of the cores without a task."""
    tasks = max(1, lines.rdd.getNumPartitions())
    few = 2 * tasks < lines.sparkSession.sparkContext.defaultParallelism
    return dealt(lines) if few and int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > tasks * LARGE else lines


def json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value: one JSON record a line; brackets, trailing commas and empty lines dropped."""
    line = F.rtrim(utrim(F.col("value")), F.lit(","))
    return _spread(spark.read.text(path)).select(line.alias("value")).where("value NOT IN ('', '[', ']')")


def good_json(lines: DataFrame) -> DataFrame:
    """The lines that parse; the rest can be had from bad_json."""
    return lines.where(F.try_parse_json("value").isNotNull())


def bad_json(lines: DataFrame) -> DataFrame:
    return lines.where(F.try_parse_json("value").isNull())


def pages_of(framed: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """title, ns, redirect, text of rows (value) that end where a page ends. FAILFAST stops at a malformed page, PERMISSIVE drops it."""
    start = F.locate("<page>", F.col("value"))
    xml = _spread(framed).where(start > 0).select(F.concat(F.substring(F.col("value"), start, F.char_length("value")), F.lit("</page>")).alias("xml"))
    page = F.from_xml(F.col("xml"), PAGE, {"mode": mode})
    # inline: a filter on what was parsed is not put before it, which would parse twice
    parsed = xml.select(F.inline(F.array(F.struct(page.alias("p")))))
    if mode != "FAILFAST":
        parsed = parsed.where("p.title IS NOT NULL")
    ns = F.coalesce(F.col("p.ns").try_cast("int"), F.lit(-1))
    return parsed.select(F.col("p.title").alias("title"), ns.alias("ns"), F.col("p.redirect._title").alias("redirect"), F.coalesce("p.revision.text", F.lit("")).alias("text"))


def wiki_pages(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Pages of export files; files may hold several documents, one after the other."""
    return pages_of(spark.read.option("lineSep", "</page>").text(path), mode)


def json_report(lines: DataFrame) -> DataFrame:
    """One row: how many lines parse (good) and how many a scan leaves out (bad)."""
    bad = F.try_parse_json("value").isNull()
    return lines.agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))


def _text(spark: SparkSession, path: str | list[str], missing_ok: bool) -> DataFrame:
    """Lines; a missing file is empty only where that is allowed."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "value string")
        raise


def media_titles(spark: SparkSession, path: str | list[str], missing_ok: bool = False) -> DataFrame:
    """filename: a title list without its heading, underscores as spaces. The heading is told by its text, so files may be split."""
    return _text(spark, path, missing_ok).where("value NOT IN ('', 'page_title')").select(F.translate("value", "_", " ").alias("filename"))


def triples(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """s, p, o of lines with three parts or more; comments, directives and blanks dropped."""
    return triples_of(_spread(spark.read.text(path)))


def triples_of(lines: DataFrame) -> DataFrame:
    line = utrim(F.col("value"))
    parts = lines.select(line.alias("value")).where("value != '' AND NOT startswith(value, '#') AND NOT startswith(value, '@')").select(F.split("value", " ", 4).alias("t"))
    return parts.where(F.size("t") >= 3).select(F.get("t", F.lit(0)).alias("s"), F.get("t", F.lit(1)).alias("p"), F.get("t", F.lit(2)).alias("o"))


def split_fields(value: Column, names: list[str]) -> list[Column]:
    """The first len(names) tab-separated fields; the last keeps what follows."""
    parts = F.split(value, "\t", len(names))
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def tab_file(spark: SparkSession, path: str | list[str], names: list[str], missing_ok: bool = False) -> DataFrame:
    """Headerless tab-separated text as strings; lines with fewer fields are dropped. A missing file is empty only where that is allowed."""
    lines = _text(spark, path, missing_ok)
    line = F.regexp_replace("value", "\r$", "")
    return lines.where("value != ''").where(F.size(F.split(line, "\t", len(names))) == len(names)).select(*split_fields(line, names))


def _place(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/+", "/", path).rstrip("/")


def tagged_streams(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """lang, value, file, block of the lines of one file, or folder of files, a language, in one scan. Empty lines and carriage returns
    are dropped; a missing file is an error."""
    langs = F.create_map(*[F.lit(x) for lang, path in paths.items() for x in (_place(path), lang)])
    own = F.regexp_replace(F.try_url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/+", "/")
    rows = spark.read.text(list(paths.values())).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lang = F.coalesce(langs[own], langs[F.regexp_replace(own, "/[^/]*$", "")])
    return rows.select(lang.alias("lang"), "value", "file", "block").where("value != ''")


def order_faults(streams: DataFrame) -> DataFrame:
    """lang, faults: lines that are not above the line before them in their file, by bytes, where there are any.

    Each block of a file is compared in place, batch by batch; only its ends meet those of its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_at: list | None = None  # lang, file, block, first, last, faults
        kind = pa.schema([("lang", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("faults", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column("value").cast(pa.binary())
            file, block = batch.column("file"), batch.column("block")
            new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            done = []
            for a, b in zip(starts, starts[1:], strict=False):
                own, name = value[a:b], [batch.column("lang")[a].as_py(), file[a].as_py(), block[a].as_py()]
                faults = pc.sum(pc.less_equal(own[1:], own[:-1]).cast(pa.int64())).as_py() or 0
                if open_at is not None and open_at[:3] == name:
                    open_at[5] += faults + (own[0].as_py() <= open_at[4])
                    open_at[4] = own[-1].as_py()
                else:
                    done += [open_at] if open_at is not None else []
                    open_at = [*name, own[0].as_py(), own[-1].as_py(), faults]
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, d, strict=True)) for d in done], schema=kind)
        if open_at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, open_at, strict=True))], schema=kind)

    ends = streams.mapInArrow(run, "lang string, file string, block long, first binary, last binary, faults long")
    before = F.lag("last").over(W.partitionBy("file").orderBy("block"))
    border = F.when(F.col("first") <= before, 1).otherwise(0)
    return ends.withColumn("border", border).groupBy("lang").agg(F.sum(F.col("faults") + F.col("border")).alias("faults")).where("faults > 0")


def sorted_unique(streams: DataFrame) -> DataFrame:
    """lang, value of tagged streams, once it is sure that every file is sorted and without repeats; an error names the languages that are not."""
    if bad := order_faults(streams).orderBy("lang").limit(10).collect():
        raise ValueError("not sorted or not unique: " + ", ".join(f"{r.lang} ({r.faults} lines)" for r in bad))
    return streams.select("lang", "value")


def counted_lines(lines: DataFrame) -> DataFrame:
    """n, rest of `uniq -c` lines; a line without a count has n = null."""
    n = F.regexp_extract("value", r"^\s*(\d+)\s(.*)$", 1)
    rest = F.regexp_extract("value", r"(?s)^\s*\d+\s(.*)$", 1)
    return lines.select(F.when(n != "", n.cast("long")).alias("n"), F.when(n != "", rest).otherwise(F.col("value")).alias("rest"))
