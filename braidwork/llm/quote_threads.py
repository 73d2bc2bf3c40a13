"""Chat formatting by quotation linking.

Lines that begin with `>` are quotes; as many `>` as there are give their level, and lines of one level in a row are one passage. An attribution line
("... wrote:") right before a quote belongs to it. Passages are normalised (letters and digits, lower-cased, single spaces) and hashed whole, by
paragraph and by line; by sentence where it has LEAST_WORDS words; and by runs of RUN_WORDS words, of which every WINNOW in a row give the one of
least hash, so a passage of RUN_WORDS + WINNOW - 1 words of a message shares a run with it wherever it begins and however it is wrapped. The messages'
own words are hashed alike. A message replies to the earliest message of its conversation, before it, that wrote a passage it quotes: the
outermost quote level with such a message decides, then the latest of these messages.

The hash index keeps one row for each conversation and hash (partial minima before the shuffle), so a line that everyone repeats is one
row; a hash that more than one in HOT of all quotes hold is joined by broadcast (there are fewer than HOT). Roots are found by pointer doubling over
reply links alone.

Result: one row for each message, with its own text without quotes, and its position in its conversation in reply order: by thread (root_turn), then
turn, so every reply follows what it replies to. Positions come from a range-dealt sort, which cuts a long conversation, and from the
counts of the pieces; no conversation is gathered.

Defined edge cases: null and empty texts are messages without words; messages with a null conv_id or turn link to nothing; rows that repeat a turn
are judged each for itself and share that turn's thread, that of the smallest parent; their positions follow the order in which they are
stored, and rows without conversation are one conversation in this; an empty table gives no rows; other columns, whatever their names, are not
read; a very long text is parsed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, table, written

LEAST_WORDS, RUN_WORDS, WINNOW = 3, 8, 4
#: A hash is hot if more than one in HOT of the quotes hold it.
HOT = 1000
QUOTED = re.compile(r"[ \t]*((?:>[ \t]?)+)[ \t]*(.*)", re.S)
WROTE = re.compile(r"\b(wrote|writes|said|schrieb|a écrit|escribió):\s*$", re.I)
NOISE = re.compile(r"[\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """Own text, and passages as (level, text)."""
    own, passages, level = [], [], 0
    for line in (text or "").replace("\r\n", "\n").split("\n"):
        m = QUOTED.fullmatch(line)
        if m is None:
            own.append(line)
            level = 0
            continue
        deep = m[1].count(">")
        if level == 0:
            while own and not own[-1].strip():
                own.pop()
            if own and WROTE.search(own[-1]):
                own.pop()
        if deep == level:
            passages[-1][1].append(m[2])
        else:
            passages.append((deep, [m[2]]))
        level = deep
    return "\n".join(own).strip(), [(d, "\n".join(ls)) for d, ls in passages]


def normal(text: str) -> str:
    return NOISE.sub(" ", text.lower()).strip()


def passages_of(text: str) -> set[str]:
    """What is hashed: the whole text, its paragraphs, lines, sentences and chosen runs of words, normalised."""
    paragraphs = re.split(r"\n\s*\n", text)
    out = {normal(p) for p in (text, *paragraphs, *text.split("\n"))}
    out |= {n for p in paragraphs for x in SENTENCE.split(p) if len((n := normal(x)).split()) >= LEAST_WORDS}
    words = normal(text).split()
    runs = [" ".join(words[i : i + RUN_WORDS]) for i in range(len(words) - RUN_WORDS + 1)]
    keys = [xxhash.xxh3_64_intdigest(r.encode()) for r in runs]
    out |= {runs[min(range(i, i + WINNOW), key=keys.__getitem__)] for i in range(len(runs) - WINNOW + 1)}
    out.discard("")
    return out


def hashes(text: str) -> list[int]:
    return sorted(xxhash.xxh3_64_intdigest(p.encode()) - 2**63 for p in passages_of(text))


def parsed(messages: DataFrame) -> DataFrame:
    kind = "rid long, conv_id long, turn long, role string, own string, written array<long>, quotes array<struct<level:int,hash:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, row = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            own, wrote, quotes = [], [], []
            for text in batch.column("text").to_pylist():
                mine, passages = parse(text)
                own.append(mine)
                wrote.append(hashes(mine))
                quotes.append([{"level": d, "hash": h} for d, p in passages for h in hashes(p)])
            rid = pa.array(range(base + row, base + row + len(own)), pa.int64())
            row += len(own)
            yield pa.RecordBatch.from_arrays(
                [rid, batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(own, pa.string()), pa.array(wrote, pa.list_(pa.int64())), pa.array(quotes, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())])))],
                names=["rid", "conv_id", "turn", "role", "own", "written", "quotes"],
            )

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).mapInArrow(run, kind)


def roots(links: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth of the turns that reply (conv_id, turn, parent)."""
    now = written(links.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    while now.head(1):
        above = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("up"), F.col("depth").alias("more"))
        then = now.join(above, ["conv_id", "root"], "left")
        moved = then.where("up IS NOT NULL").limit(1).count()
        if not moved:
            break
        now = written(then.select("conv_id", "turn", F.coalesce("up", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")
    return now


def threaded(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (own words), parent_turn, root_turn, reply_depth, n_quotes, n_found for each row of messages."""
    rows = written(parsed(messages), "messages")
    wrote = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", F.explode("written").alias("hash"), "turn").groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    quotes = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("rid", "conv_id", "turn", F.explode("quotes").alias("q")).select("rid", "conv_id", "turn", "q.*")
    keys = ["conv_id", "hash"]
    often = written(quotes.groupBy(*keys).agg(F.count("*").alias("n")), "quoted")
    most = (often.agg(F.sum("n")).first()[0] or 0) // HOT
    hot = often.where(F.col("n") > most).select(*keys) if most else often.limit(0).select(*keys)
    cold = quotes.join(F.broadcast(hot), keys, "left_anti").join(wrote, keys)
    found = cold.unionByName(quotes.join(F.broadcast(wrote.join(F.broadcast(hot), keys)), keys)).where("origin < turn")
    best = found.groupBy("rid").agg(F.min(F.struct("level", (-F.col("origin")).alias("o"))).alias("best"), F.count_distinct("hash").alias("n_found"))
    out = rows.join(best.select("rid", (-F.col("best.o")).alias("parent_turn"), "n_found"), "rid", "left")
    links = out.where("parent_turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("parent"))
    threads = roots(links)
    n_quotes = F.size(F.array_distinct(F.transform("quotes", lambda q: q["hash"]))).cast("long")
    done = out.join(threads, ["conv_id", "turn"], "left").select(
        "rid", "conv_id", "turn", "role", F.col("own").alias("text"), "parent_turn", F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("reply_depth"), n_quotes.alias("n_quotes"), F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"),
    )
    return positioned(done)


def positioned(messages: DataFrame) -> DataFrame:
    """The rows with position, from 0 in each conversation in order of root_turn, turn, rid; without rid."""
    order = ["conv_id", "root_turn", "turn", "rid"]
    ranged = messages.repartitionByRange(partitions(messages.sparkSession), *order).sortWithinPartitions(*order)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema) + ", piece int, at long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, open_at, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = [(x,) for x in batch.column("conv_id").to_pylist()]
            at = np.zeros(len(conv), np.int64)
            for i, c in enumerate(conv):
                n = n + 1 if c == open_at else 0
                open_at, at[i] = c, n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([piece] * len(conv), pa.int32()), pa.array(at)], names=[*batch.schema.names, "piece", "at"])

    rows = written(ranged.mapInArrow(number, kind), "positions")
    counts = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    # conversations in several pieces: fewer than there are pieces
    cut = written(counts.groupBy("conv_id").agg(F.collect_list(F.struct("piece", "n")).alias("pieces")).where(F.size("pieces") > 1), "cut")
    before = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + F.when(p["piece"] < F.col("piece"), p["n"]).otherwise(0))
    same = rows["conv_id"].eqNullSafe(F.col("c_id"))
    joined = rows.join(F.broadcast(cut.select(F.col("conv_id").alias("c_id"), "pieces")), same, "left")
    return joined.withColumn("position", F.col("at") + F.coalesce(before, F.lit(0))).drop("rid", "piece", "at", "c_id", "pieces")


def op5_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threaded(table(spark, sf_dir, "conversations"))
