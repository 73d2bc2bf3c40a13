"""Byte-level BPE encoding and decoding with Spark higher-order functions.

The rank map is one literal: an array of small maps, indexed by a hash of the key, so that a look-up touches one entry. It is held by pairs:
the ids of two neighbours lead to the rank of the two joined. A word is folded over its byte array. The fold's state is two strings, one
character for each piece and one for the rank of each pair of neighbours, in order of rank; a step joins the leftmost pair of least rank, and
only the two ranks beside it are looked up anew.

A stretch without a break of more than LONG bytes is folded in blocks of LONG bytes, whose pieces are then stitched from left to right: a few pieces on
both sides of a border are folded again together. Pieces are those of the whole stretch if and only if each two neighbours, folded alone, stay the two
pieces they are, so that is checked at the new borders, and more pieces are taken until it holds. The work grows with the length, and the
ids do not depend on where the blocks lie.

Distinct words are folded once: the REMEMBERED most frequent ones of all documents (counted over whole texts; of at most LONG bytes each, which
bounds the bytes) become a second literal of the same shape; a word that is not among them is folded where it stands. Either way gives
the same ids, so the number bears on speed alone. The only shuffle is that of partial word counts; documents never move.

Words are the matches of the tokenizer's pattern, whose white space is spelt out as Unicode's White_Space. Decoding looks up each id's
bytes and joins them. The literals are made through the session's Java side (as_literal), which is no public interface of PySpark.

Defined edge cases: null and empty texts have no ids and decode to nothing; each row stands for itself, repeated or not; of pairs of one rank the leftmost
is joined first; an empty table gives no rows; other columns are untouched, but for one named _ids, which is left out; very long texts are folded word
by word, and a word of any length takes time in proportion to it (but for stitches that need many pieces).
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, partitions, table, written

WHITE = r"\x09-\x0D\x20\x85\xA0  -     　"
#: Letters and digits first: they never begin where a contraction does, so the matches are the tokenizer's.
PATTERN = rf" ?\p{{L}}++| ?\p{{N}}++|'(?:s|t|re|ve|m|ll|d)| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
REMEMBERED, LONG = 1 << 19, 64
#: Characters of a word's ends, of a pair without a rank, and of rank 0; ranks in order, without the surrogates.
EDGE, NONE, FIRST = "\x01", "\U0010ffff", 0x100
#: Pieces on each side of a border that are folded again.
STITCHES = (4, 16, 64, 1 << 30)


def _char(rank: int) -> str:
    return chr(FIRST + rank if FIRST + rank < 0xD800 else FIRST + rank + 0x800)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def as_literal(one: DataFrame) -> Column:
    """The only value of a one-row, one-column DataFrame as a literal. Lambdas take no subqueries, and a literal built by lit() would be
    thousands of objects; this one stays a single block of bytes in the plan."""
    jvm, plan = one.sparkSession._jvm, one._jdf.queryExecution().executedPlan()
    value = plan.executeCollect()[0].copy().getArray(0)
    literal = jvm.org.apache.spark.sql.catalyst.expressions.Literal(value, one._jdf.schema().apply(0).dataType())
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(literal))


class Codec:
    """Columns that encode and decode by the ranks of a tiktoken file."""

    def __init__(self, spark: SparkSession, ranks: list[tuple[bytes, int]], buckets: int = 1 << 16):
        if sorted(r for _, r in ranks) != list(range(len(ranks))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.spark, by_token = spark, dict(ranks)
        if missing := [b for b in range(256) if bytes([b]) not in by_token]:
            raise ValueError(f"bytes without a rank: {missing[:8]}")
        rows = spark.createDataFrame(pa.table({"token": pa.array([t for t, _ in ranks], pa.binary()), "id": pa.array([r for _, r in ranks], pa.int32())}))
        self.whole, self.mask = self._literal(rows, "token", "id", buckets), buckets - 1
        cuts = ((by_token.get(t[:k]), by_token.get(t[k:]), r) for t, r in ranks for k in range(1, len(t)))
        pairs = [(_char(a) + _char(b), _char(r)) for a, b, r in cuts if a is not None and b is not None]
        rows_of = spark.createDataFrame(pa.table({"pair": pa.array([k for k, _ in pairs], pa.string()), "joined": pa.array([r for _, r in pairs], pa.string())}))
        self.pairs, self.pair_mask = self._literal(rows_of, "pair", "joined", 2 * buckets), 2 * buckets - 1
        self.beyond = FIRST + len(ranks) > 0xD800
        self.bytes = "".join(map(chr, range(256))), "".join(_char(by_token[bytes([b])]) for b in range(256))
        by_id = rows.agg(F.array_sort(F.collect_list(F.struct("id", F.hex("token").alias("bytes")))).alias("all"))
        self.spelt = as_literal(by_id.select(F.transform("all", lambda x: x["bytes"])))
        little = "concat(lpad(hex(x.id & 255), 2, '0'), lpad(hex((x.id >> 8) & 255), 2, '0'), lpad(hex((x.id >> 16) & 255), 2, '0'), lpad(hex((x.id >> 24) & 255), 2, '0'))"
        self.little = as_literal(by_id.select(F.expr(f"transform(all, x -> {little})")))
        self.known: Column | None = None

    @staticmethod
    def _literal(rows: DataFrame, key: str, value: str, buckets: int) -> Column:
        """The rows as one value: array of maps, by hash of the key."""
        slot = F.xxhash64(key).bitwiseAND(F.lit(buckets - 1)).cast("int").alias("slot")
        maps = rows.groupBy(slot).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
        every = rows.sparkSession.range(buckets).select(F.col("id").cast("int").alias("slot")).join(maps, "slot", "left")
        empty = F.expr(f"map_filter(map({_zero(rows, key)}, {_zero(rows, value)}), (k, v) -> false)")
        return as_literal(every.coalesce(1).sortWithinPartitions("slot").agg(F.collect_list(F.coalesce("m", empty))))

    def _bound(self, names: list[str], body) -> Column:
        """body(), in which the named literals are variables, so that each stands in the plan once: Spark hashes a literal wherever it stands."""
        if not names:
            return body()
        held = getattr(self, names[0])

        def inner(variable: Column) -> Column:
            setattr(self, names[0], variable)
            try:
                return self._bound(names[1:], body)
            finally:
                setattr(self, names[0], held)

        # an array of one: a fold's start would be copied, all of it, for each row
        return F.get(F.transform(F.array(held), inner), F.lit(0))

    def rank(self, token: Column) -> Column:
        return F.get(self.whole, F.xxhash64(token).bitwiseAND(F.lit(self.mask)).cast("int"))[token]

    def _joined(self, pair: Column) -> Column:
        """The character of two pieces joined, NONE if they have no rank."""
        return F.coalesce(F.get(self.pairs, F.xxhash64(pair).bitwiseAND(F.lit(self.pair_mask)).cast("int"))[pair], F.lit(NONE))

    def pieces(self, word: Column) -> Column:
        """A character for each piece of one word (binary, not empty): the fold of ranked merges."""
        n, none = F.octet_length(word), F.lit(NONE)
        edged = F.concat(F.lit(EDGE), F.translate(F.decode(word, "ISO-8859-1"), *self.bytes), F.lit(EDGE))

        def start(own: Column) -> Column:
            inner = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
            ranks = F.array_join(F.transform(inner, lambda i: self._joined(F.substring(own, i, F.lit(2)))), "")
            return state(own, F.concat(none, ranks, none), False)

        def state(own: Column, ranks: Column, done: bool) -> Column:
            return F.struct(own.alias("own"), ranks.alias("ranks"), F.lit(done).alias("done"))

        def step(s: Column, _: Column) -> Column:
            def join(least: Column) -> Column:
                def at(p: Column) -> Column:
                    def moved(own: Column) -> Column:
                        right = F.overlay(s["ranks"], self._joined(F.substring(own, p, F.lit(2))), p, F.lit(2))
                        return state(own, F.overlay(right, self._joined(F.substring(own, p - 1, F.lit(2))), p - 1, F.lit(1)), False)

                    return _let(F.overlay(s["own"], least, p, F.lit(2)), moved)

                return F.when(least == none, state(s["own"], s["ranks"], True)).otherwise(_let(F.instr(s["ranks"], least), at))

            return F.when(s["done"], s).otherwise(_let(F.array_min(F.split(s["ranks"], "")), join))

        steps = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
        return _let(F.aggregate(steps, _let(edged, start), step)["own"], lambda own: F.substring(own, F.lit(2), F.length(own) - 2))

    def _numbers(self, pieces: Column) -> Column:
        """Ids of characters."""
        above = lambda c: F.when(F.ascii(c) >= 0xE000, F.lit(FIRST + 0x800)).otherwise(F.lit(FIRST)) if self.beyond else F.lit(FIRST)
        code = lambda c: F.ascii(c) - above(c)
        return F.transform(F.split(pieces, ""), code)

    def stitched(self, word: Column) -> Column:
        """pieces() of a word of any length, in blocks."""
        n = F.octet_length(word)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / LONG).cast("int")), lambda k: self.pieces(F.substring(word, k * LONG + 1, F.lit(LONG))))
        again = lambda part: self.pieces(self.decoded(self._numbers(part)))

        def join(left: Column, right: Column) -> Column:
            def attempt(s: Column, j: Column) -> Column:
                kept = F.greatest(F.length(left) - j, F.lit(0))

                def checked(middle: Column) -> Column:
                    before = F.when(kept > 0, F.concat(F.substring(left, kept, F.lit(1)), F.left(middle, F.lit(1))))
                    after = F.when(F.length(right) > j, F.concat(F.right(middle, F.lit(1)), F.substring(right, j + 1, F.lit(1))))
                    sound = F.forall(F.array_compact(F.array(before, after)), lambda two: again(two) == two)
                    return F.when(sound, F.concat(F.left(left, kept), middle, F.when(F.length(right) > j, F.substring(right, j + 1, F.length(right))).otherwise(F.lit(""))))

                return F.coalesce(s, _let(again(F.concat(F.substring(left, kept + 1, F.length(left)), F.left(right, j))), checked))

            return F.aggregate(F.array(*map(F.lit, STITCHES)), F.lit(None).cast("string"), attempt)

        return F.aggregate(F.slice(blocks, F.lit(2), F.size(blocks)), F.get(blocks, F.lit(0)), join)

    def folded(self, word: Column) -> Column:
        """Ids of one word (binary): its own rank where it has one, else those of its pieces."""
        return self._bound(["whole", "pairs", "spelt"], lambda: self._folded(word))

    def _folded(self, word: Column) -> Column:
        n = F.octet_length(word)
        pieces = F.when(n <= LONG, self.pieces(word)).otherwise(self.stitched(word))
        return F.when(n == 0, F.array().cast("array<int>")).otherwise(_let(self.rank(word), lambda own: F.when(own.isNotNull(), F.array(own)).otherwise(self._numbers(pieces))))

    def remember(self, docs: DataFrame, text_col: str = "text", most: int = REMEMBERED) -> None:
        """Fold the most frequent distinct words of docs once, into a literal of at most `most` words: all words above the least count that
        leaves no more of them. Counts of counts, in steps of an eighth of a doubling, decide it, so no task sorts the words."""
        spark = docs.sparkSession
        every = docs.select(F.explode(words(F.col(text_col))).alias("word")).where(F.octet_length("word") <= LONG)
        counts = every.groupBy("word").count().where("count > 1")
        counts = written(counts.select("word", F.floor(F.log2("count") * 8).cast("int").alias("size")), "words")
        room, least = most, None
        for size, n in sorted(counts.groupBy("size").agg(F.count("*")).collect(), reverse=True):
            if n > room:
                break
            room, least = room - n, size
        top = counts.where(F.col("size") >= (10**6 if least is None else least)).select("word")
        folded = written(top.repartition(partitions(spark)).select("word", self.folded(F.encode("word", "utf-8")).alias("ids")), "folded")
        slots = max(most // 2, 1)
        self.known, self.known_mask = self._literal(folded, "word", "ids", slots), slots - 1

    def ids(self, text: Column) -> Column:
        """array<int> of a whole text."""

        def one(word: Column) -> Column:
            own = self._folded(F.encode(word, "utf-8"))
            if self.known is None:
                return own
            return F.coalesce(F.get(self.known, F.xxhash64(word).bitwiseAND(F.lit(self.known_mask)).cast("int"))[word], own)

        tables = ["whole", "pairs", "spelt"] + (["known"] if self.known is not None else [])
        return self._bound(tables, lambda: F.flatten(F.transform(words(text), one)))

    def packed(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.little, i)), ""))

    def decoded(self, ids: Column) -> Column:
        """The bytes of the ids, joined."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.spelt, i)), ""))


def _zero(rows: DataFrame, name: str) -> str:
    return f"CAST({ {'binary': 'X' + repr(''), 'string': repr('')}.get(kind := rows.schema[name].dataType.simpleString(), 'NULL')} AS {kind})"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(PATTERN), F.lit(0))


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as f:
        return [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))]


def encoded(docs: DataFrame, ranks: list[tuple[bytes, int]], text_col: str = "text", most: int = REMEMBERED) -> tuple[DataFrame, Codec]:
    """docs with _ids (array<int>), and the codec that made them."""
    docs = docs.drop("_ids")
    codec = Codec(docs.sparkSession, ranks)
    codec.remember(docs, text_col, most)
    return docs.withColumn("_ids", codec.ids(F.col(text_col))), codec


def digests(docs: DataFrame, ranks: list[tuple[bytes, int]]) -> DataFrame:
    out, codec = encoded(docs, ranks)
    ids = F.col("_ids")
    return out.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(codec.packed(ids), 256).alias("ids_sha256"),
        F.sha2(codec.decoded(ids), 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(ids_and_texts(table(spark, sf_dir, "documents")), read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
