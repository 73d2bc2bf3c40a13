"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against the token windows of all documents.

Words are runs of letters, digits and non-ASCII characters after A-Z are lower-cased. A window is `ngram` consecutive words of
one item; an item with fewer words, but not none, is one window. Every word inside an occurrence is hit.

The set is broadcast in blocks of at most BLOCK_BYTES of item text. For a test set beyond one block, one pass over the documents looks up 64-bit
hashes of the windows of all blocks, which are broadcast if there are at most MOST_HASHES; the rows without a match are done. The others, or all rows of a
still larger test set, are matched exactly, block after block: each pass carries the hits so far, and is written to the shared folder
before the next. Items of one text are broadcast once, with their ids; more ids than BLOCK_IDS of one text are dealt to several blocks.

Defined edge cases: null and empty texts have no words; an item without text has no windows; an item whose id is null still marks
words but is not listed; repeated items, ids and documents are each judged as they stand; an empty table gives no rows (documents)
or no hits (test set); columns that clash with the operator's own are left out by scan() and kept by decontaminated(); a very long text is one row, whose
words are in memory at once. No result depends on an order among ties: items are sets.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROLL, U64, Lexicon, ids_and_texts, mixed, plain, rolled, shared, slices, table, tidy, written

NGRAM = 10
#: Item text in one broadcast block; its windows take some forty times as much in a worker.
BLOCK_BYTES = 2 << 20
#: Ids of one text in a block, and window hashes (8 bytes each) that may be broadcast.
BLOCK_IDS, MOST_HASHES = 4096, 16_000_000
#: ASCII: A-Z to a-z, letters and digits as they are, everything else a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Grams:
    """The windows of some items, by length: sorted hashes to look up, then the exact word ids."""

    def __init__(self, items: list[tuple[str | None, bytes]], ngram: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int32)
            width = min(ngram, len(ids))
            for i in range(len(ids) - width + 1 if width else 0):
                found[width][ids[i : i + width].tobytes()].add(name)
        self.by_width = {}
        for width, grams in found.items():
            ids = np.frombuffer(b"".join(grams), np.int32).reshape(len(grams), width)
            self.by_width[width] = np.unique(self.hashes(ids)), dict(grams)

    @staticmethod
    def hashes(ids: np.ndarray) -> np.ndarray:
        h = mixed(ids.astype(U64))
        out = h[:, 0].copy()
        with np.errstate(over="ignore"):
            for k in range(1, h.shape[1]):
                out = out * U64(ROLL) + h[:, k]
        return mixed(out)

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Hit flags of the words, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for width, (hashes, grams) in self.by_width.items():
            if len(ids) < width or known[-1] < width:
                continue
            starts = np.flatnonzero(known[width:] - known[:-width] == width)
            if not len(starts):
                continue
            runs = np.lib.stride_tricks.sliding_window_view(ids, width)
            h = self.hashes(runs[starts])
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for p in starts[hashes[at] == h]:
                if (own := grams.get(runs[p].tobytes())) is not None:
                    hit[p : p + width] = True
                    items |= own
        return hit, items - {None}


def blocks(bench: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The test set in parts of bounded size; the size is measured, never assumed."""
    texts = _items(bench, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text") + 16 * F.size("ids"))).first()[0] or 0
    n = -(-total // most)
    part = F.pmod(F.xxhash64("text", "cut"), F.lit(max(n, 1)))
    for k in range(n):
        yield [(i, bytes(r.text)) for r in texts.where(part == k).collect() for i in r.ids]


def _items(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text, cut, ids: each text once, with at most some BLOCK_IDS of its distinct ids; a null id is one of them."""
    items = bench.select(F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n")).alias("item"), F.encode(F.col(text_col).cast("string"), "utf-8").alias("text"))
    items = items.where(F.octet_length("text") > 0).distinct()
    many = items.groupBy("text").agg(F.ceil(F.count("*") / BLOCK_IDS).cast("int").alias("cuts"))
    dealt = items.join(many, "text").withColumn("cut", F.pmod(F.xxhash64("item"), "cuts").cast("int"))
    name = F.transform(F.collect_list("item"), lambda x: F.when(x != "n", F.substring(x, F.lit(2), F.length(x))))
    return dealt.groupBy("text", "cut").agg(name.alias("ids"))


def window_hashes(words: list[bytes], width: int, lexicon: Lexicon) -> np.ndarray:
    return rolled(lexicon.hashes(words)[:, 0], width)


def suspects(bench: DataFrame, ngram: int, text_col: str, most: int) -> dict[int, np.ndarray] | None:
    """Sorted hashes of all windows by their width, or nothing where there are more than `most`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                if words:
                    width = min(ngram, len(words))
                    h = np.unique(window_hashes(words, width, lexicon))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), width, np.int32)), pa.array(h.view(np.int64))], names=["width", "h"])

    rows = bench.select(F.encode(F.col(text_col).cast("string"), "utf-8").alias("text")).where("text IS NOT NULL").distinct().mapInArrow(run, "width int, h long").distinct()
    rows = written(rows, "suspects")
    if rows.count() > most:
        return None
    found = rows.toArrow()
    width, h = found.column("width").to_numpy(), found.column("h").to_numpy().view(U64)
    return {int(w): np.sort(h[width == w]) for w in np.unique(width)}


def cleaned(text: bytes, hit: np.ndarray) -> bytes:
    """The text without the stretch of each run of hit words."""
    spans = [m.span() for m in WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    out, at = [], 0
    for a, b in edge.reshape(-1, 2):
        out.append(text[at : spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, text[at:]])


def scan(docs: DataFrame, bench: DataFrame, ngram: int = NGRAM, id_col: str = "item_id", bench_text: str = "text", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs with three columns more: _words long, _hits binary (packed flags, one bit a word), _items array<string>.
    Columns of docs with these names are left out."""
    spark, docs = docs.sparkSession, docs.drop("_words", "_hits", "_items")
    own = docs.columns
    out = docs.withColumns({"_words": F.lit(None).cast("long"), "_hits": F.lit(None).cast("binary"), "_items": F.lit(None).cast("array<string>")})
    clean = None
    if not _one_block(bench, bench_text, block_bytes):
        known = suspects(bench, ngram, bench_text, MOST_HASHES)
        if known is not None:
            marked = written(_marked(spark, out, known, text_col), "suspects")
            clean, out = marked.where("_items IS NOT NULL"), marked.where("_items IS NULL")
    done = False
    for part in blocks(bench, id_col, bench_text, block_bytes):
        if done:
            out = written(out, "decontaminate")
        out, done = _pass(spark, out, part, ngram, text_col), True
    if not done:
        out = _pass(spark, out, [], ngram, text_col)
    return (out if clean is None else out.unionByName(clean)).select(*own, "_words", "_hits", "_items")


def _marked(spark: SparkSession, docs: DataFrame, known: dict[int, np.ndarray], text_col: str) -> DataFrame:
    """docs, of which the rows without a window of a known hash have their result: no hits and no items."""
    get = shared(spark, known)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(), get()
        for whole in batches:
            for batch in slices(whole, text_col):
                counts, flags, names = [], [], []
                for text in batch.column(text_col).cast(pa.binary()).to_pylist():
                    words = words_of(text)
                    own = lexicon.hashes(words)[:, 0] if words else np.zeros(0, U64)
                    met = False
                    for width, hashes in known.items():
                        h = rolled(own, width)
                        met = met or bool(len(h) and (hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h).any())
                    counts.append(len(words))
                    flags.append(None if met else b"")
                    names.append(None if met else [])
                new = {"_words": pa.array(counts, pa.int64()), "_hits": pa.array(flags, pa.binary()), "_items": pa.array(names, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], names=batch.schema.names)

    return docs.mapInArrow(tidy(mark), docs.schema)


def _one_block(bench: DataFrame, text_col: str, most: int) -> bool:
    return (bench.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0) <= most


def _pass(spark: SparkSession, docs: DataFrame, items: list, ngram: int, text_col: str) -> DataFrame:
    made = shared(spark, (items, ngram), lambda x: Grams(*x))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = made()
        for whole in batches:
            for batch in slices(whole, text_col):
                counts, flags, names = [], [], []
                hits, items = batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
                for text, before, listed in zip(batch.column(text_col).cast(pa.binary()).to_pylist(), hits, items, strict=True):
                    words = words_of(text)
                    hit, found = grams.find(words)
                    packed = np.packbits(hit)
                    if before:
                        packed |= np.frombuffer(before, np.uint8)
                    counts.append(len(words))
                    flags.append(packed.tobytes() if packed.any() else b"")
                    names.append(sorted(found.union(listed or ())))
                new = {"_words": pa.array(counts, pa.int64()), "_hits": pa.array(flags, pa.binary()), "_items": pa.array(names, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], names=batch.schema.names)

    return docs.mapInArrow(tidy(match), docs.schema)


def decontaminated(docs: DataFrame, bench: DataFrame, remove: str = "spans", text_col: str = "text", **options) -> DataFrame:
    """docs without the hit stretches of text (remove='spans') or without the hit documents ('documents'); clean rows are unchanged."""
    given = docs.columns
    docs, (text_col,) = plain(docs, text_col)
    found = scan(docs, bench, text_col=text_col, **options)
    if remove == "documents":
        return found.where(F.octet_length("_hits") == 0).select(docs.columns).toDF(*given)
    at = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            raw, hits, counts = texts.cast(pa.binary()).to_pylist(), batch.column("_hits").to_pylist(), batch.column("_words").to_pylist()
            if any(hits):
                texts = pa.array([cleaned(t, np.unpackbits(np.frombuffer(h, np.uint8), count=n).astype(bool)) if h else t for t, h, n in zip(raw, hits, counts, strict=True)], pa.binary()).cast(texts.type)
            columns = [texts if i == at else batch.column(i) for i in range(len(docs_schema))]
            yield pa.RecordBatch.from_arrays(columns, names=docs_schema)

    docs_schema = docs.columns
    return found.mapInArrow(cut, docs.schema).toDF(*given)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(ids_and_texts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [sum(map(int.bit_count, h)) for h in b.column("_hits").to_pylist()]
            names = b.column("_items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_words"), pa.array(hits, pa.int64()), pa.array(map(len, names), pa.int64()), pa.array(hashlib.sha256(",".join(n).encode()).hexdigest() for n in names)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    return found.drop("text").mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string").withColumn("contaminated", F.col("n_hit") > 0)


ORACLE = r"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
grams AS (SELECT DISTINCT item, list_slice(w, CAST(i AS BIGINT), CAST(i + least(10, len(w)) - 1 AS BIGINT)) g, least(10, len(w)) k
          FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) i) WHERE len(w) > 0),
widths AS (SELECT DISTINCT k FROM grams),
docs AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w FROM documents),
runs AS (SELECT doc_id, k, i, list_slice(w, CAST(i AS BIGINT), CAST(i + k - 1 AS BIGINT)) g FROM docs, widths, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) i)),
hits AS (SELECT doc_id, runs.k, i, item FROM runs JOIN grams USING (g)),
hit_words AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest(range(i, i + k)) p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) n, string_agg(item, ',' ORDER BY item) names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(h.n, 0) AS BIGINT) n_hit, CAST(coalesce(t.n, 0) AS BIGINT) n_items, sha256(coalesce(names, '')) items_sha256, coalesce(h.n, 0) > 0 contaminated
FROM docs LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""
