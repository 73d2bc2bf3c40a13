"""MinHash near-duplicate detection with sequential Bayesian verification.

A document's set is its distinct WIDTH-word shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased); with fewer words, the whole
sequence is one shingle. Documents are linked if share * union <= 100 * intersection, counted on the full sets.

1. Every text becomes a set fingerprint and a signature; equal sets collapse at once into one node, the smallest doc_id.
2. Signatures are cut into bands; nodes that agree in a band share a bucket. Each member meets the bucket's smallest and largest node.
3. Candidates are compared signature batch by signature batch and dropped when, under a uniform prior, the posterior chance that the
   similarity reaches the threshold is below MISS. Survivors are verified on full sets.
4. Verified links give components. Buckets that still hold several components are compared across them: small ones by a
   self-join, whose survivors are verified like the first; large ones in tasks that each hold two parts of about CHUNK_BYTES of sets,
   verify survivors there, skip pairs that earlier links already join, and emit only links that join components. A part holds one large component or
   several small ones, and two parts of one component never meet, so an outsider costs as many comparisons as the bucket has members.

Keys that hold more than one row in HOT of a table (sets that many documents share, bands of many sets) are joined by broadcast: there
are fewer than HOT of them, whatever the table's size. The others are shuffled.

So no bucket is capped: any two nodes of one bucket are in one component, or were compared. The chance of losing a link is that of
sharing no band (BANDS bands of ROWS: 1e-9 at 0.85, 4e-7 at 0.8) plus MISS.

Defined edge cases: a document without words is linked with nothing and is its own component; null doc_ids have no component and are
kept; rows that repeat a doc_id are one document with several texts, each of which may link, so all are in one component; of equal
rows each gets its row of the result; ties need no order, since components do not depend on it; very long texts are one set, as large as their
distinct shingles; other columns, whatever their names, are neither read nor changed; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Lexicon, ids_and_texts, plain, raw_texts, rolled, slices, table, tidy, written

WIDTH, SHARE = 5, 80
BANDS, ROWS = 28, 4
HASHES, BATCH, MISS = BANDS * ROWS, 16, 1e-6
#: Bytes of one bucket's sets that a task compares with as many others; buckets up to SMALL members are self-joined.
CHUNK_BYTES, SMALL = 4 << 20, 16
#: A key is hot if it holds more than one in HOT of a table's rows.
HOT = 1000
#: Ids that may be broadcast (16 MB); beyond it the join is shuffled.
MOST_SENT = 1_000_000
_random = np.random.default_rng(20240229)
A = _random.integers(0, 2**63, HASHES, dtype=U64) * U64(2) + U64(1)
B = _random.integers(0, 2**63, HASHES, dtype=U64) * U64(2)


def shingles(words: list[bytes], lexicon: Lexicon, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not words:
        return np.zeros(0, U64)
    h = lexicon.hashes(words)[:, 0]
    if len(h) < width:
        return rolled(h, len(h)) + U64(len(h))
    return np.unique(rolled(h, width))


def signature(x: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 2**64 - 1, U64)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 2048):
            y = np.multiply.outer(A, x[i : i + 2048])
            y += B[:, None]
            np.minimum(low, y.min(axis=1), out=low)
    return (low >> U64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> list[int]:
    return [xxhash.xxh3_64_intdigest(sig[k * ROWS : (k + 1) * ROWS].tobytes(), seed=k) - 2**63 for k in range(BANDS)]


def joined(left: DataFrame, right: DataFrame, on: str, total: int, how: str = "inner") -> DataFrame:
    """left join right, of one row for each `on` with n, the rows of left that have it (total in all): hot keys by broadcast. right: a written table."""
    hot = right.where(F.col("n") > total // HOT).drop("n")
    if not hot.head(1):
        return left.join(right.drop("n"), on, how)
    cold = left.join(F.broadcast(hot.select(on)), on, "left_anti").join(right.where(F.col("n") <= total // HOT).drop("n"), on, how)
    return left.join(F.broadcast(hot), on).unionByName(cold)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, fp (of the set), bands, sig (16 bits of each hash), for every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for text in raw_texts(batch):
                    x = shingles(text.lower().split() if text else [], lexicon, width)
                    if len(x):
                        sig = signature(x)
                        rows.append((len(x), xxhash.xxh3_128_digest(x.tobytes()), band_keys(sig), sig.astype("<u2").tobytes()))
                    else:
                        rows.append((0, None, [], None))
                n, fp, bands, sig = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "fp", "bands", "sig"])

    return docs.mapInArrow(tidy(run), "doc_id long, n_shingles long, fp binary, bands array<long>, sig binary")


def floors(share: int, miss: float = MISS, batch: int = BATCH, hashes: int = HASHES) -> list[tuple[int, int]]:
    """(n, least matches among the first n hashes that keep a pair): P(Binomial(n+1, t) <= m) is the posterior chance of similarity >= t."""
    t = share / 100
    out = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while m <= n:
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(t) + (n + 1 - m) * log(1 - t)) if t < 1 else float(m == n)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, share: int) -> np.ndarray:
    """Flags of the pairs (rows of a and b) that no batch drops."""
    alive, seen, before = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in floors(share):
        seen = seen + (a[alive, before:n] == b[alive, before:n]).sum(axis=1)
        alive, seen, before = alive[seen >= least], seen[seen >= least], n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def pruned(pairs: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    sig = nodes.select("node", "sig")
    both = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, HASHES) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array(survivors(a, b, share)))

    return both.select("a", "b", "sa", "sb").mapInArrow(tidy(keep), "a long, b long")


def sets_of(docs: DataFrame, needed: DataFrame, count: int, width: int) -> DataFrame:
    """doc_id, items (the sorted shingle hashes) of the documents named by needed (doc_id, distinct; about count rows)."""

    def to_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seen = Lexicon(), set()
        for whole in batches:
            for batch in slices(whole):
                own = [shingles(t.lower().split() if t else [], lexicon, width).tobytes() for t in raw_texts(batch)]
                # rows that repeat an id and its set count once a task
                new = [(k := (i, xxhash.xxh3_128_digest(x))) not in seen and not seen.add(k) for i, x in zip(batch.column("doc_id").to_pylist(), own, strict=True)]
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.binary())], names=["doc_id", "items"])
                yield out.filter(pa.array(new, pa.bool_()))

    return docs.join(F.broadcast(needed) if count <= MOST_SENT else needed, "doc_id", "left_semi").mapInArrow(tidy(to_set), "doc_id long, items binary")


def verified(docs: DataFrame, pairs: DataFrame, share: int, width: int) -> DataFrame:
    """The pairs (a, b) that are links on their full sets; pairs must be a written table."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = sets_of(docs, needed, 2 * pairs.count(), width)
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("xa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("xb"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                flags.append(100 * common >= share * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(flags, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "xa", "xb").mapInArrow(tidy(linked), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b). Alternating large-star and small-star contraction."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        # large star: each neighbour above u goes to the least of u and its neighbours
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: u and its neighbours below go to the least of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u > v").distinct()
        edges = written(edges, "edges")
        if (then := state(edges)) == now:
            break
        now = then
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def across_small(mixed: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """Surviving pairs of different components in one small bucket."""
    few = mixed.where(F.col("m") <= SMALL)
    a, b = (few.select("key", F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    return pruned(a.join(b, "key").where("a < b AND ca != cb").select("a", "b").distinct(), nodes, share)


def across_large(docs: DataFrame, mixed: DataFrame, nodes: DataFrame, share: int, width: int) -> DataFrame:
    """Links (a, b) that join components within large buckets, verified where they are found."""
    large = mixed.where(F.col("m") > SMALL)
    needed = written(large.select(F.col("node").alias("doc_id")).distinct(), "needed")
    sets = sets_of(docs, needed, needed.count(), width)
    # parts: several for a large component, which they do not share; small components are dealt to parts by hash
    sizes = large.groupBy("key", "component").agg(F.sum(F.col("n") * 8 + 300).alias("size"))
    big = F.col("size") > CHUNK_BYTES // 2
    small = sizes.groupBy("key").agg(F.ceil(F.sum(F.when(~big, F.col("size")).otherwise(0)) / CHUNK_BYTES).cast("int").alias("small"))
    sizes = sizes.join(small, "key").select("key", "component", F.when(big, F.ceil(F.col("size") / CHUNK_BYTES).cast("int")).alias("cuts"), "small")
    part = F.when(F.col("cuts").isNotNull(), F.struct(F.col("component").alias("of"), F.pmod(F.xxhash64("node"), "cuts").cast("int").alias("cut"))).otherwise(F.struct(F.lit(-1).cast("long").alias("of"), F.pmod(F.xxhash64("component"), "small").cast("int").alias("cut")))
    placed = written(large.join(sizes, ["key", "component"]).select("key", "node", "component", F.when(F.col("cuts").isNotNull(), F.lit(True)).otherwise(F.lit(False)).alias("one"), part.alias("part")), "parts")
    parts = placed.select("key", "one", "part").distinct()
    a, b = (parts.select("key", F.col("one").alias(f"one_{x}"), F.col("part").alias(x)) for x in ("x", "y"))
    pairs = a.join(b, "key").where("x <= y AND NOT (one_x AND one_y AND x.of = y.of)").select("key", "x", "y")
    members = pairs.withColumn("side", F.explode(F.array_distinct(F.array("x", "y"))))
    dealt = placed.select("key", "node", "component", F.col("part").alias("side")).join(members, ["key", "side"])
    dealt = dealt.join(nodes.select("node", "sig"), "node").join(sets.withColumnRenamed("doc_id", "node"), "node")
    dealt = dealt.select("key", "x", "y", (F.col("x") == F.col("y")).alias("same"), (F.col("side") == F.col("x")).alias("left"), "node", "component", "sig", "items")

    def compare(group: pa.Table) -> pa.Table:
        left, same = group.column("left").to_numpy(zero_copy_only=False), group.column("same")[0].as_py()
        node, part = group.column("node").to_numpy(), group.column("component").to_numpy().copy()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u2").reshape(len(node), HASHES)
        raw = [np.frombuffer(b, U64) for b in group.column("items").to_pylist()]
        sizes = np.array([len(r) for r in raw])
        items = np.split(np.unique(np.concatenate(raw), return_inverse=True)[1], np.cumsum(sizes)[:-1])
        present = np.zeros(1 + max(int(i.max(initial=0)) for i in items), bool)
        right = np.arange(len(node)) if same else np.flatnonzero(~left)
        found = []
        for i in np.flatnonzero(left):
            others = right[part[right] != part[i]]
            if same:
                others = others[others > i]
            others = others[survivors(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others], share)]
            if not len(others):
                continue
            present[items[i]] = True
            common = np.add.reduceat(present[np.concatenate([items[j] for j in others])], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            present[items[i]] = False
            for j in others[100 * common >= share * (sizes[others] + sizes[i] - common)]:
                if part[i] != part[j]:
                    part[part == part[j]] = part[i]
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
        found = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return dealt.groupBy("key", "x", "y").applyInArrow(compare, "a long, b long")


def classes(docs: DataFrame, share: int = SHARE, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id long, text string)."""
    sets = written(sketches(docs, width), "sketches")
    named = sets.where("fp IS NOT NULL AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "n_shingles", "sig", "bands")).alias("s")
    nodes = written(named.groupBy("fp").agg(least, F.count("*").alias("copies")).select("fp", F.col("s.doc_id").alias("node"), F.col("s.n_shingles").alias("n"), "s.sig", "s.bands", "copies"), "nodes")
    # documents of several texts stand for all of them
    several = named.groupBy("doc_id").agg(F.min("fp").alias("one"), F.max("fp").alias("other")).where("one != other").select("doc_id")
    own_sets = named.select("doc_id", "fp").distinct().join(several, "doc_id").join(nodes.select("fp", "node"), "fp")
    same_id = written(own_sets.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a != b").distinct(), "same-id")
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    ends = written(banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("held")).where("lo < hi").withColumnRenamed("held", "n"), "ends")
    members = written(joined(banded.withColumnRenamed("n", "size"), ends, "key", BANDS * nodes.count()).withColumnRenamed("size", "n"), "members")
    ends = F.explode(F.array("lo", "hi")).alias("end")
    star = members.select("node", ends).where("node != end").select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    tested = written(pruned(star, nodes, share), "star")
    links = written(verified(docs, tested, share, width).unionByName(same_id), "links")
    parts = components(links)
    placed = members.select("key", "node", "n").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stats = placed.groupBy("key").agg(F.count("*").alias("m"), F.sum(F.col("n") * 8 + 300).alias("bytes"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    mixed = written(placed.join(stats.where("c1 < c2").select("key", "m", "bytes"), "key"), "mixed")
    rest = written(across_small(mixed, nodes, share).join(tested, ["a", "b"], "left_anti"), "rest")
    more = written(verified(docs, rest, share, width).union(across_large(docs, mixed, nodes, share, width)), "links")
    if more.head(1):
        parts = components(links.union(more))
    by_set = written(nodes.select("fp", "node", F.col("copies").alias("n")).join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component"), "n"), "components")
    ids = sets.select("doc_id", "n_shingles", "fp")
    with_id = joined(ids.where("fp IS NOT NULL AND doc_id IS NOT NULL"), by_set, "fp", named.count()).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    # rows without an id, and texts without words: these go with the other texts of their document, if it has any
    bare, no_id = ids.where("fp IS NULL AND doc_id IS NOT NULL").select("doc_id", "n_shingles"), ids.where("doc_id IS NULL")
    besides = written(bare.select("doc_id").distinct().join(named.select("doc_id"), "doc_id", "left_semi"), "besides")
    if besides.head(1):
        theirs = with_id.join(besides, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
        bare = bare.join(theirs, "doc_id", "left")
    else:
        bare = bare.withColumn("component_id", F.lit(None).cast("long"))
    rest = bare.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return with_id.unionByName(rest).unionByName(no_id.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(ids_and_texts(table(spark, sf_dir, "documents")), share=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept(docs: DataFrame, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each class, the smallest id; rows without an id stay, of rows with one id the first by text."""
    given = docs.columns
    docs, (id_col, text_col) = plain(docs, id_col, text_col)
    found = classes(ids_and_texts(docs, id_col, text_col), share)
    gone = written(found.where("doc_id != component_id").select(F.col("doc_id").alias(id_col)).distinct(), "gone")
    again = written(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col)), "again")
    out = docs.join(F.broadcast(gone) if gone.count() <= MOST_SENT else gone, id_col, "left_anti").select(docs.columns)
    if again.head(1):
        once = out.join(again, id_col, "left_semi").groupBy(id_col).agg(F.min(F.struct(text_col, *[c for c in docs.columns if c != text_col])).alias("_first")).select("_first.*").select(docs.columns)
        out = out.join(again, id_col, "left_anti").select(docs.columns).unionByName(once)
    return out.toDF(*given)
