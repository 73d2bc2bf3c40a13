"""Substring deduplication by difference-cover anchors.

A window is WINDOW consecutive words `[^\\x20\\x09-\\x0D]+` of one document. Every word of a window whose word sequence also starts earlier
(smaller doc_id, or same document and earlier start) is removed; windows are judged on the input.

COVER is a difference cover modulo PERIOD: for any two positions p and q some shift below PERIOD takes both to cover
positions. So two equal windows share an anchor, a run of WINDOW - PERIOD + 1 words that starts at a cover position of both, and hashing
4 of 13 positions finds every match.

1. Documents are packed, in scan order, into blocks of about BLOCK_BYTES: one compressed Arrow row each, written to the shared folder.
2. Each block sends its distinct anchor hashes, dealt by hash; hashes met in two blocks go back to both. A hash costs one
   entry a block, however many documents hold it, so no key is hot.
3. Around anchors that occur twice, a block extends to the windows that contain them and sends each kind's first as 128 bits, two rolling hashes of
   their own multipliers over two 64-bit hashes of each word, dealt by hash; every block learns which of its firsts have an earlier one elsewhere.
   Windows are equal if these bits are; words are not compared again.
4. Each block marks the words of all later windows and emits its documents.

Nothing is sampled or capped; a task holds one block, or what is dealt to one hash bucket (BUCKET_BYTES of anchors on average).

Defined edge cases: null and empty texts have no words; null doc_ids come after all others; rows that repeat a doc_id follow each other in storage
order, so of equal windows the first in this order stays; a very long text is a block of its own, as large as its words; other columns, whatever
their names, are carried along unchanged (kept()); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROLL, ROLL_TOO, U64, Lexicon, ids_and_texts, partitions, plain, raw_texts, rolled, table, tidy, written

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
BLOCK_BYTES, BUCKET_BYTES = 6 << 20, 32 << 20
LAST = 2**63 - 1
#: A window's first in a block: two hashes, document, place in the block.
FIRST = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("at", "<u4")])


def packed(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, words (about), payload: an Arrow stream of rows of docs, in ascending id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).sort_by([(id_col, "ascending")]).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                out.write_table(rows)
            return pa.RecordBatch.from_arrays([pa.array([base + n], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "size", "payload"])

        for batch in batches:
            sizes = [len(x) if (x := v.as_buffer()) is not None else 0 for v in batch.column(text_col).cast(pa.binary())]
            at = 0
            for i, own in enumerate(sizes):
                size += own
                if size >= block_bytes:
                    held.append(batch.slice(at, i + 1 - at))
                    yield flush()
                    held, size, at, n = [], 0, i + 1, n + 1
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield flush()

    return docs.mapInArrow(tidy(run), "block long, size long, payload binary")


class Block:
    """The words of a packed block. Places count words through all its documents."""

    def __init__(self, payload: bytes, text_col: str, lexicon: Lexicon, window: int = WINDOW):
        self.rows = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.window, self.width = window, window - PERIOD + 1
        self.texts = [b for c in self.rows.column(text_col).chunks for b in raw_texts(pa.RecordBatch.from_arrays([c], names=["text"]))]
        hashes, counts = [np.zeros((0, 2), U64)], []
        for t in self.texts:
            words = t.split() if t else []
            counts.append(len(words))
            hashes.append(lexicon.hashes(words))
        self.counts = np.array(counts, np.int64)
        self.hashes = np.concatenate(hashes)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors of documents that have a window."""
        long = self.counts >= self.window
        place = np.concatenate([np.zeros(0, np.int64), *[s + np.flatnonzero(np.isin(np.arange(n - self.width + 1) % PERIOD, COVER)) for s, n in zip(self.starts[long], self.counts[long], strict=True)]])
        return place, rolled(self.hashes[:, 0], self.width)[place]

    def candidates(self, elsewhere: np.ndarray) -> np.ndarray:
        """Places of the windows that contain an anchor met twice: here, or here and in another block."""
        place, h = self.anchors()
        if not len(h):
            return place
        kinds, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        twice = (counts > 1) | np.isin(kinds, elsewhere, assume_unique=True)
        place = place[twice[inverse]]
        doc = np.searchsorted(self.ends, place, side="right")
        marks = np.zeros(len(self.hashes) + 1, np.int32)
        np.add.at(marks, np.maximum(place - (PERIOD - 1), self.starts[doc]), 1)
        np.add.at(marks, np.minimum(place + 1, self.ends[doc]), -1)
        start = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
        return start[start + self.window <= self.ends[np.searchsorted(self.ends, start, side="right")]]

    def firsts(self, elsewhere: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each kind of candidate window once (FIRST, the earliest), and the places of the later ones."""
        place = self.candidates(elsewhere)
        h1, h2 = (rolled(self.hashes[:, k], self.window, roll)[place] for k, roll in ((0, ROLL), (1, ROLL_TOO)))
        order = np.lexsort((place, h2, h1))
        h1, h2, place = h1[order], h2[order], place[order]
        new = np.ones(len(place), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        out = np.zeros(int(new.sum()), FIRST)
        out["h1"], out["h2"], out["at"] = h1[new], h2[new], place[new]
        out["doc"] = ids[np.searchsorted(self.ends, place[new], side="right")]
        return out[np.argsort(out["at"])], place[~new].astype(np.uint32)

    def covered(self, places: np.ndarray) -> np.ndarray:
        marks = np.zeros(len(self.hashes) + 1, np.int32)
        np.add.at(marks, places, 1)
        np.add.at(marks, places + self.window, -1)
        return np.cumsum(marks[:-1]) > 0


def _dealt(values: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    if not len(values):  # a block without windows: np.split() would give one part, and no bucket for it
        return
    own = (keys % U64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    found, at = np.unique(own[order], return_index=True)
    for b, part in zip(found, np.split(values[order], at[1:]), strict=True):
        yield int(b), part


def _compact(x: np.ndarray) -> bytes:
    """Firsts in order of place, as compressed columns: hashes, steps of the place by byte plane, runs of documents."""
    new = np.flatnonzero(np.concatenate([[True], x["doc"][1:] != x["doc"][:-1]]))
    steps = np.diff(x["at"], prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    runs = np.diff(np.append(new, len(x))).astype("<u4")
    return zstandard.compress(b"".join([np.array([len(x), len(new)], "<u4").tobytes(), x["h1"].tobytes(), x["h2"].tobytes(), steps, x["doc"][new].tobytes(), runs.tobytes()]), 1)


def _firsts(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    n, k = np.frombuffer(raw, "<u4", 2)
    at, out = 8, np.zeros(n, FIRST)
    for field, size in (("h1", 8), ("h2", 8)):
        out[field] = np.frombuffer(raw, out.dtype[field], n, at)
        at += size * int(n)
    out["at"] = np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * int(n), at).reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)
    at += 4 * int(n)
    out["doc"] = np.repeat(np.frombuffer(raw, "<i8", k, at), np.frombuffer(raw, "<u4", k, at + 8 * int(k)))
    return out


def _joined(parts: list[bytes] | None, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), kind)


def _rows(bucket: list[int], block: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block", "data"])


def _met_twice(group: pa.Table) -> pa.Table:
    """Of the anchor hashes of a bucket, those of two blocks, for each of their blocks."""
    parts = [np.frombuffer(d, U64) for d in group.column("data").to_pylist()]
    h, block = np.concatenate(parts), np.repeat(group.column("block").to_numpy(), [len(p) for p in parts])
    order = np.argsort(h, kind="stable")
    h, block = h[order], block[order]
    same = h[1:] == h[:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    return _by_block(block[twice], h[twice])


def _preceded(group: pa.Table) -> pa.Table:
    """Of the firsts of a bucket, those with an earlier one in another block: their places, by block."""
    if group.column("bucket")[0].as_py() < 0:  # places known within their block
        return group.select(["block", "data"])
    parts = [_firsts(d) for d in group.column("data").to_pylist()]
    x, block = np.concatenate(parts), np.repeat(group.column("block").to_numpy(), [len(p) for p in parts])
    order = np.lexsort((x["at"], block, x["doc"], x["h2"], x["h1"]))
    x, block = x[order], block[order]
    later = np.concatenate([[False], (x["h1"][1:] == x["h1"][:-1]) & (x["h2"][1:] == x["h2"][:-1])])
    return _by_block(block[later], x["at"][later])


def _by_block(block: np.ndarray, values: np.ndarray) -> pa.Table:
    order = np.argsort(block, kind="stable")
    found, at = np.unique(block[order], return_index=True)
    parts = [p.tobytes() for p in np.split(values[order], at[1:])] if len(found) else []
    return pa.table({"block": pa.array(found, pa.int64()), "data": pa.array(parts, pa.binary())})


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False) -> DataFrame:
    """All rows of docs with _words, _removed (long), and the kept words joined by one space: their sha256 as _kept if digest, else in
    place of the text of rows that lose words (others keep theirs byte for byte). window: at least PERIOD words. Columns of docs with these
    three names are left out."""
    spark, docs = docs.sparkSession, docs.drop("_words", "_removed", "_kept")
    blocks = written(packed(docs, id_col, text_col), "blocks", codec="none")
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(partitions(spark), -(-total * 8 * len(COVER) // (6 * PERIOD * BUCKET_BYTES)))

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                kinds = np.unique(Block(payload.as_buffer(), text_col, lexicon, window).anchors()[1])
                rows = [(b, block, part.tobytes()) for b, part in _dealt(kinds, kinds >> U64(20), buckets)]
                if rows:
                    yield _rows(*zip(*rows, strict=True))

    def send_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            for block, payload, parts in zip(batch.column("block").to_pylist(), batch.column("payload"), batch.column("data").to_pylist(), strict=True):
                own = Block(payload.as_buffer(), text_col, lexicon, window)
                ids = own.rows.column(id_col).cast(pa.int64()).fill_null(LAST).to_numpy()
                firsts, later = own.firsts(np.sort(_joined(parts, "<u8")), ids)
                rows = [(b, block, _compact(part)) for b, part in _dealt(firsts, firsts["h1"], buckets)]
                if len(later):
                    rows.append((-1 - block % buckets, block, later.tobytes()))
                if rows:
                    yield _rows(*zip(*rows, strict=True))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            for payload, parts in zip(batch.column("payload"), batch.column("data").to_pylist(), strict=True):
                own = Block(payload.as_buffer(), text_col, lexicon, window)
                gone = own.covered(_joined(parts, "<u4").astype(np.int64))
                removed, out = [], []
                for text, a, b in zip(own.texts, own.starts, own.ends, strict=True):
                    mask = gone[a:b]
                    n = int(mask.sum())
                    removed.append(n)
                    if n or digest:
                        words = text.split() if text else []
                        text = b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if not m] if n else words)
                    out.append(hashlib.sha256(text).hexdigest() if digest else text)
                columns = {c: own.rows.column(c) for c in names}
                if digest:
                    columns["_kept"] = pa.array(out, pa.string())
                else:
                    columns[text_col] = pa.array(out, pa.binary()).cast(pa.string())
                columns |= {"_words": pa.array(own.counts, pa.int64()), "_removed": pa.array(removed, pa.int64())}
                yield from pa.table(columns).combine_chunks().to_batches(max_chunksize=2000)

    def gathered(df: DataFrame) -> DataFrame:
        return df.groupBy("block").agg(F.collect_list("data").alias("data"))

    names = [c for c in docs.columns if not (digest and c == text_col)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    plain = "bucket long, block long, data binary"
    anchors = blocks.select("block", "payload").mapInArrow(tidy(send_anchors), plain)
    shared = anchors.groupBy("bucket").applyInArrow(_met_twice, "block long, data binary")
    firsts = blocks.join(gathered(shared), "block", "left").select("block", "payload", "data").mapInArrow(tidy(send_firsts), plain)
    later = firsts.groupBy("bucket").applyInArrow(_preceded, "block long, data binary")
    schema = f"{fields}, {'_kept string, ' if digest else ''}_words long, _removed long"
    return blocks.join(gathered(later), "block", "left").select("block", "payload", "data").mapInArrow(tidy(emit), schema)


def kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs without the words of later windows: the same rows and columns."""
    own, (key, text) = plain(docs, id_col, text_col)
    return deduplicated(own, key, text, window).select(own.columns).toDF(*docs.columns)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(ids_and_texts(table(spark, sf_dir, "documents")), digest=True)
    return out.select("doc_id", F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"), F.col("_kept").alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) w FROM documents),
runs AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, CAST(i AS BIGINT), CAST(i + 19 AS BIGINT)), ' ')) g FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 18)) i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) p FROM later)),
lost AS (SELECT doc_id, count(*) n, list(p) ps FROM gone GROUP BY 1),
placed AS (SELECT doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) t FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n, 0) AS BIGINT) n_removed, sha256(coalesce(t, '')) kept_sha256
FROM docs LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
