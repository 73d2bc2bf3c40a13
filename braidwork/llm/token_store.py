"""Token-id output in a bit-plane shuffled store.

Ids of whole documents, each ended by one id, are packed in ascending doc_id order into chunks of at least CHUNK_IDS
ids (a chunk ends where a document ends). Within a chunk ids are cut into blocks of BLOCK_IDS; a block is transposed into
byte planes, or, on demand, bit planes; each plane is compressed with zstandard. The store is a folder of two tables that any store
Spark can write to will hold: `chunks` (shard, chunk, ids before it in its shard, n_ids, plane kind, document ids and lengths, blocks of planes) and `index`
(shard, ids before it, ids, documents), the latter as small as the number of shards. Readers join the index alone; planes never move.

Shards are ranges of (doc_id, hash of the text, place in the input) of about SHARD_BYTES of text, so that no id, repeated or null, fills a shard.

Defined edge cases: null and empty texts are the end id alone; null doc_ids come first; rows with one doc_id follow each other by hash of the text, then as
they lie in the input; an empty table gives an empty store; a very long text is one document of one chunk, as large as its ids; columns other than
the two are not read, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, partitions, scratch, shared, slices, table, tidy

CHUNK_IDS, BLOCK_IDS, LEVEL = 1 << 17, 1 << 14, 3
#: Text of a shard, and rows of the index that are broadcast (12 bytes each).
SHARD_BYTES, MOST_SHARDS = 16 << 20, 1_000_000
END = 1
CHUNKS = "shard int, chunk int, before long, n_ids long, kind string, doc_ids array<long>, lengths array<long>, blocks array<struct<n:int,planes:array<binary>>>"


#: Letters of scripts below U+0250 (not the signs U+00D7 and U+00F7), then ASCII signs other than the apostrophe: two pre-tokens at most, whose bounds are certain.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
#: The parts of a tokenizer file that make PLAIN certain.
STEPS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]
#: What TextEncoder leaves to WordEncoder, to the end of its stretch: all but such letters (U+0130 has no single lower case), digits, signs and spaces.
ODD = re.compile("[^A-Za-z0-9 !-&(-/:-@\\[-`{-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][^ ]*")
SIGNS, DIGITS = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'"], "0123456789"
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Ids of texts.

    Where the file's steps are those of STEPS, the tokenizer drops white space and cuts there, so stretches between white space are encoded alone, and
    in each slice of texts every kind once. Plain stretches, whose cuts are certain, are encoded many at a time, parted at the ids that end a
    word. Stretches met in several slices are remembered, up to MOST_BYTES of them. With any other file whole texts are encoded."""

    MOST_BYTES, YOUNG_BYTES, JOINED = 12 << 20, 24 << 20, 2048

    def __init__(self, json_text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text)
        # not the library's default: a text that spells a control token is text, and must not end a document in the store
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        self.known_bytes = self.young_bytes = 0
        made = json.loads(json_text)
        kinds = tuple([x["type"] for x in (made.get(k) or {}).get(part, [])] for k, part in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
        self.plain = kinds == STEPS and made["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": CUTS} and made["model"]["type"] == "BPE"
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        if mark := made["model"].get("end_of_word_suffix"):
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(mark)]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that are one pre-token each."""
        out = {}
        for i in range(0, len(parts), self.JOINED):
            own = parts[i : i + self.JOINED]
            ids = np.frombuffer(self._whole([" ".join(own)])[0], "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(own) or not len(cuts) or cuts[-1] != len(ids):
                out.update(zip(own, self._whole(own), strict=True))
                continue
            data, at = ids.tobytes(), (cuts * 4).tolist()
            out.update(zip(own, [data[a:b] for a, b in zip([0, *at], at, strict=False)], strict=True))
        return out

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        odd, split, parts = [], [], set()
        certain = self.plain and self.ends.any()
        for w in words:
            plain = w.isascii()
            if certain and plain and w.isalpha():
                split.append((w, w.lower(), ""))
                continue
            m = PLAIN.fullmatch(w) if certain else None
            if m is None or not (plain or unicodedata.normalize("NFC", m[1]).lower().isalpha()):
                odd.append(w)
            else:
                # ASCII letters have the ids of their lower case, so that most parts have been met alone
                split.append((w, m[1].lower() if plain else m[1], m[2]))
        parts.update([x[1] for x in split], [x[2] for x in split])
        parts.discard("")
        ids = {x: own for x in parts if (own := self.known.get(x) or self.young.get(x))}
        ids.update(self._parts(list(parts.difference(ids))))
        ids[""] = b""
        out = {w: ids[letters] + ids[signs] for w, letters, signs in split}
        for i in range(0, len(odd), 4096):
            out.update(zip(odd[i : i + 4096], self._whole(odd[i : i + 4096]), strict=True))
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.plain:
            return self._whole([t or "" for t in texts])
        parted = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if t else [] for t in texts]
        known, young = self.known, self.young
        every = set().union(*parted)
        held = {w: own for w in every if (own := known.get(w)) is not None}
        new = every.difference(held)
        again = {w: young[w] for w in new if w in young}
        new = self._learned([w for w in new if w not in again])
        if self.known_bytes <= self.MOST_BYTES:
            known.update(again)
            self.known_bytes += _bytes(again)
        else:
            new |= again
        if self.young_bytes > self.YOUNG_BYTES:
            young.clear()
            self.young_bytes = 0
        young.update(new)
        self.young_bytes += _bytes(new)
        held |= again
        held |= new
        get = held.__getitem__
        return [b"".join(map(get, words)) for words in parted]


def marked_ranks(json_text: str) -> dict[bytes, int] | None:
    """The file's tokens as bytes, "\\n" for the end of a word, by id; None where merging by ids might give other ids than the file's merges.

    Merging the neighbours whose joined bytes have the least id is the same as merging by the file's list if that list makes each of its
    tokens, taken alone, one piece: two neighbours that join to a token are then what the list itself has left of that token."""
    from tokenizers.models import BPE

    made = json.loads(json_text)
    model = made["model"]
    end = model.get("end_of_word_suffix")
    plain = WordEncoder(json_text).plain
    if not plain or not end or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    vocab, merges = model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    joined = [a + b for a, b in merges]
    order = [vocab.get(t, -1) for t in joined]
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    by_char = {chr(b): b for b in printed} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
    first = [vocab.get(c + e, 1 << 31) for c in by_char for e in ("", end)]
    if not order or order != sorted(set(order)) or max(first) >= order[0] or set(vocab.values()) != {*first, *order}:
        return None
    alone, ended = BPE(vocab, merges), BPE(vocab, merges, end_of_word_suffix=end)
    for t in joined:
        got = ended.tokenize(t[: -len(end)]) if t.endswith(end) else alone.tokenize(t)
        if len(got) != 1 or got[0].value != t:
            return None
    out = {}
    for t, i in vocab.items():
        body = bytes(by_char[c] for c in (t[: -len(end)] if t.endswith(end) else t))
        if b"\n" not in body:  # white space is never part of a word
            out[body + b"\n" * t.endswith(end)] = i
    return out


class TextEncoder:
    """Ids of texts, as WordEncoder gives them. Where marked_ranks() holds, the end of each pre-token is marked in the text itself, and a text is
    merged in one pass, without a look-up of its words; stretches with other characters than those of PLAIN and digits go to WordEncoder."""

    MARK = "\x01"

    def __init__(self, json_text: str, ranks: dict[bytes, int] | None):
        self.words, self.coder = WordEncoder(json_text), None
        if ranks:
            import tiktoken

            # the special token is one that never occurs: an empty list of them would be looked for at each place
            self.coder = tiktoken.Encoding("marked", pat_str="[^\n]+\n", mergeable_ranks=ranks, special_tokens={"\x02": max(ranks.values()) + 1})
            self.mark = ranks[self.MARK.encode() + b"\n"]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.coder is None:
            return self.words.ids(texts)
        odd: list[str] = []
        out = [self._ids(t, odd) if t else (b"", None) for t in texts]
        rest = iter(self.words.ids(odd))
        return [data if cuts is None else b"".join([x for a, b in zip([0, *cuts], cuts, strict=False) for x in (data[a : b - 4], next(rest))] + [data[cuts[-1] :]]) for data, cuts in out]

    def _ids(self, text: str, odd: list[str]) -> tuple[bytes, list[int] | None]:
        """Ids of a text, and the bytes after each place where those of the next of `odd` belong."""
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        n, at, parts = len(odd), 0, []
        for m in ODD.finditer(text):
            a = text.rfind(" ", at, m.start()) + 1 or at
            parts += text[at:a], self.MARK
            at = m.end()
            odd.append(text[a:at])
        text = "".join([*parts, text[at:]]).lower()
        for c in SIGNS:
            if c in text:
                text = text.replace(c, f"\n{c}\n")
        text = text.replace("\n\n", "")  # neighbouring signs are one pre-token, neighbouring digits are not
        for c in DIGITS:
            if c in text:
                text = text.replace(c, f"\n{c}\n")
        ids = self.coder.encode_to_numpy(text.replace(" ", "\n") + "\n", disallowed_special=()).astype("<u4", copy=False)
        return ids.tobytes(), ((np.flatnonzero(ids == self.mark) + 1) * 4).tolist() if len(odd) > n else None


def _bytes(held: dict[str, bytes]) -> int:
    return sum(map(len, held)) + sum(map(len, held.values())) + 64 * len(held)


def planes(ids: np.ndarray, kind: str, level: int = LEVEL) -> list[bytes]:
    """A block's compressed planes: 4 of bytes or 32 of bits, lowest first."""
    press = zstandard.ZstdCompressor(level=level)
    rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").reshape(4, -1, 8).transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    return [press.compress(r.tobytes()) for r in rows]


def unplanes(n: int, parts: list[bytes], kind: str) -> np.ndarray:
    press = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(press.decompress(p), np.uint8) for p in parts]) if n else np.zeros((len(parts), 0), np.uint8)
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little", count=n).reshape(4, 8, n).transpose(0, 2, 1).reshape(4, -1)
        rows = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(rows.T).reshape(-1).view("<u4")


def write_store(docs: DataFrame, path: str, tokenizer_json: str, end: int = END, kind: str = "byte", block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS) -> None:
    """Encode docs (doc_id, text) and write the store at `path`. Ranges of doc_id are the shards."""
    spark = docs.sparkSession
    shards = max(partitions(spark), -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES))
    coders = shared(spark, (tokenizer_json, marked_ranks(tokenizer_json)), lambda x: TextEncoder(*x))
    tail = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, chunk, before = coders(), TaskContext.get().partitionId(), 0, 0
        keys, lengths, parts, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            cut = [{"n": len(b), "planes": planes(b, kind)} for b in (ids[i : i + block_ids] for i in range(0, len(ids), block_ids))]
            row = {"shard": [shard], "chunk": [chunk], "before": [before], "n_ids": [len(ids)], "kind": [kind], "doc_ids": [keys], "lengths": [lengths], "blocks": [cut]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))])))]))

        for whole in batches:
            for batch in slices(whole):
                for key, ids in zip(batch.column("doc_id").to_pylist(), coder.ids(batch.column("text").to_pylist()), strict=True):
                    ids += tail
                    keys.append(key)
                    lengths.append(len(ids) // 4)
                    parts.append(ids)
                    total += len(ids) // 4
                    if total >= chunk_ids:
                        yield flush()
                        keys, lengths, parts, total, chunk, before = [], [], [], 0, chunk + 1, before + total
        if keys:
            yield flush()

    order = F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_at")
    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_at"))
    ranged = placed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(tidy(encode), CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")
    sizes = read_chunks(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("doc_ids")).alias("n_docs")).orderBy("shard").collect()
    before, rows = 0, []
    for r in sizes:
        rows.append((r.shard, before, r.n_ids, r.n_docs))
        before += r.n_ids
    spark.createDataFrame(rows, "shard int, start long, n_ids long, n_docs long").coalesce(1).write.parquet(f"{path}/index")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(f"{path}/chunks")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (binary, little-endian unsigned 32-bit) of each document, from the files alone."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.concatenate([unplanes(b["n"], b["planes"], r["kind"]) for b in r["blocks"]]).tobytes() if r["blocks"] else b""
                ends = np.cumsum(r["lengths"])
                starts = ends - r["lengths"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["start"] + r["before"] + starts, pa.int64()), pa.array(r["lengths"], pa.int64()), pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    chunks = read_chunks(spark, path)
    # ids before each chunk: those before its shard, from the index (a row a shard), and those before it in the shard
    index = spark.read.schema("shard int, start long, n_ids long, n_docs long").parquet(f"{path}/index").select("shard", "start")
    placed = chunks.join(F.broadcast(index) if index.count() <= MOST_SHARDS else index, "shard")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-store")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        write_store(ids_and_texts(table(spark, sf_dir, "documents")), path, f.read())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [zlib.crc32(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_store(spark, path).mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")
