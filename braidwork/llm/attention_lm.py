"""LM scoring: a causal self-attention model on subword ids, trained in numpy.

Words are spelt as the ids of a public byte-level vocabulary, each with a space before it, and a text ends with one end id. One attention
layer and one hidden layer predict the class of the next id from the ids before it in a window; frequent ids are classes of their own,
the rest are clustered by their neighbours. The chance of an id within its class comes from counts over all training documents.

Texts are cut into windows of WINDOW ids that overlap by KEEP, so that each id is scored once, with at least KEEP ids before it where the text
has them; windows are scored in batches with one mask. Since classes tell ids that begin a word from those that go on with
one, ids add up to a proper chance of each word, and the model's chance of a word is MIX of the add-one unigram and the rest of
attention, MIX being fitted by expectation maximisation.

Word counts cover all training documents. The FREQUENT most frequent words, a bounded table, are broadcast; scores of all other words are
finished by a shuffled join with the whole table. Texts are spelt once, into a scratch table of ids, from which all else is counted, learned and scored; ids
tell words, as those that begin one hold its space. The network and the id classes are learned from every id of every training document;
a text is read where it lies, and no window spans two. Training goes in ROUNDS rounds over disjoint parts of the documents: each task takes
steps on all windows of its own texts, LEAST_STEPS at least (small inputs are gone through again), and the mean of all tasks' weights, by ids
seen, begins the next round. MIX is fitted on every word of every training document, counted in cells of 1 / FINE nats.

Caches of words are bounded by bytes.

Defined edge cases: null and empty texts are the end alone; documents with a null id are scored and not learned from; repeated rows are
scored alike and each count; with no training documents every count is 0 and scores are those of the untrained model; an empty table
gives no rows; ids of equal frequency are ordered by number, so classes do not depend on order; a very long text is one row whose words are in memory
at once; columns other than the two are not read, whatever their names.
"""

from __future__ import annotations

import base64
import re
import struct
from collections import Counter
from collections.abc import Callable, Iterator
from copy import deepcopy
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, ids_and_texts, mixed, raw_texts, roomy, shared, slices, table, written

WINDOW, KEEP, WIDTH, HIDDEN = 48, 12, 24, 32
FREQUENT = 1 << 17
ROUNDS, LEAST_STEPS, STEP, BATCH, STEP_BATCH, GROUPS = 3, 100, 4e-3, 64, 64, 16
#: One in so many ids of a training document is learned from: all of them.
SHARE = 1
#: Text bytes that are cut into words and spelt at a time: few, so that words are still near when they are looked up.
WORDS_BYTES = 128 << 10
#: Bytes of stored ids that a worker turns into arrays at a time, as many ids as SLICE_BYTES of text give.
IDS_BYTES = 3 << 20
#: Longest word in the broadcast table, and bytes of a worker's cache of spelt words.
FREQUENT_BYTES, CACHE_BYTES = 64, 40 << 20
#: Cells of the mixture's statistics: by attention against unigram, from LEAST_REL nats on, and by lift, from LEAST_LIFT on.
FINE, LEAST_REL, RELS, LEAST_LIFT, LIFTS = 32, -32, 48 * 32, -16, 32 * 32
GAPS = ((1, 0), (2, 1), (3, 1), (5, 1), (8, 1))
OWN, SINGLES, CLUSTERS = 6000, (32, 16), (24, 16)
ODD_SPACE = re.compile(r"[^\S\x20\x09-\x0D]")
END_WORD, LN10 = "\n", float(np.log(10))
FOLDS, HELD = 7, 2


class Speller:
    """Word bytes -> ids, little-endian unsigned 32-bit; keeps what it has met, up to a bound of bytes, and then what it met first.

    Words not met before are encoded many at a time, in one text: each begins with a space, where the pattern always cuts, but for white space
    beyond ASCII, so words that hold such are encoded alone."""

    def __init__(self, ranks: bytes, pattern: str, most: int = CACHE_BYTES):
        import tiktoken

        made = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, ranks.splitlines())))}
        self.end, self.most, self.size = len(made), most, 0
        self.known: dict[bytes, bytes] = {}
        self.stored = stored(self.end)
        self.coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=made, special_tokens={})
        self.leads = np.zeros(self.end + 1, bool)
        self.leads[[i for t, i in made.items() if t[:1] == b" "] + [self.end]] = True
        self.lengths = np.zeros(self.end + 1, np.int64)
        self.lengths[list(made.values())] = [len(t) for t in made]
        self.tokens = [b""] * (self.end + 1)
        for t, i in made.items():
            self.tokens[i] = t

    def _alone(self, word: str) -> bytes:
        ids = self.coder.encode_ordinary(" " + word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[bytes]) -> None:
        if self.size > self.most:
            # frequent words are met early: the first half stays
            kept = [*islice(self.known.items(), len(self.known) // 2)]
            self.known.clear()
            self.known.update(kept)
            self.size = sum(len(w) for w, _ in kept) * 2 + 150 * len(kept)
        for i in range(0, len(words), 4096):
            own = words[i : i + 4096]
            whole = b" ".join([b"", *own]).decode("utf-8", "replace")
            if ODD_SPACE.search(whole) or "\ufffd" in whole:
                texts = [w.decode("utf-8", "replace") for w in own]
                plain = [k for k, t in enumerate(texts) if t.isascii() or not ODD_SPACE.search(t)]
                self.known.update((own[k], self._alone(texts[k])) for k in set(range(len(own))).difference(plain))
                own, whole = [own[k] for k in plain], "".join([" " + texts[k] for k in plain])
                sizes = [len(texts[k].encode()) for k in plain]
            else:
                sizes = [*map(len, own)]
            ids = self.coder.encode_to_numpy(whole, disallowed_special=()).astype("<u4", copy=False)
            at = ((np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(np.array(sizes, np.int64) + 1)) + 1) * 4).tolist()
            data = ids.tobytes()
            self.known.update(zip(own, [data[a:b] for a, b in zip([0, *at], at, strict=False)], strict=True))
        self.size += sum(map(len, words)) * 2 + 150 * len(words)

    def spelt(self, words: list[bytes]) -> list[bytes]:
        return self.all_spelt([words])[0]

    def all_spelt(self, texts: list[list[bytes]]) -> list[list[bytes]]:
        """spelt() of each text; all that is new at once."""
        get = self.known.get
        found = [[*map(get, words)] for words in texts]
        misses = [[i for i, ids in enumerate(spelt) if ids is None] for spelt in found]
        new = {words[i] for words, some in zip(texts, misses, strict=True) for i in some}
        if new:
            self._learn([*new])
            for words, spelt, some in zip(texts, found, misses, strict=True):
                for i in some:
                    spelt[i] = self.known[words[i]]
        return found


def stored(end: int) -> str:
    """Type of the ids of a table, up to that of the end."""
    return "<u2" if end < 1 << 16 else "<u4"


def tokens_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


# ---- counts of all training documents


def word_counts(docs: DataFrame, most: int = 400_000) -> DataFrame:
    """word, c over all docs, from their texts; END_WORD stands for the end of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        size = 0
        for whole in batches:
            for batch in slices(whole):
                size += batch.column("text").nbytes
                for text in raw_texts(batch):
                    counts.update(tokens_of(text))
                    counts[END_WORD.encode()] += 1
                # never more bytes than this in the words held
                if len(counts) > most or size > 128 << 20:
                    yield flush()
                    size = 0
        if counts:
            yield flush()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def starts_in(flat: np.ndarray, sizes: list[int], leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where first ends, words and last ends begin in texts laid end to end, and how many of them each text has."""
    begins = np.flatnonzero(leads.take(flat))
    return begins, np.diff(np.searchsorted(begins, np.cumsum([0, *sizes])))


def packed(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit keys of words flat[starts : starts + sizes]: ids, each and one more so that none is 0, side by side."""
    keys, shift = np.zeros(len(starts), np.uint64), np.uint64(8 * flat.itemsize)
    for k in range(8 // flat.itemsize - 1, -1, -1):
        keys <<= shift
        keys += np.where(sizes > k, flat.take(starts + k, mode="clip").astype(np.uint64) + np.uint64(1), np.uint64(0))
    return keys


def unpacked(keys: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words of packed(), laid end to end, and how many each has."""
    ids = keys.astype("<u8").view(kind).reshape(len(keys), 8 // np.dtype(kind).itemsize)
    return ids[ids > 0] - 1, (ids > 0).sum(axis=1)


def texts_of_ids(speller: Speller) -> pa.Array:
    """Bytes of ids, without the space of those that begin a word."""
    return pa.array([t[1:] if lead else t for t, lead in zip(speller.tokens, speller.leads.tolist(), strict=True)], pa.binary())


def joined(tokens: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Words, so many ids each; tokens: texts_of_ids()."""
    if not len(sizes):
        return pa.array([], pa.string())
    parts = tokens.take(pa.array(ids, pa.int64()))
    ends = np.frombuffer(parts.buffers()[1], "<i4", len(parts) + 1, 4 * parts.offset)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends[np.append(0, np.cumsum(sizes))].tobytes()), parts.buffers()[2]])


def counted(docs: DataFrame, ranks: bytes, pattern: str, most: int = 400_000) -> DataFrame:
    """word_counts() of encoded() texts: words that a 64-bit key has room for are sorted and counted by it, longer ones in a dictionary."""
    sent = shared(docs.sparkSession, (ranks, pattern), lambda x: (lambda s: (texts_of_ids(s), s.leads, s.end))(Speller(*x, most=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, leads, end = sent()
        kind, ends, size, held = stored(end), 0, 0, 0
        keys, often, long = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], Counter()

        def merged() -> None:
            x, c = np.concatenate(keys), np.concatenate(often)
            order = np.argsort(x, kind="stable")
            x = x[order]
            at = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
            keys[:], often[:] = [x[at]], [np.add.reduceat(c[order], at) if len(at) else c]

        def flush() -> Iterator[pa.RecordBatch]:
            merged()
            ids = np.frombuffer(b"".join(long), kind)
            for (of_words, sizes), c in ((unpacked(keys[0], kind), often[0]), ((ids, np.array([len(w) // ids.itemsize for w in long], np.int64)), np.fromiter(long.values(), np.int64, len(long)))):
                yield pa.RecordBatch.from_arrays([joined(tokens, of_words, sizes), pa.array(c, pa.int64())], names=["word", "c"])
            keys[:], often[:] = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            long.clear()

        for whole in batches:
            for batch in slices(whole, "ids", IDS_BYTES):
                texts = batch.column("ids").to_pylist()
                data = b"".join(texts)
                flat = np.frombuffer(data, kind)
                starts, _ = starts_in(flat, [len(x) // flat.itemsize for x in texts], leads)
                sizes = np.diff(starts, append=len(flat))
                words = flat[starts] != end
                ends, size, starts, sizes = ends + len(texts), size + len(data), starts[words], sizes[words]
                short = sizes <= 8 // flat.itemsize
                x, c = np.unique(packed(flat, starts[short], sizes[short]), return_counts=True)
                keys.append(x)
                often.append(c)
                starts, sizes = starts[~short] * flat.itemsize, sizes[~short] * flat.itemsize
                long.update([data[i:j] for i, j in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)])
                held += len(x)
                if held > 2 * most:
                    merged()
                    held = len(keys[0])
                # never more bytes than this in the words held
                if held + len(long) > 2 * most or size > 128 << 20:
                    yield from flush()
                    size = held = 0
        yield from flush()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END_WORD]), pa.array([ends], pa.int64())], names=["word", "c"])

    return docs.select("ids").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def id_counts(counts: DataFrame, ranks: bytes, pattern: str) -> np.ndarray:
    """By subword id, as long as the vocabulary: how often it occurs in the training documents, and how often, with one more for each
    distinct word, it begins a word."""
    sent = counts.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(*sent.value, most=0)
        total = np.zeros((2, speller.end + 1), np.int64)
        for batch in batches:
            words, c = batch.column("word").to_pylist(), batch.column("c").to_numpy()
            if END_WORD in words:
                at = words.index(END_WORD)
                total[0, speller.end] += c[at]
                total[1, speller.end] += c[at] + 1
                del words[at]
                c = np.delete(c, at)
            if words:
                spelt = speller.spelt([w.encode() for w in words])
                sizes = np.array([len(x) // 4 for x in spelt])
                ids = np.frombuffer(b"".join(spelt), "<u4")
                np.add.at(total[0], ids, np.repeat(c, sizes))
                np.add.at(total[1], ids[np.cumsum(sizes) - sizes], c + 1)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[0, some]), pa.array(total[1, some])], names=["id", "n", "first"])

    found = counts.mapInArrow(run, "id long, n long, first long").groupBy("id").agg(F.sum("n").alias("n"), F.sum("first").alias("first")).toArrow()
    out = np.zeros((2, Speller(ranks, pattern).end + 1))
    for k, name in enumerate(("n", "first")):
        out[k, found.column("id").to_numpy()] = found.column(name).to_numpy()
    return out


def runs_of(keys: list[int], texts: list[bytes | None], speller: Speller) -> list[np.ndarray]:
    """What is learned from: the ids of each text, all of them, between two ends."""
    end = np.array([speller.end], "<u4").tobytes()
    return [np.frombuffer(b"".join([end, *spelt, end]), "<i4") for spelt in speller.all_spelt([tokens_of(t) for _, t in zip(keys, texts, strict=True)])]


def encoded(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """docs (doc_id, learn where there is one) with ids, as runs_of() gives them, in place of text."""
    sent = shared(docs.sparkSession, (ranks, pattern), lambda x: Speller(*x))
    kept = docs.select(*(c for c in ("doc_id", "learn") if c in docs.columns), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = sent()
        for whole in batches:
            for batch in slices(whole):
                runs = chain.from_iterable(runs_of(part.column("doc_id").to_pylist(), raw_texts(part), speller) for part in slices(batch, most=WORDS_BYTES))
                ids = pa.array([x.astype(speller.stored).tobytes() for x in runs], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], "ids"])

    return kept.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in kept.drop("text").dtypes) + ", ids binary")


def runs_in(batch: pa.RecordBatch, end: int) -> list[np.ndarray]:
    return [np.frombuffer(x, stored(end)).astype(np.int32) for x in batch.column("ids").to_pylist()]


def all_windows(ids: np.ndarray) -> np.ndarray:
    """(n, WINDOW + 1) ids: all of a text, each after the first once as a target; -1 pads."""
    n = -(-(len(ids) - 1) // WINDOW)
    full = np.pad(ids, (0, n * WINDOW + 1 - len(ids)), constant_values=-1)
    return np.lib.stride_tricks.sliding_window_view(full, WINDOW + 1)[::WINDOW]


def top_ids(often: np.ndarray) -> np.ndarray:
    top = np.argsort(-often, kind="stable")[:OWN]
    return top[often[top] > 0]


def add_contexts(context: np.ndarray, flat: np.ndarray, top: np.ndarray, size: int) -> None:
    """Add to context (top ids by side and near id) what flat holds, texts of ids that GAPS places of -1 part."""
    near = top[:256]
    column, row = np.full(size + 1, -1), np.full(size + 1, -1)
    column[near], row[top] = np.arange(len(near)), np.arange(len(top))
    columns, rows = column[flat], row[flat]
    for gap, side in GAPS:
        a, b = columns[:-gap], rows[gap:]
        ok = (a >= 0) & (b >= 0)
        np.add.at(context.reshape(-1), b[ok] * context.shape[1] + side * len(near) + a[ok], 1)


def parted(texts: list[np.ndarray]) -> np.ndarray:
    gap = np.full(GAPS[-1][0], -1, np.int32)
    return np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap


def contexts(docs: DataFrame, top: np.ndarray, ranks: bytes, pattern: str) -> np.ndarray:
    """How often each of the top ids has each of the most frequent ids before it, next or near, in the texts (or encoded() texts) of all docs."""
    docs = encoded(docs, ranks, pattern) if "text" in docs.columns else docs
    shape, end = (len(top), 2 * min(len(top), 256) + 1), Speller(ranks, pattern).end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape, np.int64)
        for whole in batches:
            for batch in slices(whole, "ids", IDS_BYTES):
                add_contexts(found, parted(runs_in(batch, end)), top, end + 1)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found.ravel()[some], pa.int64())], names=["cell", "c"])

    cells = docs.select("ids").mapInArrow(run, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(shape)
    out.ravel()[cells.column("cell").to_numpy()] = cells.column("c").to_numpy()
    return out


# ---- the network


def classes_of(windows: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """classes_by() from windows alone."""
    top = top_ids(np.bincount(windows[windows >= 0], minlength=len(leads)))
    context = np.zeros((len(top), 2 * min(len(top), 256) + 1))
    add_contexts(context, parted([*windows]), top, len(leads))
    return classes_by(top, context, leads)


def classes_by(top: np.ndarray, context: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Class of each id, number of classes that begin a word (they come first), embedding row of each id."""
    size, rng = len(leads), np.random.default_rng(7)
    row = np.full(size, -1)
    row[top] = np.arange(len(top))
    context = np.log1p(context)
    context /= np.linalg.norm(context, axis=1, keepdims=True) + 1e-9
    own = np.full(size, -1)
    n = 0
    begin = 0
    for lead, singles, clusters in ((True, SINGLES[0], CLUSTERS[0]), (False, SINGLES[1], CLUSTERS[1])):
        kind = [t for t in top if leads[t] == lead and t != size - 1]
        if lead:
            own[size - 1] = n
            n += 1
        for t in kind[:singles]:
            own[t] = n
            n += 1
        rest = np.array(kind[singles:], int)
        if len(rest):
            x = context[row[rest]]
            centres = x[rng.choice(len(rest), min(clusters, len(rest)), replace=False)]
            for _ in range(12):
                at = (x @ centres.T).argmax(1)
                centres = np.stack([x[at == k].mean(0) if (at == k).any() else centres[k] for k in range(len(centres))])
                centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-9
            own[rest] = n + at
            n += len(centres)
        own[(own < 0) & (leads == lead)] = n
        n += 1
        begin = begin or n
    row[row < 0] = len(top) + own[row < 0]
    return own, begin, row


def exponentials(x: np.ndarray) -> None:
    """In place, of attention's scores. They are small, and need no shift by their largest, only a bound in case."""
    if not x.max() <= 60:
        np.minimum(x, 60, out=x)
    np.exp(x, out=x)


def unshifted(z: np.ndarray) -> None:
    """Logits, in place, moved by row only where their exponentials would grow too large."""
    if not z.max() <= 60:
        z -= z.max(axis=1, keepdims=True)


class Network:
    def __init__(self, classes: np.ndarray, begin: int, rows: np.ndarray):
        rng = np.random.default_rng(11)
        self.classes, self.begin, self.rows, n = classes, begin, rows, int(classes.max()) + 1
        normal = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        zeros = lambda *s: np.zeros(s, np.float32)
        self.p = {"e": rng.normal(0, 0.3, (int(rows.max()) + 1, WIDTH)).astype(np.float32), "pos": rng.normal(0, 0.1, (WINDOW, WIDTH)).astype(np.float32), "q": normal(WIDTH, WIDTH), "k": normal(WIDTH, WIDTH), "v": normal(WIDTH, WIDTH), "o": normal(WIDTH, WIDTH), "w1": normal(WIDTH, HIDDEN), "b1": zeros(HIDDEN), "w2": normal(HIDDEN, WIDTH), "out": normal(WIDTH, n) * 0.3, "bias": zeros(n)}
        self.kinds = np.stack([np.arange(n) < begin, np.ones(n)], axis=1).astype(np.float32)
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    def merged(self) -> tuple[np.ndarray, ...]:
        """Of p: query and key in one matrix, value and output in one, out with columns of zeros up to whole vectors of 16, and the
        exponentials of bias, 0 for those columns: chances are the exponentials of g @ out by these, so that no pass adds a bias."""
        p, n = self.p, self.p["out"].shape[1]
        out = np.zeros((WIDTH + 1, n + -n % 16), p["out"].dtype)
        out[:-1, :n], out[-1, :n] = p["out"], np.exp(p["bias"])
        return p["q"] @ p["k"].T * out.dtype.type(WIDTH**-0.5), p["v"] @ p["o"], out[:-1], out[-1]

    def ready(self) -> "Network":
        """Tables for chances(): each embedding and each place as query, key and value, so that scoring only adds them."""
        p, (ask, give, self.out, self.usual) = self.p, self.merged()
        self.by_id, self.by_place = ([np.ascontiguousarray(x @ m) for m in (ask, np.eye(WIDTH, dtype=ask.dtype), give)] for x in (p["e"], p["pos"]))
        self.sums = np.pad(self.kinds, ((0, len(self.usual) - len(self.kinds)), (0, 0))) * self.usual[:, None]
        return self

    def hidden(self, h: np.ndarray, n: int) -> np.ndarray:
        """The hidden layer; n divides the rows of h."""
        u = h @ self.p["w1"]
        # rows of n positions at a time, as short ones and single numbers take long
        rows = u.reshape(-1, n * HIDDEN)
        rows += np.tile(self.p["b1"], n)
        np.maximum(rows, np.zeros(n * HIDDEN, u.dtype), out=rows)
        return u

    def chances(self, ids: np.ndarray, targets: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs at positions skip..: of the target's class, and of a class that begins a word. After ready()."""
        p, (b, n), w = self.p, ids.shape, WIDTH
        m, rows = n - skip, self.rows.take(ids)
        query, key, value = (t.take(at, axis=0) for t, at in zip(self.by_id, (rows[:, skip:], rows, rows), strict=True))
        for x, t, k in zip((query, key, value), self.by_place, (skip, 0, 0), strict=True):
            x.reshape(b, -1)[:] += t[k:n].ravel()
        s = query @ key.transpose(0, 2, 1)
        exponentials(s)
        s *= self.seen[skip:n, :n]
        h = (s @ value).reshape(b * m, w)
        h /= (s.reshape(b * m, n) @ np.ones(n, s.dtype))[:, None]
        h += key[:, skip:].reshape(b * m, w)
        h += self.hidden(h, m) @ p["w2"]
        z = h @ self.out
        unshifted(z)
        classes = self.classes.take(targets.ravel())
        own = z.ravel().take(np.arange(0, z.size, z.shape[1]) + classes) + p["bias"].take(classes)
        np.exp(z, out=z)
        sums = np.log(np.maximum(z @ self.sums, 1e-30))
        return (own - sums[:, 1]).reshape(b, m), (sums[:, 0] - sums[:, 1]).reshape(b, m)

    def slopes(self, ids: np.ndarray, targets: np.ndarray, some: np.ndarray) -> dict:
        """Of the mean loss where `some` holds, by parameter; of embeddings only those met, "rows"."""
        p, (b, n), w = self.p, ids.shape, WIDTH
        (ask, give, out, usual), kind = self.merged(), self.p["e"].dtype
        rows = self.rows.take(ids.ravel())
        # rows are few enough for 16 bits, which sort by counting
        order = np.argsort(rows.astype(np.uint16) if len(p["e"]) < 1 << 16 else rows, kind="stable")
        ordered = rows.take(order)
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        met, place = ordered.take(at), np.empty(len(p["e"]), np.int64)
        place[met] = np.arange(len(met))
        place = place.take(rows)

        # each embedding met is multiplied once; a last column of ones in values takes what is constant along the way back
        e, pos = p["e"].take(met, axis=0), p["pos"][:n]
        column = lambda x, last: np.concatenate([x, np.full((len(x), 1), last, kind)], axis=1)
        query, key, value = ((x.take(place, axis=0).reshape(b, -1) + y.ravel()).reshape(b, n, -1) for x, y in ((e @ ask, pos @ ask), (e, pos), (column(e @ give, 0), column(pos @ give, 1))))
        s = query @ key.transpose(0, 2, 1)
        exponentials(s)
        s *= self.seen[:n, :n]
        # weights stay undivided by their sums
        part = (1 / (s.reshape(b * n, n) @ np.ones(n, kind)))[:, None]
        a = (s @ value[:, :, :w]).reshape(b * n, w)
        a *= part
        h = a + key.reshape(b * n, w)
        u = self.hidden(h, n)
        g = u @ p["w2"]
        g += h
        z = g @ out
        unshifted(z)
        np.exp(z, out=z)
        sums, classes = z @ usual, self.classes.take(targets.ravel())
        z.ravel()[np.arange(0, z.size, z.shape[1]) + classes] -= sums / usual.take(classes)
        share = (some.ravel() / (sums * max(some.sum(), 1))).astype(kind)
        dg = z @ (out * usual).T
        dg *= share[:, None]
        g *= share[:, None]
        classes = p["out"].shape[1]
        d = {"out": (g.T @ z * usual)[:, :classes], "bias": (share @ z * usual)[:classes], "w2": u.T @ dg}
        du = dg @ p["w2"].T
        du *= (u > 0).astype(kind)
        d |= {"w1": h.T @ du, "b1": np.ones(b * n, kind) @ du}
        dg += du @ p["w1"].T
        da = np.empty((b * n, w + 1), kind)
        np.multiply(dg, part, out=da[:, :w])
        a *= dg
        np.multiply(a @ np.ones(w, kind), -part.ravel(), out=da[:, w])
        da = da.reshape(b, n, w + 1)
        ds = da @ value.transpose(0, 2, 1)
        ds *= s
        both = np.empty((b, n, 2 * w), kind)
        np.matmul(ds, key, out=both[:, :, :w])
        np.matmul(s.transpose(0, 2, 1), da[:, :, :w], out=both[:, :, w:])
        dx = (ds.transpose(0, 2, 1) @ query).reshape(b * n, w)
        dx += dg
        both = both.reshape(b * n, 2 * w)
        dx += both @ np.concatenate([ask, give], axis=1).T
        d_ask, d_give = np.split(key.reshape(b * n, w).T @ both, 2, axis=1)
        d_ask *= kind.type(w**-0.5)
        d |= {"q": d_ask @ p["k"], "k": d_ask.T @ p["q"], "v": d_give @ p["o"].T, "o": p["v"].T @ d_give}
        d["pos"] = np.zeros_like(p["pos"])
        d["pos"][:n] = dx.reshape(b, n * w).sum(0).reshape(n, w)
        return d | {"rows": met, "e": np.add.reduceat(dx.take(order, axis=0), at)}

    def prior(self, often: np.ndarray) -> None:
        """Begin with the chances of classes that ids counted so often give."""
        n = np.bincount(self.classes, often, self.p["out"].shape[1]) + 1.0
        self.p["bias"] = np.log(n / n.sum()).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()]).astype(np.float32)

    def unflat(self, flat: np.ndarray) -> None:
        ends = np.cumsum([x.size for x in self.p.values()])
        self.p = {k: part.reshape(x.shape).astype(np.float32) for (k, x), part in zip(self.p.items(), np.split(flat, ends[:-1]), strict=True)}


class Adam:
    """Steps of a network, whose dense parameters become parts of one array."""

    def __init__(self, network: Network):
        self.network, self.t = network, 0
        self.dense = [k for k in network.p if k != "e"]
        whole = np.concatenate([network.p[k].ravel() for k in self.dense])
        for k, part in zip(self.dense, np.split(whole, np.cumsum([network.p[k].size for k in self.dense])[:-1]), strict=True):
            network.p[k] = part.reshape(network.p[k].shape)
        self.held = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (whole, network.p["e"])]

    def step(self, rate: float, ids: np.ndarray, targets: np.ndarray, some: np.ndarray) -> None:
        self.t = t = self.t + 1
        slopes = self.network.slopes(ids, targets, some)
        # embeddings that were not met stay as they are
        for (p, m, v), at, g in zip(self.held, (None, slopes["rows"]), (np.concatenate([slopes[k].ravel() for k in self.dense]), slopes["e"]), strict=True):
            own = (m, v) if at is None else (m.take(at, axis=0), v.take(at, axis=0))
            own[0][:] += (g - own[0]) * np.float32(0.1)
            g *= g
            own[1][:] += (g - own[1]) * np.float32(0.01)
            if at is not None:
                m[at], v[at] = own
            x = np.sqrt(own[1] * np.float32(1 / (1 - 0.99**t)))
            x += np.float32(1e-8)
            np.divide(own[0] * np.float32(rate / (1 - 0.9**t)), x, out=x)
            if at is None:
                p -= x
            else:
                p[at] -= x


def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of weights (n, p), by n."""
    n, total = 0, None
    for batch in batches:
        for k, p in zip(batch.column("n").to_pylist(), batch.column("p"), strict=True):
            part = np.frombuffer(p.as_buffer(), "<f4") * float(k)
            n, total = n + k, part if total is None else total + part
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(total / n).astype("<f4").tobytes()], pa.binary())], names=["n", "p"])


def learned(docs: DataFrame, network: Network, ranks: bytes, pattern: str) -> int:
    """Train the network on the whole texts (or encoded() texts) of docs; how many ids it was trained to tell."""
    docs = encoded(docs, ranks, pattern) if "text" in docs.columns else docs
    seen = 0
    for r in range(ROUNDS):
        sent = shared(docs.sparkSession, network)
        run = _learner(sent, STEP / 3**r)
        own = docs.where(F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(ROUNDS)) == r)
        # as many sums reach the driver as there are groups, however many tasks there are
        sums = own.mapInArrow(run, "n long, p binary").repartition(GROUPS).mapInArrow(means, "n long, p binary").toArrow()
        for part in means(iter(sums.to_batches())):
            network.unflat(np.frombuffer(part.column("p")[0].as_py(), "<f4"))
            seen += part.column("n")[0].as_py()
    return seen


def _learner(sent: Callable, rate: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roomy()
        network, rng, n = deepcopy(sent()), np.random.default_rng(TaskContext.get().partitionId()), 0
        adam = Adam(network)

        def learn(windows: np.ndarray) -> int:
            some = windows[:, 1:] >= 0
            adam.step(rate * min(1, (adam.t + 1) / 20), np.maximum(windows[:, :-1], 0), np.maximum(windows[:, 1:], 0), some)
            return int(some.sum())

        again: list[np.ndarray] = []
        for whole in batches:
            for batch in slices(whole, "ids", IDS_BYTES):
                windows = np.concatenate([np.zeros((0, WINDOW + 1), np.int32), *map(all_windows, runs_in(batch, len(network.classes) - 1))])
                windows = windows[rng.permutation(len(windows))]
                for i in range(0, len(windows), STEP_BATCH):
                    n += learn(windows[i : i + STEP_BATCH])
                    if len(again) < LEAST_STEPS:
                        again.append(windows[i : i + STEP_BATCH])
        while again and adam.t < LEAST_STEPS:
            learn(again[adam.t % len(again)])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([network.flat().tobytes()], pa.binary())], names=["n", "p"])

    return run


def windowed(ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(inputs, places of their targets in ids, positions to skip) for texts laid end to end, each with an end id before its first.

    ids[place] of text i lies at starts[i] .. starts[i] + lengths[i]; the id before its first place is the start mark."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    for first in (True, False):
        if first:
            at, room = starts, lengths
        else:
            more = np.maximum(0, -(-(lengths - WINDOW) // (WINDOW - KEEP)))
            doc = np.repeat(np.arange(len(lengths)), more)
            step = np.arange(len(doc)) - np.repeat(np.cumsum(more) - more, more)
            shift = WINDOW + step * (WINDOW - KEEP) - KEEP
            at, room = starts[doc] + shift, lengths[doc] - shift
        skip = 0 if first else KEEP
        order = np.argsort(room, kind="stable") if first else np.arange(len(at))
        for i in range(0, len(at), BATCH):
            own = order[i : i + BATCH]
            n = min(WINDOW, int(room[own].max()))
            place = at[own][:, None] + np.arange(n)
            yield place, (np.arange(n) < room[own][:, None])[:, skip:], skip


class Scorer:
    """Natural log chances of words from attention: of the word, and of its class against the unigram's chance of that class."""

    def __init__(self, network: Network, within: np.ndarray, usual: np.ndarray):
        self.network, self.within, self.usual = network, within, usual

    def words(self, spelt: list[list[bytes]], end: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, given as ids of each word: (log chances, lifts of the class) of its words, then of its end."""
        mark = np.array([end], "<u4").tobytes()
        ids = np.frombuffer(b"".join(x for words in spelt for x in (mark, *words, mark)), "<u4").astype(np.int64)
        sizes = [np.array([1, *(len(w) // 4 for w in words), 1], np.int64) for words in spelt]
        items = np.array([len(x) for x in sizes], np.int64)
        att, lift = self.of_ids(ids, np.cumsum(x := np.concatenate(sizes)) - x, items)
        ends = np.cumsum(items)
        return [(att[i + 1 : j], lift[i + 1 : j]) for i, j in zip(ends - items, ends, strict=True)]

    def of_ids(self, ids: np.ndarray, starts: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """words() of texts laid end to end, each between two ends, as two arrays in which those of each text come after a place without
        meaning; starts: where first ends, words and last ends begin; items: how many of them each text has."""
        last = np.cumsum(items) - 1
        lengths = starts[last] - starts[last - items + 1]
        kind, begins = np.zeros(len(ids)), np.zeros(len(ids))
        for place, some, skip in windowed(ids, lengths):
            inputs = ids.take(place, mode="clip")
            targets = place[:, skip:] + 1
            a, b = self.network.chances(inputs, ids.take(targets, mode="clip"), skip)
            if some.all():
                kind[targets], begins[targets] = a, b
            else:
                at = targets[some]
                kind[at], begins[at] = a[some], b[some]
        begun = begins[starts]
        after = np.append(begun[1:], 0.0)
        after[last] = 0
        lift = kind[starts] - begun - self.usual[self.network.classes[ids[starts]]]
        return np.add.reduceat(kind + self.within[ids], starts) - begun + after, lift


def cells_of(rel: np.ndarray, lift: np.ndarray) -> np.ndarray:
    a = np.clip(np.floor((rel - LEAST_REL) * FINE), 0, RELS - 1).astype(np.int64)
    return a * LIFTS + np.clip(np.floor((lift - LEAST_LIFT) * FINE), 0, LIFTS - 1).astype(np.int64)


def shares_of(cells: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Shares of the mixture by expectation maximisation on the cells of all words of the training documents."""
    shares = np.array([0.4, 0.4, 0.2])
    if len(cells):
        x = np.stack([np.zeros(len(cells)), (cells % LIFTS + 0.5) / FINE + LEAST_LIFT, (cells // LIFTS + 0.5) / FINE + LEAST_REL])
        x = np.exp(x - x.max(axis=0))
        for _ in range(50):
            p = shares[:, None] * x
            shares = np.maximum((p / p.sum(axis=0)) @ (often / often.sum()), 1e-3)
            shares /= shares.sum()
    return shares


def fitted(docs: DataFrame, counts: DataFrame, ranks: bytes, pattern: str) -> Scorer:
    """docs: training documents, or encoded() ones."""
    speller = Speller(ranks, pattern)
    often, first = id_counts(counts, ranks, pattern)
    top = top_ids(often)
    network = Network(*classes_by(top, contexts(docs, top, ranks, pattern), speller.leads))
    network.prior(often)
    learned(docs, network, ranks, pattern)
    often += 0.1
    within = np.log(often / np.bincount(network.classes, often)[network.classes])
    usual = np.bincount(network.classes, first) + 1e-3
    return Scorer(network, within, np.log(usual / usual.sum()))


class Numbers:
    """Numbers 0, 1, ... of words, given by their stored ids; of words not among them -1.

    Words of as many ids as a 64-bit key has room for are looked up all at once, by the whole key; longer ones in a dictionary."""

    def __init__(self, words: list[bytes], kind: str):
        self.width = np.dtype(kind).itemsize
        self.most, self.bits = 8 // self.width, max(4, len(words).bit_length() + 2)
        self.keys, self.at = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1)
        self.long = {w: i for i, w in enumerate(words) if len(w) > 8}
        some = np.array([i for i, w in enumerate(words) if len(w) <= 8], np.int64)
        data = b"".join([words[i] for i in some.tolist()])
        sizes = np.array([len(words[i]) // self.width for i in some.tolist()], np.int64)
        keys = packed(np.frombuffer(data, kind), np.cumsum(sizes) - sizes, sizes)
        slots = self._slots(keys)
        while len(some):
            # the first of those that want a free place has it, the others go on to the next
            slots, first = slots & ((1 << self.bits) - 1), np.zeros(len(some), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            first &= self.at[slots] < 0
            self.keys[slots[first]], self.at[slots[first]] = keys[first], some[first]
            keys, some, slots = keys[~first], some[~first], slots[~first] + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, data: bytes, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of the words flat[starts : starts + sizes]; data: the bytes of flat."""
        keys = packed(flat, starts, np.minimum(sizes, self.most))
        out, left, slots = np.full(len(keys), -1), np.arange(len(keys)), self._slots(keys)
        while len(left):
            held = self.keys.take(slots)
            same = held == keys
            out[left[same]] = self.at.take(slots[same])
            more = np.flatnonzero(~same & (held != 0))
            left, keys, slots = left[more], keys[more], (slots[more] + 1) & ((1 << self.bits) - 1)
        long = np.flatnonzero(sizes > self.most)
        at = (starts[long] * self.width).tolist()
        out[long] = np.fromiter(map(self.long.get, [data[i:j] for i, j in zip(at, ((starts + sizes)[long] * self.width).tolist(), strict=True)], repeat(-1)), np.int64, len(long))
        return out


def _ready(x: tuple) -> tuple:
    """The scorer; bytes of ids, without the space of those that begin a word; which ids those are; numbers of frequent words; their counts, and that of ends."""
    scorer, ranks, pattern, often, c, n_docs = x
    scorer.network.ready()
    speller = Speller(ranks, pattern, most=0)
    spelt = speller.spelt(often.encode().split(b"\n")) if len(c) else []
    numbers = Numbers([np.frombuffer(w, "<u4").astype(speller.stored).tobytes() for w in spelt], speller.stored)
    return scorer, texts_of_ids(speller), speller.leads, numbers, np.append(c, n_docs).astype(np.int64)


def words_in(data: bytes, flat: np.ndarray, sizes: list[int], leads: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """For each text of stored ids, laid end to end: where its words and its end begin, and the ids of its words."""
    begins, items = starts_in(flat, sizes, leads)
    ends = np.cumsum(items)
    for a, b in zip((ends - items).tolist(), ends.tolist(), strict=True):
        starts = begins[a + 1 : b]
        at = (starts * flat.itemsize).tolist()
        yield starts, [data[i:j] for i, j in zip(at, at[1:], strict=False)]


def scored(docs: DataFrame, training, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text); training: a condition on doc_id."""
    spark = docs.sparkSession
    flagged = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("learn"))
    spelt = written(encoded(flagged, ranks, pattern), "lm-ids")
    counts = written(counted(spelt.where("learn"), ranks, pattern), "word-counts")
    t = counts.agg(F.sum("c"), F.count("*"), F.max(F.when(F.col("word") == END_WORD, F.col("c")))).first()
    n, kinds, n_docs = t[0] or 0, t[1], t[2] or 0
    scorer = fitted(spelt.where("learn"), counts, ranks, pattern)
    norm = float(np.log10(n + kinds + 1))
    top = counts.where((F.col("word") != END_WORD) & (F.octet_length("word") <= FREQUENT_BYTES)).orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    sent = shared(spark, (scorer, ranks, pattern, "\n".join(top.column("word").to_pylist()), top.column("c").to_numpy(), n_docs), _ready)

    word = pa.struct([("word", pa.string()), ("att", pa.float32()), ("lift", pa.float32())])
    pairs = pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())]))
    names = ["rid", "doc_id", "n_tokens", "known", "base", "near", "rare", "learn", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one without rid, of the task's cells, at the end."""
        roomy()
        scorer, tokens, leads, numbers, often = sent()
        kind = stored(len(tokens) - 1)
        unis, loos = np.log10(often + 1.0) - norm, np.log(np.maximum(often, 1)) - norm * LN10
        base, row, cells = TaskContext.get().partitionId() << 33, 0, np.zeros(RELS * LIFTS, np.int64)
        for whole in batches:
            for batch in slices(whole, "ids", IDS_BYTES // 4):
                texts = batch.column("ids").to_pylist()
                data = b"".join(texts)
                flat = np.frombuffer(data, kind)
                starts, items = starts_in(flat, [len(x) // flat.itemsize for x in texts], leads)
                att, lift = scorer.of_ids(flat.astype(np.int64), starts, items)
                sizes = np.diff(starts, append=len(flat))
                # words, and the end after those of a text, which has the number after all words'; first ends go
                number, own = numbers.of(data, flat, starts, sizes), np.ones(len(starts), bool)
                ends = np.cumsum(items)
                number[ends - 1] = len(often) - 1
                own[ends - items] = False
                number, att, lift, starts, sizes, text = number[own], att[own], lift[own], starts[own], sizes[own], np.repeat(np.arange(len(texts)), items - 1)
                rare = np.flatnonzero(number < 0)
                of_rare = sizes[rare]
                ids = flat.take(np.repeat(starts[rare] - (np.cumsum(of_rare) - of_rare), of_rare) + np.arange(of_rare.sum()))
                rest = pa.StructArray.from_arrays([joined(tokens, ids, of_rare), *(pa.array(x[rare].astype(np.float32)) for x in (att, lift))], ["word", "att", "lift"])
                rares = np.append(0, np.cumsum(np.bincount(text[rare], minlength=len(texts))))
                some = np.flatnonzero(number >= 0)
                number, att, lift, text = number[some], att[some], lift[some], text[some]
                learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)[text]
                # a training document's own count is left out
                np.add.at(cells, cells_of(att[learn] - loos[number[learn]], lift[learn]), 1)
                uni, known = unis[number], (often > 0)[number]
                near = np.stack([att - uni * LN10, lift], axis=1).astype("<f4")
                # each text has its end among these
                first = np.searchsorted(text, np.arange(len(texts) + 1))
                nears = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((first * 8).astype("<i4").tobytes()), pa.py_buffer(near.tobytes())])
                cols = [np.arange(base + row, base + row + len(texts)), batch.column("doc_id"), items - 1, np.add.reduceat(known.astype(np.int64), first[:-1]), np.add.reduceat(uni, first[:-1]), nears, pa.ListArray.from_arrays(pa.array(rares, pa.int32()), rest), batch.column("learn"), pa.nulls(len(texts), pairs)]
                yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in cols], names=names)
                row += len(texts)
        some = np.flatnonzero(cells)
        if len(some):
            last = pa.StructArray.from_arrays([pa.array(some, pa.int32()), pa.array(cells[some], pa.int64())], ["cell", "n"])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(word), pa.bool_())), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), last)], names=names)

    rare, cells = "array<struct<word:string,att:float,lift:float>>", "array<struct<cell:int,n:long>>"
    part = written(spelt.mapInArrow(run, f"rid long, doc_id long, n_tokens long, known long, base double, near binary, rare {rare}, learn boolean, cells {cells}"), "lm-parts")
    dropped(spelt)
    c = F.coalesce(F.col("c"), F.lit(0))
    uni, loo = F.log10(c + 1.0) - norm, F.log(F.greatest(c, F.lit(1)).cast("double")) - norm * LN10
    att, lift = F.col("att").cast("double"), F.col("lift").cast("double")
    within = lambda x, least, n: F.least(F.greatest(F.floor((x - least) * FINE), F.lit(0)), F.lit(n - 1))
    cell = within(att - loo, LEAST_REL, RELS) * LIFTS + within(lift, LEAST_LIFT, LIFTS)
    rest = part.where("rid IS NOT NULL").select("rid", "learn", F.explode("rare").alias("r")).select("rid", "learn", "r.*").join(counts, "word", "left")
    rest = written(rest.select("rid", (c > 0).cast("long").alias("known"), uni.alias("uni"), (att - uni * LN10).cast("float").alias("rel"), "lift", F.when(F.col("learn"), cell.cast("int")).alias("cell")), "lm-rare")
    found = part.where("cells IS NOT NULL").select(F.explode("cells").alias("x")).select("x.*").unionByName(rest.where("cell IS NOT NULL").select("cell", F.lit(1).cast("long").alias("n")))
    found = found.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    shares = shares_of(found.column("cell").to_numpy(), found.column("n").to_numpy())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "near"):
                near = batch.column("near").to_pylist()
                x = np.frombuffer(b"".join(near), "<f4").reshape(-1, 2).astype(float)
                ends = np.cumsum([len(b) // 8 for b in near])
                sums = np.add.reduceat(np.log(shares[0] + shares[1] * np.exp(x[:, 1]) + shares[2] * np.exp(x[:, 0])), np.append(0, ends[:-1]))
                model = batch.column("base").to_numpy() + sums / LN10
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names[:5]), pa.array(model)], names=[*names[:5], "model"])

    done = part.where("rid IS NOT NULL").select(*names[:6]).mapInArrow(finish, "rid long, doc_id long, n_tokens long, known long, base double, model double")
    both = F.col("uni") + F.log(float(shares[0]) + float(shares[1]) * F.exp(F.col("lift").cast("double")) + float(shares[2]) * F.exp(F.col("rel").cast("double"))) / LN10
    rest = rest.groupBy("rid").agg(F.sum("known").alias("k2"), F.sum("uni").alias("b2"), F.sum(both).alias("m2"))
    plus = lambda a, b, zero: (F.col(a) + F.coalesce(b, F.lit(zero)))
    return done.join(rest, "rid", "left").select(
        "doc_id", "n_tokens", plus("known", "k2", 0).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), plus("base", "b2", 0.0).alias("base_score"), plus("model", "m2", 0.0).alias("score")
    )


def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))
    training = F.col("doc_id").isNotNull() & ~held
    out = scored(ids_and_texts(table(spark, sf_dir, "documents")), training, ranks, public_tokenizers.PATTERN)
    return out.withColumn("held_out", held)
