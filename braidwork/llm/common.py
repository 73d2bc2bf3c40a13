"""What the operators of this subpackage share: scratch tables, Arrow slices, word arrays."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Odd multipliers of rolling hashes: two, so that two hashes of one run are independent.
ROLL, ROLL_TOO = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Text bytes that a worker turns into word objects at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (spark.checkpoint.dir); a local one only on one machine, and where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="braidwork-"))
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that written() gave, once nothing will read it."""
    jvm = df.sparkSession._jvm
    for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared(spark: SparkSession, value: Any, make: Callable[[Any], Any] = lambda x: x) -> Callable[[], Any]:
    """make(value) for tasks: made once in each worker process, which keeps it from task to task with whatever it has learned.

    The value travels as a broadcast that carries its classes, so that executors need no copy of this package."""
    sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps((value, make))})

    def get() -> Any:
        held = sent.value
        if "made" not in held:
            own, how = pickle.loads(held.pop("pickled"))
            held["made"] = how(own)
        return held["made"]

    return get


def tidy(run: Callable) -> Callable:
    """run, a generator of Arrow batches, which hands memory back to the system when a task ends: workers live on between tasks and stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return tidied


def roomy() -> None:
    """Let this process keep freed blocks of up to 8 MB: arrays of a batch, made and dropped again and again, else cost a page fault for each 4 KB."""
    import ctypes

    try:
        held = ctypes.CDLL(None)
        held.mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
        held.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):  # another C library
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plain(docs: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """docs with columns c0, c1, ..., which clash with none of an operator's own, and the new names of `named`."""
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*at.values()), [at[c.lower()] for c in named]


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `most` text bytes, so that word objects of a whole batch never exist at once."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        seen = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, seen + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def raw_texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of each text, without decoding."""
    return batch.column(text).cast(pa.binary()).to_pylist()


class Lexicon(dict):
    """Word bytes -> row of a table of two 64-bit word hashes; forgets everything when it is large, by words or by their bytes."""

    def __init__(self, most: int = 1 << 19, most_bytes: int = 32 << 20):
        super().__init__()
        self.most, self.most_bytes, self.size, self.pairs = most, most_bytes, 0, np.zeros((1 << 12, 2), U64)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.pairs):
            self.pairs = np.vstack([self.pairs, np.zeros_like(self.pairs)])
        d = xxhash.xxh3_128_intdigest(word)
        self.pairs[n] = (d & (2**64 - 1), d >> 64)
        self.size += len(word)
        self[word] = n
        return n

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """(len(words), 2) word hashes."""
        if len(self) > self.most or self.size > self.most_bytes:
            self.clear()
            self.size = 0
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.pairs[rows]


def rolled(h: np.ndarray, width: int, roll: int = ROLL) -> np.ndarray:
    """Hash of each run of `width` items of the uint64 array h (by doubling)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, done = None, 0
    power, span = h, 1
    with np.errstate(over="ignore"):
        while True:
            if width & span:
                part = power[done : done + n]
                out = part.copy() if out is None else out * U64(pow(roll, span, 1 << 64)) + part
                done += span
            if span * 2 > width:
                return mixed(out)
            power = power[:-span] * U64(pow(roll, span, 1 << 64)) + power[span:]
            span *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    """Avalanche of uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))
