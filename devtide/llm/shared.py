"""What several operators share: reading, cutting lineage, Arrow batches and word hashes."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_folder, use_scratch

#: Rows of an Arrow batch: a batch of long texts stays small next to a task's memory.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
#: Bytes of text that the vectorised helpers take at once (a longer text is taken alone).
CHUNK_BYTES = 1 << 20
#: Partitions whose arrays one task folds.
FAN = 16
#: What the C library has to return freed memory with, if it has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: Applications that have the package.
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small in rows and bytes, as text columns can hold very long values, and
    send this package to the executors once. The two settings stay in the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        # The driver serves this file until it ends; executors fetch it when a task needs it.
        folder = tempfile.mkdtemp(prefix="code-")
        atexit.register(shutil.rmtree, folder, True)
        package = __name__.split(".")[0]
        kept = os.path.join(folder, "kept")
        shutil.copytree(
            os.path.join(top, package),
            os.path.join(kept, package),
            ignore=shutil.ignore_patterns("__pycache__"),
        )
        archive = shutil.make_archive(os.path.join(folder, f"{package}-code"), "zip", kept)
        spark.sparkContext.addPyFile(archive)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where a local session names none."""
    base = shared_folder(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="llm-")
        atexit.register(shutil.rmtree, base, True)
        use_scratch(spark, base)
    return base.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a short lineage that survives
    lost executors."""
    path = fresh(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def tree_sum(parts: DataFrame, column: str, dtype: str, length: int) -> np.ndarray:
    """The sum of equally long arrays, one per task, added in a tree. ``length`` bounds what
    reaches the driver, however many rows there are."""
    return tree_fold(stored(parts.select(column), "parts"), column, np.zeros(length, dtype), np.add)


def tree_fold(
    parts: DataFrame, column: str, start: np.ndarray, fold: np.ufunc, packed: bool = False
) -> np.ndarray:
    """Equally long arrays, in a stored column of bytes (``packed`` by zlib), folded into ``start``,
    which changes none that it meets, in a tree: a task takes those of ``FAN`` partitions, and one
    array reaches the driver. Each level is stored: a task that made and folded arrays at once would
    need two Python workers, and executors keep all they ever had. So do those of RDDs, which are
    workers of another kind; hence none is used here."""
    parts = parts.select(F.col(column).alias("part"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start.copy()
        for batch in batches:
            for part in batch.column(0):
                data = zlib.decompress(part.as_buffer()) if packed else part.as_buffer()
                fold(total, np.frombuffer(data, start.dtype), out=total)
        data = total.tobytes()
        yield pa.RecordBatch.from_pydict({"part": [zlib.compress(data, 1) if packed else data]})

    tasks = parts.rdd.getNumPartitions()
    while tasks:
        tasks = -(-tasks // FAN)
        parts = stored(arrow_map(parts.coalesce(tasks), work, "part binary"), "parts")
        if tasks == 1:
            break
    total = start.copy()
    for row in parts.collect():
        data = zlib.decompress(row["part"]) if packed else row["part"]
        fold(total, np.frombuffer(data, start.dtype), out=total)
    return total


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with null as the empty text."""
    values = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(values.cast(pa.large_string()), "")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``CHUNK_BYTES``: first, end, bytes, offsets from 0."""
    data, offsets = buffers(texts)
    first, n = 0, len(texts)
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), n)
        part = offsets[first : end + 1]
        yield first, end, data[part[0] : part[-1]], part - part[0]
        first = end


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batch in runs of rows of about ``CHUNK_BYTES`` of text, each with its texts: what a task
    makes of a batch is many times its length, and a worker keeps the most it ever took."""
    texts = texts_of(batch, column)
    for first, end, _, _ in chunks(texts):
        yield batch.slice(first, end - first), texts.slice(first, end - first)


# Fixed odd multipliers of the hashes; any odd values do.
_BASE = np.uint64(0x9E3779B97F4A7C15)
MULTIPLIERS = np.random.default_rng(20240611).integers(1, 2**63, 64, np.uint64) * 2 + 1
_BYTE = np.random.default_rng(7).integers(0, 2**63, 256, np.uint64)

_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: Byte classes: not a space (0x20, 0x09 to 0x0D); ASCII letter or digit or beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(9, 14)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWERED = _BYTE[_LOWER]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for k, base in enumerate((_BASE, inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all maximal runs of ``kind``, none across two texts, and
    for each text the number of its first word (one more entry at the end)."""
    inside = kind[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    before[offsets] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, with A-Z lower-cased unless told otherwise: hashes, first
    word of each text, starts, ends."""
    starts, ends, first = word_bounds(data, offsets, kind)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWERED if lower else _BYTE)[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), first, starts, ends


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    kind = np.ones(256, bool)
    return int(word_hashes(data, np.array([0, len(data)]), kind)[0][0])


#: What a Python worker keeps from task to task, by what it was made from: one thing at a time.
_HELD: dict[int, Any] = {}


def _give_back() -> None:
    """Memory that a task has freed goes back to the system: idle workers stay for later stages, and
    what each keeps adds up next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def held(source: Any, make: Callable[[Any], Any]) -> Any:
    """The worker's own ``make(source)``, which serves its next tasks too. Whatever else it held
    is dropped, so that a worker that is used again for another stage holds that one's only."""
    key = id(source)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make(source)
    return _HELD[key]


def arrow_map(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    holds: bool = False,
) -> DataFrame:
    """``mapInArrow`` of this package's functions; those that use ``held`` say so."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            _HELD.clear()
        try:
            yield from work(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)
