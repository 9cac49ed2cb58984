"""What the operators share: stages in the cluster's shared folder, the word
pattern, and vectorised word hashing for tasks that work on Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import named_folder, shared_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local session
    (tests) that names none gets a scratch folder; a cluster must name one,
    since its machines share no local folder."""
    named = named_folder(spark)
    if named:
        return shared_path(spark, named)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="riskspark-llm-")
    return _local_dirs[app]


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage is cut, later reads are pruned, and a lost executor costs only a
    re-read.  ``batch_bytes`` bounds the Arrow batches (of at least one row)
    that its Python workers are sent, and so the buffers on both sides."""
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    before = spark.conf.get(_BATCH_BYTES, None)
    if batch_bytes:
        spark.conf.set(_BATCH_BYTES, str(batch_bytes))
    try:
        df.write.parquet(path)
    finally:
        if batch_bytes and before is None:
            spark.conf.unset(_BATCH_BYTES)
        elif batch_bytes:
            spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory back to the system.  Spark keeps Python workers for
    later tasks and stages; without this they also keep the arrays' pages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it decides itself
        pass


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` (of batches), starting and leaving its worker without what
    earlier work has freed."""
    def run(batches: Iterator) -> Iterator:
        release_memory()
        try:
            yield from task(batches)
        finally:
            release_memory()
    return run


def least_row(columns: list[str]) -> Column:
    """One whole row of a group: the one whose JSON is smallest.  Columns may
    be of any type, also of those that Spark can't order (maps)."""
    whole = F.struct(*columns)
    return F.min_by(whole, F.to_json(whole))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection on 64-bit words)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column (no copy) and each row's start,
    with the end appended; a null row is empty."""
    import pyarrow as pa

    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw, starts = raw[starts[0]:starts[-1]], starts - starts[0]
    if column.null_count:  # the bytes under a null are undefined: make sure there are none
        lengths = np.diff(starts)
        null = np.asarray(column.is_null())
        if lengths[null].any():
            raw = raw[np.repeat(~null, lengths)]
            lengths = np.where(null, 0, lengths)
            starts = np.concatenate([[0], np.cumsum(lengths)])
    return raw, starts


def split_words(raw: np.ndarray, starts: np.ndarray, space: np.ndarray = _SPACE):
    """Words of all rows: (word start, word end, words before each row, with
    the total appended).  A row's boundary always ends a word."""
    is_word = ~space[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True  # rows start here
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | edge[1:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | edge[1:-1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, starts)


def hash_words(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One 64-bit hash a word: the sum of independent random values, one for
    each (byte, place in the word), mixed with the length (tabulation
    hashing)."""
    if not len(first):
        return np.zeros(0, np.uint64)
    lengths = last - first
    total = int(lengths.sum())
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(total) - np.repeat(begin, lengths)
    chars = raw[place + np.repeat(first, lengths)]
    values = mix64((place.astype(np.uint64) << np.uint64(8)) | chars.astype(np.uint64))
    return mix64(np.add.reduceat(values, begin) + lengths.astype(np.uint64))


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def batch_slices(starts: np.ndarray, most_bytes: int):
    """Runs of rows of about ``most_bytes`` each (a longer row is alone), so
    that a batch's arrays stay small however long its texts are."""
    row, n = 0, len(starts) - 1
    while row < n:
        end = int(np.searchsorted(starts, starts[row] + most_bytes, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


BROADCAST_ROWS = 1_000_000


def join_checked(big: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``big`` joined to ``small`` (a stage of a few numbers a row): its rows
    are counted, and up to BROADCAST_ROWS of them are broadcast, so that the
    texts in ``big`` stay where they are; beyond, Spark shuffles as it sees fit."""
    return big.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, key, how)
