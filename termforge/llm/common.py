"""What the operators share: row keys, written intermediate tables, size-checked joins, and vectorised text hashing.

Row keys. Operators order and link rows by ``sid``: the doc_id, or ``NULL_ID`` (the largest long) where doc_id is null, so
rows without an id sort last and never win against rows with one. A doc_id that is itself the largest long counts as none. Operators select the columns they need by name, so extra
columns of the input, whatever they are called, cannot clash with their own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = 9223372036854775807
#: A side of a join is broadcast only if its counted rows times its row bytes stay within this; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20
#: Keys that hold more than one row in HOT of a table are joined by broadcast: at most HOT rows of fixed width.
HOT = 10_000
#: Text bytes handled at once by the vectorised functions; one longer document is handled alone.
CHUNK_BYTES = 1 << 20

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one in local runs, else one in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        base = tempfile.mkdtemp(prefix="termforge-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/termforge-tmp"
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/termforge-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the intermediate tables written so far; results that still read them must have been consumed."""
    while _written:
        owner, path = _written.pop()
        try:
            jvm = owner._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
            folder.getFileSystem(owner._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session is gone; the folder is left to the cluster's own cleaning
            return


atexit.register(release)


def with_sid(df: DataFrame, *cols: str) -> DataFrame:
    """doc_id as ``doc_id``, its order key ``sid``, and the columns named."""
    return df.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("sid"), *cols)


def keyed_join(big: DataFrame, small: DataFrame, on, how: str, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``big`` joined with ``small``, which is broadcast only if its counted size is within BROADCAST_BYTES."""
    rows = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if rows * row_bytes <= BROADCAST_BYTES else small.hint("merge"), on, how)


def hot_join(big: DataFrame, small: DataFrame, key: str | list[str], times: str, total: int, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``, one row a key, of which ``times`` counts the rows in ``big`` and ``total`` all of them.

    Keys with more than a HOT-th of all rows, of which there can be no more than HOT, are broadcast; the rest shuffle.
    """
    hot = F.broadcast(small.where(F.col(times) * HOT > total).drop(times))
    rest = big.join(hot.select(key), key, "left_anti").join(small.drop(times), key, how)
    return big.join(hot, key).unionByName(rest)


def bounded_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, its session handing Python at most ``rows`` rows at a time where it is left at Spark's 10,000: texts are long.

    The setting stays, since the results are lazy; Spark's own bound of bytes a batch (64 MB) holds besides.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) == 10_000:
        df.sparkSession.conf.set(key, str(rows))
    return df


def partitions(spark: SparkSession, rows: int = 0, per: int = 1_000_000) -> int:
    """Shuffle partitions: the session's number, and more where ``rows`` would exceed ``per`` a partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per), 1)


# --- vectorised text functions; all arithmetic is modulo 2**64 ---------------------------------------------------------

_U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BYTE_CODE_LOWER = BYTE_CODE.copy()
BYTE_CODE_LOWER[65:91] = BYTE_CODE[97:123]
POLY = 0x9E3779B97F4A7C15 | 1
POLY_INV = pow(POLY, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: Word characters of the decontamination contract, upper case included because it is lowered first.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  one table a process
    if cache.get("n", 0) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", POLY), ("i", POLY_INV)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            cache[key] = np.multiply.accumulate(table)
        cache["n"] = size
    return cache["p"], cache["i"]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary column and its row offsets; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column, limit: int = CHUNK_BYTES):
    """(first row, bytes, offsets) for consecutive rows of at most ``limit`` bytes together, or one longer row."""
    data, at = text_buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(data: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``word[byte]``, and the number of words before each row."""
    inside = word[data]
    edge = at[:-1][at[:-1] < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = BYTE_CODE_LOWER) -> np.ndarray:
    """64-bit hashes of the spans' bytes (A-Z as a-z with the default codes), whatever their place; spans are ordered by start.

    A longer text is handled in pieces, so the tables of powers hold some 2 * CHUNK_BYTES whatever its length.
    """
    if len(data) > 2 * CHUNK_BYTES:
        out = np.empty(len(starts), np.uint64)
        long = ends - starts > CHUNK_BYTES
        for i in np.flatnonzero(long).tolist():
            out[i] = _long_hash(data[starts[i] : ends[i]], code)
        short = np.flatnonzero(~long)
        cuts = np.searchsorted(starts[short], np.arange(0, len(data) + CHUNK_BYTES, CHUNK_BYTES)).tolist()
        for i, j in zip(cuts, cuts[1:], strict=False):
            own = short[i:j]
            if len(own):
                low, high = starts[own[0]], ends[own].max()
                out[own] = span_hashes(data[low:high], starts[own] - low, ends[own] - low, code)
        return out
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _LENGTH)


_LENGTH = _U(0xD6E8FEB86659FD93)


def _long_hash(data: np.ndarray, code: np.ndarray) -> np.uint64:
    power, _ = powers(CHUNK_BYTES)
    total = 0
    for k in range(0, len(data), CHUNK_BYTES):
        piece = data[k : k + CHUNK_BYTES]
        total += int((code[piece] * power[: len(piece)]).sum(dtype=np.uint64)) * pow(POLY, k, 1 << 64)
    return mix(np.array([total % (1 << 64)], np.uint64) + np.array([len(data)], np.uint64) * _LENGTH)[0]


def hash_word(word: bytes, code: np.ndarray = BYTE_CODE_LOWER) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]), code)[0])


def pack(x: np.ndarray, kind=None) -> bytes:
    return np.ascontiguousarray(x if kind is None else x.astype(kind)).tobytes()
