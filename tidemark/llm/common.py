"""What the training-data operators share: scratch tables in the cluster's shared folder, partition labels, byte-level words."""

from __future__ import annotations

import contextlib
import os
import re
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: A side of a join is broadcast only when it has been stored and holds no more rows, and bytes in its files, than this.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 8 << 20
#: Bytes in one Arrow batch: texts can be long, so batches are bounded by size and not by rows alone.
BATCH_BYTES = "4m"
#: The same for operators that pack a batch's words into one block, whose dictionaries pay only if they are large.
BLOCK_BYTES = "16m"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a local master, whose executors share this machine's
    disk, gets one of our own where that is unset, as in tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"/tmp/checkpoints/{spark.sparkContext.applicationId}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: Spark removes the shuffle files of a write as soon as it has ended; nothing reads them again, as what is stored cuts lineage.
_WRITE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: A task keeps a file open for each directory, up to so many, instead of sorting its rows by directory.
_UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "8"}


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


#: For each open ``scratch`` the paths of what was stored inside it.
_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete at the end what is stored inside, but for what is stored with ``keep``."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            fs, where = _path(spark, path)
            fs.delete(where, True)


def stored(df: DataFrame, label: str, by: str | None = None, batch: str | None = None, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder, in a directory for each value of ``by``, and read it back.

    This cuts lineage the way checkpoint() does, survives lost executors (the files are in shared storage) and is
    smaller than a checkpoint of rows. ``batch`` bounds the bytes of an Arrow batch during the write. The files go with
    ``discard`` or ``scratch``, or else when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with settings(spark, _WRITE | (_UNSORTED if by else {}) | ({"spark.sql.execution.arrow.maxBytesPerBatch": batch} if batch else {})):
        (df.write.partitionBy(by) if by else df.write).option("compression", "zstd").parquet(path)
    fs, where = _path(spark, path)
    fs.deleteOnExit(where)
    if _scopes and not keep:
        _scopes[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(table: DataFrame, part: str = "") -> None:
    """Delete the files of a stored table, or of one directory of it, that nothing will read again."""
    fs, where = _path(table.sparkSession, f"{table._stored_at}/{part}" if part else table._stored_at)
    fs.delete(where, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's disk import the package from where the driver has it."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}{os.pathsep}{root}" if paths else root


def bounded_batches(spark: SparkSession, most: str = BATCH_BYTES) -> None:
    """Bound what one Arrow batch to or from a Python worker can hold, however long the texts are."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def release_memory() -> None:
    """Return to the system the memory that a Python worker would keep while it waits for its next task."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """A function over Arrow batches that returns its memory when done. Idle workers count towards an executor's memory just
    like busy ones."""

    def whole(batches):
        yield from run(batches)
        release_memory()

    return whole


def lean_group(run):
    """The same for a function over the table of a group."""

    def whole(table):
        out = run(table)
        release_memory()
        return out

    return whole


def lean_pair(run):
    """The same for a function over the tables of a pair of groups."""

    def whole(left, right):
        out = run(left, right)
        release_memory()
        return out

    return whole


def join_small(big: DataFrame, small: DataFrame, on, how: str) -> DataFrame:
    """Join with ``small``, which must be stored: broadcast if its files are few bytes and its counted rows are few,
    otherwise a shuffled join."""
    fs, where = _path(small.sparkSession, small._stored_at)
    few = fs.getContentSummary(where).getLength() <= BROADCAST_BYTES and small.count() <= BROADCAST_ROWS
    return big.join(F.broadcast(small) if few else small, on, how)


def unused(name: str, columns) -> str:
    """``name``, with as many underscores after it as no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _rotl(x: int, r: int) -> int:
    return ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF


def _spark_hash_int(value: int, seed: int = 42) -> int:
    """Spark's hash() of one int column (Murmur3, 32 bits), as a signed number."""
    k = (_rotl((value & 0xFFFFFFFF) * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593) & 0xFFFFFFFF
    h = (_rotl(seed ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 4
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & 0xFFFFFFFF
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def partition_labels(width: int) -> np.ndarray:
    """``width`` ints of which repartition(width, label) sends each to a partition of its own."""
    found: dict[int, int] = {}
    x = 0
    while len(found) < width:
        found.setdefault(_spark_hash_int(x) % width, x)
        x += 1
    return np.array([found[i] for i in range(width)], dtype=np.int32)


# ---------------------------------------------------------------------------------------------------------------------
# Words of many texts at once, on bytes

_PIECE = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_VALUE[65:91] = _BYTE_VALUE[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, _PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


_SPACE_TABLE = np.ones(256, dtype=bool)
_SPACE_TABLE[[0x20, 9, 10, 11, 12, 13]] = False


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column, nulls as empty texts, and where each text begins (one more offset than texts)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = _SPACE_TABLE) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end bytes of the words (runs of bytes that ``table`` marks), none across two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    begins = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    return begins, np.flatnonzero(inside & ~after) + 1


def words(column) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` of an Arrow string column, A-Z lower-cased, and the number of
    words of each text. Works through the bytes in pieces, so memory follows the batch and not the longest text's square."""
    data, offsets = text_bytes(column)
    begins, ends = word_bounds(data, offsets)
    hashes = np.empty(len(begins), dtype=np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + _PIECE, "right")))
        lo, hi = begins[i], ends[j - 1]
        up, down = _power_tables(int(hi - lo) + 1)
        sums = np.empty(hi - lo + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        b, e = begins[i:j] - lo, ends[i:j] - lo
        hashes[i:j] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        i = j
    return hashes, np.diff(np.searchsorted(begins, offsets))


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers >= 0 in seven bits a byte, the low ones first; and how many bytes each takes."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    top = int(values.max()) if len(values) else 0
    if top < 1 << 7:
        return values.astype(np.uint8), sizes
    for k in range(1, 10):
        if top >> (7 * k):
            sizes += values >= np.uint64(1 << (7 * k))
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max()) if len(sizes) else 0):
        mine = slice(None) if k == 0 else np.flatnonzero(sizes > k)
        left = values[mine] >> np.uint64(7 * k)
        out[at[mine] + k] = (left & np.uint64(0x7F)).astype(np.uint8) | ((left > np.uint64(0x7F)).astype(np.uint8) << 7)
    return out, sizes


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    """What pack_numbers has packed, as 64-bit signed numbers."""
    ends = np.flatnonzero(data < 0x80)
    begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
    sizes = ends - begins + 1
    out = (data[begins] & 0x7F).astype(np.int64)
    mine = None
    for k in range(1, int(sizes.max()) if len(sizes) else 0):
        mine = np.flatnonzero(sizes > k) if mine is None else mine[sizes[mine] > k]
        out[mine] |= (data[begins[mine] + k] & 0x7F).astype(np.int64) << (7 * k)
    return out


def packed_rows(values: np.ndarray, edges: np.ndarray):
    """An Arrow binary array: row i has values[edges[i]:edges[i + 1]], packed."""
    import pyarrow as pa

    data, sizes = pack_numbers(values)
    at = np.append(0, np.cumsum(sizes))[edges].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])


def unpacked_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of an Arrow binary array of packed rows, and where each row's begin (one more offset than rows)."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return unpack_numbers(data), np.append(0, np.cumsum(data < 0x80))[offsets - offsets[0]]


def pack_planes(values: np.ndarray) -> bytes:
    """Numbers >= 0 byte by byte: the lowest bytes of all, then the next ones, as far as the largest number needs them. Takes
    more than pack_numbers before compression and a fraction of its time."""
    planes = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return b"".join([bytes([planes]), *((values >> (8 * k)).astype(np.uint8).tobytes() for k in range(planes))])


def unpack_planes(data: bytes) -> np.ndarray:
    """What pack_planes has packed; 32-bit numbers where these hold them."""
    planes = data[0]
    n = (len(data) - 1) // planes
    out = np.frombuffer(data, np.uint8, n, 1).astype(np.int32 if planes < 4 else np.int64)
    for k in range(1, planes):
        out |= np.frombuffer(data, np.uint8, n, 1 + k * n).astype(out.dtype) << (8 * k)
    return out


def _fixed(values: np.ndarray, edges: np.ndarray):
    import pyarrow as pa

    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values))])


def plane_rows(values: np.ndarray, edges: np.ndarray, low=np.uint8) -> list:
    """Two Arrow binary arrays: row i has the low bits of values[edges[i]:edges[i + 1]], all >= 0, as numbers of the type
    ``low``; and what is above them, in numbers of as many bytes as the largest of all rows needs, none if nothing is."""
    bits = 8 * np.dtype(low).itemsize
    above = (int(values.max()) if len(values) else 0) >> bits
    first = _fixed(values.astype(low), edges)
    if not above:
        return [first, _fixed(np.zeros(0, np.uint8), np.zeros(len(edges), np.int64))]
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if above <= np.iinfo(k).max)
    return [first, _fixed((values >> bits).astype(kind), edges)]


def _buffers(column) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    return np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8), offsets - offsets[0]


def from_plane_rows(first, rest, low=np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of two Arrow binary arrays as plane_rows makes them, and where each row's begin (one more offset than
    rows). Rows may come from several calls."""
    (data, edges), (above, above_edges) = _buffers(first), _buffers(rest)
    bits, edges = 8 * np.dtype(low).itemsize, edges // np.dtype(low).itemsize
    out = data.view(low).astype(np.int64)
    per, bytes_per = np.diff(edges), np.diff(above_edges)
    width = bytes_per // np.maximum(per, 1)
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        mine = (width == np.dtype(kind).itemsize) & (per > 0)
        if not mine.any():
            continue
        if (mine | (per == 0)).all():
            out |= above.view(kind).astype(np.int64) << bits
        else:
            out[np.repeat(mine, per)] |= above[np.repeat(mine, bytes_per)].view(kind).astype(np.int64) << bits
    return out, edges


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, byte by byte: a byte's place is kept only as far as a difference needs it."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([planes]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = data[0]
    n = (len(data) - 1) // planes
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :planes] = np.frombuffer(data, np.uint8, planes * n, 1).reshape(planes, n).T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)
