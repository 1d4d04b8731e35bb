"""Embedding near-duplicates: an exact range join in the angular metric over pivot cells.

Pivots divide the vectors into cells. If a vector of cell q is within the angle t of a vector x of another cell p, the
triangle inequality bounds x's angles to the pivots: to q's at most its angle to its own pivot plus 2t, and at most q's
radius plus t. x is replicated to the cells that fit both, so every link is found in the cell of each of its ends, and
cells are joined independently. A cell's own vectors and its members are cut into blocks of fixed size, so a task's size
does not grow with a cell. Equal vectors are joined as one and carry their number.

Nulls and ties: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows
with a null vec_id. Vectors of different lengths have no cosine and don't link; each length that at least two vectors have
is joined by itself. Rows that repeat an id and its vector count as one vector; an id with several vectors gets the sum of
their links and the least of their components. Columns besides vec_id and embedding are ignored. An empty table gives no
rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, lean, lean_group, stored
from tidemark.llm.components import components

#: Vectors a cell should hold, most pivots, and the rows of a block of a cell's own vectors and of its members.
CELL, MOST_PIVOTS, OWN_BLOCK, MEMBER_BLOCK = 8192, 4096, 4096, 8192
#: Slack for rounding in angles, in radians.
SLACK = 1e-6


def _matrix(column, dtype) -> np.ndarray:
    """Unit vectors in double precision, one for each row of bytes."""
    rows = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(usable)


def _distinct(rows: DataFrame, dtype: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows (vec_id, same) of vectors of one length, and (same, id, copies, data) of the distinct ones."""

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column(1)
            values = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), dtype=dtype)
            width = len(values) // batch.num_rows if batch.num_rows else 0
            values = values + 0.0  # -0.0 and 0.0 are equal
            data = [v.tobytes() for v in values.reshape(batch.num_rows, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["vec_id", "data"])

    rows = rows.mapInArrow(lean(pack), "vec_id long, data binary").select("vec_id", F.xxhash64("data").alias("h1"), F.xxhash64(F.lit(1), "data").alias("h2"), "data")
    rows = stored(rows.withColumn("same", F.struct("h1", "h2")).drop("h1", "h2"), "vectors")
    ids = rows.select("vec_id", "same").distinct().groupBy("same").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    data = rows.groupBy("same").agg(F.first("data").alias("data"))
    return rows.select("vec_id", "same").distinct(), stored(ids.join(data, "same"), "distinct-vectors")


def _cells(pivots: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to all pivots, and the nearest pivot."""
    angles = np.arccos(np.clip(data @ pivots.T, -1, 1))
    return angles, angles.argmin(axis=1)


def _visits(angles: np.ndarray, home: np.ndarray, radius: np.ndarray, reach: float) -> np.ndarray:
    own = angles[np.arange(len(home)), home][:, None]
    visits = (angles <= own + 2 * reach + SLACK) & (angles <= radius[None, :] + reach + SLACK)
    visits[np.arange(len(home)), home] = True
    return visits


def _linked(own: np.ndarray, members: np.ndarray, cosine: float):
    """Pairs (row of own, row of members) with at least that cosine in double precision, a chunk of rows at a time."""
    sure = own.shape[1] * 2.5e-7 + 1e-6
    members32 = members.astype(np.float32)
    for at in range(0, len(own), 256):
        part = own[at : at + 256]
        close = part.astype(np.float32) @ members32.T
        i, j = np.nonzero(close >= cosine - sure)
        unsure = np.flatnonzero(close[i, j] < cosine + sure)
        keep = np.ones(len(i), dtype=bool)
        for k in range(0, len(unsure), 65536):
            u = unsure[k : k + 65536]
            keep[u] = np.einsum("ij,ij->i", part[i[u]], members[j[u]]) >= cosine
        yield i[keep] + at, j[keep]


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label``, the smallest node of each node's group, after the pairs (a, b) have joined some groups."""
    if not len(a):
        return label
    pairs = np.unique(np.minimum(label[a], label[b]) * len(label) + np.maximum(label[a], label[b]))
    lo, hi = np.divmod(pairs, len(label))
    root = np.arange(len(label))
    while True:
        before = root.copy()
        least = np.minimum(root[lo], root[hi])
        for end in (lo, hi):
            np.minimum.at(root, root[end], least)
            np.minimum.at(root, end, least)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return root[label]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept."""
    bounded_batches(vectors.sparkSession)
    dtype = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<float>" if dtype == "<f4" else "array<double>"))
    rows = _usable(vectors)
    # One number for each length of vectors, not for each vector.
    lengths = [r.n for r in rows.groupBy(F.size("embedding").alias("n")).count().filter("count > 1").orderBy("n").collect()]
    parts = [_joined(rows.filter(F.size("embedding") == n), cosine, dtype) for n in lengths]
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if parts:
        of_id = functools.reduce(DataFrame.unionByName, parts).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
        out = out.join(of_id, "vec_id", "left")
    else:
        out = out.withColumns({"n_links": F.lit(0), "component_id": F.lit(None).cast("long")})
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _joined(rows: DataFrame, cosine: float, dtype: str) -> DataFrame:
    """Rows (vec_id, n_links, component_id) of vectors of one length."""
    spark = rows.sparkSession
    members, distinct = _distinct(rows, dtype)
    n = distinct.count()
    reach = math.acos(cosine)
    # A bounded sample of the distinct vectors, in hash order, are the pivots.
    chosen = distinct.orderBy(F.xxhash64("id"), "id").limit(max(1, min(MOST_PIVOTS, -(-n // CELL)))).select("data").toArrow().column("data")
    pivots = _matrix(chosen, dtype) if len(chosen) else np.zeros((1, 1))
    shared = spark.sparkContext.broadcast(pivots)

    def radii(batches):
        import pyarrow as pa

        k = len(shared.value)
        counts, most = np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                angles, home = _cells(shared.value, _matrix(batch.column(0), dtype))
                counts += np.bincount(home, minlength=k)
                np.maximum.at(most, home, angles[np.arange(len(home)), home])
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(counts), pa.array(most)], ["cell", "n", "r"])

    found = {r.cell: (r.n, r.r) for r in distinct.select("data").mapInArrow(lean(radii), "cell int, n long, r double").groupBy("cell").agg(F.sum("n").alias("n"), F.max("r").alias("r")).collect()}
    radius = np.array([found.get(c, (0, 0.0))[1] if found.get(c, (0, 0))[0] else -10.0 for c in range(len(pivots))])
    own_blocks = np.array([-(-found.get(c, (0, 0))[0] // OWN_BLOCK) for c in range(len(pivots))])

    def counted(batches):
        import pyarrow as pa

        counts = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            if batch.num_rows:
                angles, home = _cells(shared.value, _matrix(batch.column(0), dtype))
                counts += _visits(angles, home, radius, reach).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(counts)], ["cell", "n"])

    visits = {r.cell: r.n for r in distinct.select("data").mapInArrow(lean(counted), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    member_blocks = np.array([-(-visits.get(c, 0) // MEMBER_BLOCK) for c in range(len(pivots))])
    first_task = np.concatenate([[0], np.cumsum(own_blocks * member_blocks)])

    def replicate(batches):
        """Each vector once for each block pair of its cells: as one of the cell's own, and as a member."""
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            angles, home = _cells(shared.value, _matrix(batch.column(2), dtype))
            row, cell = np.nonzero(_visits(angles, home, radius, reach))
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            own_block = (spread[row] % np.maximum(own_blocks[cell], 1).astype(np.uint64)).astype(np.int64)
            member_block = ((spread[row] // np.uint64(64)) % np.maximum(member_blocks[cell], 1).astype(np.uint64)).astype(np.int64)
            rows, tasks, own = [], [], []
            for times, blocks, is_own in ((own_blocks, member_block, False), (member_blocks, own_block, True)):
                at = np.flatnonzero(own_blocks[cell] > 0) if not is_own else np.flatnonzero(cell == home[row])
                repeat = np.repeat(at, times[cell[at]])
                nth = np.arange(len(repeat)) - np.repeat(np.cumsum(times[cell[at]]) - times[cell[at]], times[cell[at]])
                i, j = (blocks[repeat], nth) if is_own else (nth, blocks[repeat])
                rows.append(row[repeat])
                tasks.append(first_task[cell[repeat]] + i * member_blocks[cell[repeat]] + j)
                own.append(np.full(len(repeat), is_own))
            rows, tasks, own = np.concatenate(rows), np.concatenate(tasks), np.concatenate(own)
            for k in range(0, len(rows), 16384):
                part = batch.take(pa.array(rows[k : k + 16384]))
                yield pa.RecordBatch.from_arrays([pa.array(tasks[k : k + 16384]), pa.array(own[k : k + 16384]), *part.columns], ["task", "own", "id", "copies", "data"])

    def join(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        own, others = (table.filter(mask) for mask in (table["own"], pc.invert(table["own"])))
        if not own.num_rows or not others.num_rows:
            return out.empty_table()
        a, b = own["id"].to_numpy(), others["id"].to_numpy()
        copies = others["copies"].to_numpy()
        n = np.zeros(len(a), np.int64)
        ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        of_a, of_b = where[: len(a)], where[len(a) :]
        label = np.arange(len(ids))
        for i, j in _linked(_matrix(own["data"], dtype), _matrix(others["data"], dtype), cosine):
            other = a[i] != b[j]
            i, j = i[other], j[other]
            n += np.bincount(i, weights=copies[j], minlength=len(a)).astype(np.int64)
            label = _merged(label, of_a[i], of_b[j])  # no more pairs are held than one chunk has
        tied = np.flatnonzero(label != np.arange(len(ids)))
        some = np.flatnonzero(n)
        return pa.table([pa.array(np.concatenate([a[some], ids[tied]])), pa.array(np.concatenate([a[some], ids[label[tied]]])), pa.array(np.concatenate([n[some], np.zeros(len(tied), np.int64)]))], schema=out)

    rows = distinct.select("id", "copies", "data").mapInArrow(lean(replicate), "task long, own boolean, id long, copies long, data binary")
    found = stored(rows.groupBy("task").applyInArrow(lean_group(join), "a long, b long, n long"), "vector-links")
    links = found.filter("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    groups = components(found.filter("n = 0").select("a", "b")).withColumnRenamed("node", "id")
    of_distinct = distinct.select("same", "id", "copies").join(links, "id", "left").join(groups, "id", "left")
    of_distinct = of_distinct.select("same", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return members.join(of_distinct, "same").select("vec_id", "n_links", "component_id")
