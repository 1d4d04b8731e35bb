"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's inputs are its words, hashed into buckets and weighted by their share; statistics of its structure; and the
metadata column n_chars where the table has it. The score is a logistic function of a bias, a weight for each input and
an interaction for each pair of inputs, whose strength is the product of two short vectors. With s = sum of v x, the sum
over all pairs is (s * s - sum of v * v * x * x) / 2, so scoring takes time in proportion to the inputs a text has.

The model is fitted on at most MOST_LABELLED labelled rows, in hash order, with equal weight for both labels. Scoring
covers every row and whole texts.

Nulls and ties: a null text is an empty one; its inputs are all zero but the bias and it gets a score like any other. A
null n_chars counts as the text's length. Labels that are null or neither 0 nor 1, or whose doc_id has several differing
labels, aren't learnt from. With no usable label, or one label only, the model is a constant, the share of label 1 (1 if
there is none). Rows that repeat get a result each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, lean, text_bytes, unused, word_bounds, words

BUCKETS, RANK, MOST_LABELLED, EPOCHS, RATE = 1 << 15, 8, 8000, 6, 0.02
#: Texts whose inputs are held at once, by bytes.
_PART = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_HIGH = np.zeros(256, dtype=bool)
_HIGH[128:] = True
_PLAIN_MARK = np.zeros(256, dtype=bool)
_PLAIN_MARK[[ord(c) for c in ".,;:'\"!?-()"]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT | _PLAIN_MARK)
_SHOUT = np.zeros(256, dtype=bool)
_SHOUT[[ord("!"), ord("?")]] = True
N_STATS = 14


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def inputs(column, n_chars: np.ndarray | None):
    """The inputs of an Arrow column of texts: (text, bucket, value) of the hashed words, and the statistics' matrix."""
    data, offsets = text_bytes(column)
    hashes, counts = words(column)
    n = len(counts)
    of = np.repeat(np.arange(n), counts)
    keys, times = np.unique(of.astype(np.uint64) << np.uint64(40) | (hashes >> np.uint64(64 - 15)), return_counts=True)
    text, bucket = (keys >> np.uint64(40)).astype(np.int64), (keys & np.uint64(BUCKETS - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(text, weights=times.astype(np.float64) ** 2, minlength=n))
    value = times / np.maximum(norm, 1e-12)[text]
    size = np.diff(offsets).astype(np.float64)
    share = lambda table: _per_text(table[data], offsets) / np.maximum(size, 1)
    many = np.maximum(counts, 1)
    begins, ends = word_bounds(data, offsets)
    edges = np.concatenate([[0], np.cumsum(counts)])
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    ends_odd = _MARK[data[ends - 1]].astype(np.float64) if len(ends) else np.zeros(0)
    short = (ends - begins == 1).astype(np.float64)
    distinct = np.bincount(text, minlength=n)
    lines = _per_text(data == 10, offsets) + (size > 0)
    length = size if n_chars is None else np.where(np.isnan(n_chars), size, n_chars)
    letters = share(_LETTER)
    stats = np.stack([letters, share(_UPPER), share(_UPPER) / np.maximum(letters + share(_HIGH) / 2, 1e-9), share(_DIGIT), share(_HIGH), share(_PLAIN_MARK), share(_MARK) * 4, share(_SHOUT) * 4, _per_text(same, edges) / many, _per_text(ends_odd, edges) / many, _per_text(short, edges) / many, distinct / many, np.log1p(size / np.maximum(lines, 1)) / 8, np.log1p(np.maximum(length, 0)) / 12], axis=1)
    stats[size == 0] = 0
    return (text, bucket, value), stats


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # of the buckets, then of the statistics
    vectors: np.ndarray

    def scores(self, hashed, stats: np.ndarray) -> np.ndarray:
        text, bucket, value = hashed
        n = len(stats)
        total = self.bias + np.bincount(text, weights=self.weights[bucket] * value, minlength=n) + stats @ self.weights[BUCKETS:]
        own = self.vectors[BUCKETS:]
        for k in range(self.vectors.shape[1]):
            v = self.vectors[bucket, k] * value
            s = np.bincount(text, weights=v, minlength=n) + stats @ own[:, k]
            squares = np.bincount(text, weights=v * v, minlength=n) + (stats * stats) @ (own[:, k] ** 2)
            total += (s * s - squares) / 2
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(hashed, stats: np.ndarray, labels: np.ndarray, seed: int = 0) -> Machine:
    """Adam on the logistic loss, both labels weighing the same in sum; always the same result for the same rows."""
    rng = np.random.default_rng(seed)
    n, width = len(labels), BUCKETS + N_STATS
    machine = Machine(0.0, np.zeros(width), rng.normal(0, 0.01, (width, RANK)))
    if not n or labels.min() == labels.max():
        share = float(labels.mean()) if n else 1.0
        machine.bias, machine.vectors = (30.0 if share == 1 else -30.0), machine.vectors * 0
        return machine
    text, bucket, value = hashed
    rows = np.concatenate([text, np.repeat(np.arange(n), N_STATS)])
    cols = np.concatenate([bucket, np.tile(np.arange(BUCKETS, width), n)])
    vals = np.concatenate([value, stats.ravel()])
    order = np.argsort(rows, kind="stable")
    rows, cols, vals = rows[order], cols[order], vals[order]
    edges = np.searchsorted(rows, np.arange(n + 1))
    weight = np.where(labels == 1, n / 2 / labels.sum(), n / 2 / (n - labels.sum()))
    params = [np.zeros(1), machine.weights, machine.vectors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        for chosen in np.array_split(rng.permutation(n), max(1, n // 128)):
            step += 1
            at = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in chosen])
            r = np.repeat(np.arange(len(chosen)), edges[chosen + 1] - edges[chosen])
            c, x = cols[at], vals[at][:, None]
            vx = params[2][c] * x
            s = np.zeros((len(chosen), RANK))
            np.add.at(s, r, vx)
            total = params[0][0] + np.bincount(r, weights=params[1][c] * x[:, 0], minlength=len(chosen)) + (s * s).sum(axis=1) / 2
            total -= np.bincount(r, weights=(vx * vx).sum(axis=1), minlength=len(chosen)) / 2
            slope = weight[chosen] * (1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[chosen]) / len(chosen)
            gw = np.bincount(c, weights=slope[r] * x[:, 0], minlength=width) + 1e-5 * params[1]
            used, where = np.unique(c, return_inverse=True)
            gv = np.zeros((len(used), RANK))
            np.add.at(gv, where, slope[r][:, None] * x * (s[r] - vx))
            for k, (g, rowset) in enumerate(((np.array([slope.sum()]), slice(None)), (gw, slice(None)), (gv + 1e-5 * params[2][used], used))):
                first[k][rowset] = 0.9 * first[k][rowset] + 0.1 * g
                second[k][rowset] = 0.999 * second[k][rowset] + 0.001 * g * g
                params[k][rowset] -= RATE * (first[k][rowset] / (1 - 0.9**step)) / (np.sqrt(second[k][rowset] / (1 - 0.999**step)) + 1e-8)
    return Machine(float(params[0][0]), params[1], params[2])


def _columns(docs: DataFrame):
    length = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(length, F.char_length(F.coalesce("text", F.lit(""))).cast("double")).alias("length")


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """At most ``most`` rows (doc_id, text, length, quality), in the order of a hash of doc_id; of rows that repeat a doc_id, one."""
    agreed = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    chosen = agreed.filter((F.col("quality") == F.col("other")) & F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(*_columns(docs)).join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")
    # One row for each doc_id, however many repeat it, so that the bound holds for rows too.
    least = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "length", "quality")).alias("r"))
    return least.select("doc_id", "r.text", "r.length", "r.quality")


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Machine:
    """Fit on the driver: inputs are made on the executors, and only those of the bounded sample are brought together."""

    def prepare(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                (text, bucket, value), stats = inputs(part.column(0), part.column(1).to_numpy(zero_copy_only=False))
                edges = np.searchsorted(text, np.arange(part.num_rows + 1))
                cut = lambda v: [v[edges[i] : edges[i + 1]].tobytes() for i in range(part.num_rows)]  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([pa.array(cut(bucket.astype(np.int32)), pa.binary()), pa.array(cut(value.astype(np.float32)), pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary()), part.column(2), part.column(3)], ["bucket", "value", "stats", "quality", "order"])

    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, labels, most).select("text", "length", F.col("quality").cast("int"), F.xxhash64("doc_id", "text").alias("order"))
    table = rows.mapInArrow(lean(prepare), "bucket binary, value binary, stats binary, quality int, order long").toArrow().sort_by([("order", "ascending"), ("quality", "ascending")])
    bucket = [np.frombuffer(b, np.int32) for b in table["bucket"].to_pylist()]
    value = np.concatenate([np.frombuffer(b, np.float32) for b in table["value"].to_pylist()] or [np.zeros(0, np.float32)]).astype(np.float64)
    stats = np.array([np.frombuffer(b, np.float64) for b in table["stats"].to_pylist()]).reshape(-1, N_STATS)
    text = np.repeat(np.arange(len(bucket)), [len(b) for b in bucket])
    hashed = (text, np.concatenate(bucket or [np.zeros(0, np.int32)]).astype(np.int64), value)
    return fit(hashed, stats, table["quality"].to_numpy().astype(np.float64))


def score(docs: DataFrame, machine: Machine, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and score (or ``column``, in place of one so named), the probability of label 1. The model's
    size is fixed by its parameters."""
    from pyspark.sql import types as T

    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    docs = docs.drop(column)
    fields, width = docs.schema.fields, len(docs.columns)
    rows = docs.select("*", *(c.alias(unused(f"_input{i}", docs.columns)) for i, c in enumerate(_columns(docs)[1:])))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            at = 0
            sizes = np.cumsum(pc.binary_length(batch.column(width)).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + _PART, "right")))
                part = batch.slice(at, end - at)
                got = shared.value.scores(*inputs(part.column(width), part.column(width + 1).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(got)], [*part.schema.names[:width], column])
                at = end

    return rows.mapInArrow(lean(run), T.StructType([*fields, T.StructField(column, T.DoubleType())]))
