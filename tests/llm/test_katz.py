"""Katz backoff against a plain dictionary model, its normalisation, and its held-out texts."""

import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, katz, queries


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


class Plain:
    """A model of order three by dictionaries; contexts are tuples."""

    def __init__(self, texts, least=katz.LEAST):
        self.c, self.n_grams = Counter(), {2: Counter(), 3: Counter()}
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            for i, x in enumerate(w):
                before = tuple(["<s>", *w][max(0, i - 1) : i + 1])
                for k in range(1, len(before) + 1):
                    self.n_grams[k + 1][(*before[-k:], x)] += 1
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.after, self.total, self.d = {}, Counter(), {}
        for order, counts in self.n_grams.items():
            of = Counter(counts.values())
            self.d[order] = katz.discounts(np.array([of[r] for r in range(1, 7)], dtype=float))
            for gram, r in counts.items():
                self.total[gram[:-1]] += r
                if r >= least[order - 1]:
                    self.after.setdefault(gram[:-1], {})[gram[-1]] = r

    def single(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p(self, context, w):
        if not context:
            return self.single(w)
        total, seen = self.total[context], self.after.get(context, {})
        if not total:
            return self.p(context[1:], w)
        d = self.d[len(context) + 1]
        cut = lambda r: r * (d[r] if r <= 5 else 1)
        left = total - sum(map(cut, seen.values()))
        if total == sum(r for r in seen.values() if r > 5):
            total, left = total + 1, 1
        if w in seen:
            return cut(seen[w]) / total
        return left / total * self.p(context[1:], w) / (1 - sum(self.p(context[1:], x) for x in seen))

    def score(self, text):
        w = tokens(text)
        return sum(log10(self.p(tuple(["<s>", *w][max(0, i - 1) : i + 1]), x)) for i, x in enumerate(w))


def corpus():
    rng = random.Random(8)
    vocabulary = [f"W{i}" for i in range(300)] + ["É", "é", "the", "The"]
    some = [" ".join(vocabulary[min(303, int(rng.expovariate(0.03)))] for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    return some + some[:40] + ["go on and " * 9] * 8 + ["na " * 300, "", None, "only here\nonly"]


@pytest.mark.parametrize("hot", [1 / 2000, 1 / 20])
def test_scores(spark, hot):
    rows = list(enumerate(corpus())) + [(5, "again a b"), (None, "no id")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    model = Plain([t for i, t in rows if not held(i)])
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(5)
    got = katz.score(df, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0, slices=2, hot_share=hot).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((i, held(i), len(w), sum(model.c[x] > 0 for x in w), model.n, sum(log10(model.single(x)) for x in w), model.score(t)))
    key = lambda x: (str(x[0]), x[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-8) and a[6] == pytest.approx(b[6], abs=1e-8), (a, b)


def test_every_context_sums_to_one():
    model = Plain(corpus())
    for h in [("<s>",), ("the",), ("w1",), ("never",), ("<s>", "go"), ("go", "on"), ("na", "na"), ("w1", "w2"), ("never", "w1")]:
        assert abs(sum(model.p(h, w) for w in model.c) + model.p(h, "unknown") - 1) < 1e-9


def test_no_training_text_and_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = katz.score(df, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and abs(r.score) < 1e-6
    assert katz.score(df.limit(0), F.lit(True)).count() == 0


def test_held_out_texts_fit_better_than_the_base_and_copies_best(spark):
    got = queries.op6_katz_lm(spark, "/root/testdata/sf0.01")
    sums = got.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_large_shuffles_are_cut_into_writes_of_their_own(spark, monkeypatch):
    made, plain = [], katz.stored
    monkeypatch.setattr(katz, "stored", lambda df, label, **how: made.append((label, plain(df, label, **how))) or made[-1][1])
    df = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string").repartition(8)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 100)
    got = katz.score(df, F.col("doc_id") % 10 == 0, slices=2)
    parts = [t.count() for label, t in made if label == "katz-scores"]
    assert "katz-numbers" in [label for label, _ in made] and len(parts) == 2 and min(parts) > 0
    assert sorted(r.doc_id for r in got.collect()) == list(range(len(corpus())))


def test_rows_follow_the_blocks_and_not_their_words(spark, monkeypatch):
    rows, plain = {}, katz.stored

    def stored(df, label, **how):
        table = plain(df, label, **how)
        rows[label] = max(table.count(), rows.get(label, 0))
        return table

    monkeypatch.setattr(katz, "stored", stored)
    text = " ".join(f"w{i} w{i + 1}" for i in range(30_000))
    got = katz.score(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").coalesce(1), F.col("doc_id") == 2).collect()
    assert [(r.n_tokens, r.n_known) for r in got] == [(60_001, 60_001)] * 2 and got[0].score == pytest.approx(got[1].score)
    numbers = rows.pop("katz-numbers")
    assert max(rows.values()) < 1000, rows
    assert numbers <= 2 * 2**katz.WORD_BITS + common.shuffle_width(spark)


def test_distinct():
    rng = np.random.default_rng(6)
    for key in (rng.integers(-9, 9, 1000), rng.integers(0, 9, 1000), rng.integers(2**53 - 9, 2**53 + 9, 1000), rng.integers(2**62, 2**63 - 1, 1000)):
        first, of = katz._distinct(key)
        assert (key[first] == np.unique(key)).all() and (key[first][of] == key).all()
        order, there = katz._sorted(key)
        assert (there == np.sort(key)).all() and (key[order] == there).all() and len(set(order)) == 1000
    assert [len(x) for x in katz._distinct(key[:0])] == [0, 0]


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**32, 2**62], dtype=np.int64)
    data, sizes = common.pack_numbers(values)
    assert sizes.tolist() == [1, 1, 1, 2, 2, 3, 5, 9] and (common.unpack_numbers(data) == values).all()
    assert len(common.unpack_numbers(data[:0])) == 0
    numbers, edges = common.unpacked_rows(common.packed_rows(values, np.array([0, 0, 3, 8, 8])))
    assert (numbers == values).all() and edges.tolist() == [0, 0, 3, 8, 8]


def test_planes():
    rng = np.random.default_rng(7)
    for top in (1, 2**8, 2**16, 2**24, 2**31, 2**40, 2**62):
        values = rng.integers(0, top, 1000)
        assert (common.unpack_planes(common.pack_planes(values)) == values).all()
    assert len(common.unpack_planes(common.pack_planes(values[:0]))) == 0
    edges = np.array([0, 0, 3, 3, 700, 1000])
    for low in (np.uint8, np.uint16):
        some = [rng.integers(0, top, 1000) for top in (200, 2**62, 2**20, 2**9, 2**40)]
        for made in (some, some[:1], some[1:2]):
            columns = [pa.chunked_array(c) for c in zip(*(common.plane_rows(values, edges, low) for values in made), strict=True)]
            got, at = common.from_plane_rows(*columns, low)
            assert (got == np.concatenate(made)).all() and np.diff(at).tolist() == [0, 3, 0, 697, 300] * len(made)
            got, at = common.from_plane_rows(*(c.combine_chunks().slice(2, 2) for c in columns), low)
            assert (got == made[0][3:700]).all() and at.tolist() == [0, 0, 697]


def test_writes_by_directory_sort_nothing(spark):
    rows = spark.range(100, numPartitions=3).selectExpr("cast(id % 3 as int) kind", "id")
    assert common.stored(rows, "by-kind", by="kind").filter("kind = 1").count() == 33
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsCount())]
    written = [p for p in plans if "by-kind" in p and "InsertIntoHadoopFsRelationCommand" in p]
    assert written and not any("Sort" in p for p in written)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_order_within_frequent_words():
    rng = np.random.default_rng(9)
    v = np.sort(rng.integers(0, 50, 2000))
    some = np.flatnonzero(v % 7 == 0)
    split, own = np.zeros(2000, np.int64), np.zeros(2000, np.int64)
    split[some], own[some] = rng.integers(0, 5, len(some)), rng.choice([0, 0, 3, 2**40, 2**62], len(some))
    assert katz._resorted(some, v, split * 0, own * 0) is None
    assert katz._resorted(some, v, split, own).tolist() == np.lexsort((own, split, v)).tolist()
