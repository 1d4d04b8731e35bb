"""N-gram Jaccard join against brute force, and the quality classifier on held-out rows."""

import random
import re

import numpy as np
import pytest

from tests.llm.test_filters import reach
from tidemark.llm import ngram_join, quality, queries
from tidemark.llm.common import pack_sorted, unpack_sorted

SMALL = "/root/testdata/sf0.01"


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("frequent", [1, 4, 100])
def test_ngram_join(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = random.Random(frequent)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    bases = [[word() for _ in range(n)] for n in (60, 200, 30, 12, 400)]
    passage = [word() for _ in range(50)]
    docs = []
    for i in range(150):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 12])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w = w[: len(w) // 2] + passage + w[len(w) // 2 :]
        docs.append((1000 - i, rng.choice([" ", "\n", " \t"]).join(w).upper() if i % 7 == 0 else " ".join(w)))
    docs += [(i, " ".join(passage[: 30 + i % 20])) for i in range(40)]
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "ONE\ttwo"), (2005, "one two three"), (2006, "É é"), (2007, "é é"), (2008, "a b c d e f"), (2009, "a b c d e f g")]
    docs += [(40, docs[-5][1])]
    sets = [(i, _set(t)) for i, t in docs]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and 100 * len(x & y) >= 75 * len(x | y)]
    comp = reach([i for i, _ in sets], links)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs + [(None, docs[0][1]), docs[3]]], "doc_id long, text string, n int")
    got = ngram_join.near_duplicates(df, 5, 75).collect()
    assert len(got) == len(docs) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(s), comp[i]) for i, s in sets}
    assert [tuple(r) for r in got if r.doc_id is None] == [(None, len(sets[0][1]), None)]


@pytest.mark.parametrize("part", [8, 1000])
def test_members_of_open_groups_meet_once_and_large_components_are_not_multiplied(spark, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "GROUP_PART", part)
    labels = {1: [0] * 90 + list(range(1, 11)), 2: list(range(40)), 3: [5, 6], 4: [7] * 8 + [8] * 9}
    members = [(s, i, x) for s, of in labels.items() for i, x in enumerate(of)]
    x, y = ngram_join._sides(spark.createDataFrame(members, "signature long, doc_id long, label long"))
    left, right = ([tuple(r) for r in side.select("signature", "i", "j", "doc_id", "label").collect()] for side in (x, y))
    met = sorted((a[0], *sorted((a[3], b[3]))) for a in left for b in right if a[:3] == b[:3] and (a[4] < b[4] or a[1] < a[2] and a[4] != b[4]))
    assert met == sorted((s, i, j) for s, of in labels.items() for j in range(len(of)) for i in range(j) if of[i] != of[j])
    sent = sum(r[0] == 1 for r in left + right)
    assert sent <= 400  # of 100 members, 90 in one component; 2600 with parts of 8 that all meet


def test_ngram_join_empty(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packed_numbers():
    values = np.sort(np.random.default_rng(1).integers(0, 2**56, 999, dtype=np.uint64))
    assert (unpack_sorted(pack_sorted(values)) == values).all()


def test_quality_held_out(spark):
    got = queries.op8_quality(spark, SMALL).toPandas()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text here", "x"), (2, None, "x"), (3, "", "x"), (None, "bad!!", "x"), (4, "word " * 50000, "x"), (1, "good text here", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (4, 7), (None, 1)], "doc_id long, quality int")
    machine = quality.train(docs, labels)
    got = quality.score(docs, machine).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs.limit(0), machine).count() == 0
    constant = quality.train(docs, labels.limit(0))
    assert {r.score > 0.99 for r in quality.score(docs, constant).collect()} == {True}


def test_scores_equal_all_pairs():
    rng = np.random.default_rng(3)
    machine = quality.Machine(0.3, rng.normal(size=quality.BUCKETS + quality.N_STATS), rng.normal(size=(quality.BUCKETS + quality.N_STATS, 3)))
    text, bucket, value = np.array([0, 0, 0]), np.array([5, 9, 40]), np.array([0.5, 0.2, 0.1])
    stats = rng.normal(size=(1, quality.N_STATS)) * 0.1
    x = np.zeros(len(machine.weights))
    x[bucket], x[quality.BUCKETS :] = value, stats[0]
    used = np.flatnonzero(x)
    total = machine.bias + machine.weights @ x + sum(machine.vectors[a] @ machine.vectors[b] * x[a] * x[b] for i, a in enumerate(used) for b in used[:i])
    assert abs(machine.scores((text, bucket, value), stats)[0] - 1 / (1 + np.exp(-total))) < 1e-9
