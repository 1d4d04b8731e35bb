"""The pipeline stage by stage, each against what its operator alone says about what it was given."""

import hashlib

import corpus_pipeline
from tidemark.llm import decontaminate, queries

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    given = docs
    for (name, stage), kept in zip(corpus_pipeline.STAGES[:-1], ("same", "fewer lines", "same", "same"), strict=True):
        out = stage(spark, given, SMALL)
        assert out.columns == columns, name
        rows = [tuple(r) for r in out.collect()]
        after = {r[0]: r[1] for r in rows}
        assert after.keys() <= before.keys() and len(after) == len(rows)
        if kept == "same":
            assert all(before[i] == t for i, t in after.items())
        else:
            assert after.keys() == before.keys() and all(set(t.split("\n")) <= {*before[i].split("\n"), ""} for i, t in after.items())
        given, before = spark.createDataFrame(rows, out.schema), after
    assert 0 < len(before) < docs.count()
    tokens = corpus_pipeline.STAGES[-1][1](spark, given, SMALL).collect()
    assert len(tokens) == len(before) and all(r.restored for r in tokens)
    whole = {r.doc_id: (r.n_tokens, list(r.ids)) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert whole == {r.doc_id: (r.n_tokens, list(r.ids)) for r in tokens}


def test_planted_documents(spark, tmp_path):
    text = lambda seed: " ".join(hashlib.md5(f"{seed} {i}".encode()).hexdigest()[:7] for i in range(120))
    item = " ".join(f"question{i}" for i in range(20))
    rows = [(1, text(1)), (2, text(1) + " end"), (3, text(3) + " " + item), (4, text(4)), (5, ""), (6, None), (4, text(4))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(9, item), (10, "short one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in near.collect()) == [1, 3, 4, 4, 5, 6]
    clean = corpus_pipeline.benchmark_stage(spark, near, str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [1, 4, 4, 5, 6]
    assert sorted(r.n_tokens for r in corpus_pipeline.token_stage(spark, clean, "").collect())[:2] == [0, 0]


def test_tokens_take_one_python_worker_for_each_task(spark):
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.token_stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_short_benchmark_items(spark, tmp_path):
    filler = lambda n: " ".join(f"w{n}x{i}" for i in range(200))
    items = [(1, "yes"), (2, "in the long run"), (3, "seven of nine"), (4, " ".join(f"question{i}" for i in range(20))), (5, "one two three four five six seven eight")]
    again = lambda n, text, times: " ".join(f"{filler(f'{n}y{i}')} {text}" for i in range(times))
    texts = {
        10: again(10, "yes", 12),
        11: again(11, "In the long run", 3),
        12: f"{filler(12)} seven of nine {filler(120)} in the long run {filler(121)}",  # two items whole, seven words
        13: f"{filler(13)} " + " ".join(f"question{i}" for i in range(5, 13)),
        14: f"{filler(14)} " + " ".join(f"question{i}" for i in range(5, 12)),
        15: f"{filler(15)} one two three four five six seven eight {filler(150)}",
        16: again(16, "one two three four five six seven", 4),
    }
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.benchmark_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [10, 11, 14, 16]
    longest = {10: 1, 11: 4, 12: 4, 13: 8, 14: 0, 15: 8, 16: 0}
    for most in (1000, 5):  # one pass, several passes
        assert {r.doc_id: r.longest for r in decontaminate.find_contamination(docs, bench, 8, most).collect()} == longest


def test_repeated_line_survives_near_duplicates(spark, tmp_path):
    text = lambda seed: "\n".join(" ".join(hashlib.md5(f"{seed} {i} {j}".encode()).hexdigest()[:5] for j in range(3)) for i in range(60))
    line = "one line that three documents hold"
    rows = [(10, f"{line}\n{text(1)}"), (11, f"{line}\n{text(2)}"), (12, f"{line}\n{text(2)} end"), (None, text(3))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.line_stage(spark, docs, str(tmp_path))
    assert lines.columns == docs.columns and dict(lines.dtypes) == dict(docs.dtypes)
    assert [r.doc_id for r in lines.collect() if line in r.text] == [10]
    kept = corpus_pipeline.near_duplicate_stage(spark, lines, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {10, 11, None} and sum(line in r.text for r in kept) == 1


EXTRA = {"score": 1.5, "_id": "a", "_row": 2, "n_lines": "x", "n_dropped": None, "kept_text": "k", "keep_runs": 3, "dropped": "d", "ids": "i", "decoded": "e", "label": 4, "component_id": 5, "_input0": 6, "hits": "h"}
_TYPES = "doc_id long, text string, lang string, source string, n_chars long"
_EXTRA_TYPES = "score double, _id string, _row int, n_lines string, n_dropped string, kept_text string, keep_runs int, dropped string, ids string, decoded string, label int, component_id int, _input0 int, hits string"


def test_clashing_columns_stay(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, *EXTRA.values()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, f"{_TYPES}, {_EXTRA_TYPES}")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SMALL)
        want = {(r.doc_id, getattr(r, "text", None)) for r in stage(spark, plain, SMALL).collect()}
        assert {(r.doc_id, getattr(r, "text", None)) for r in got.collect()} == want, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes), name
            assert got.select(*EXTRA).distinct().collect() == [tuple(EXTRA.values())], name


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], _TYPES)
    for t, schema in (("documents", _TYPES), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    few = spark.createDataFrame([(1, "some words here", "en", "s", 15), (None, None, None, None, None)], _TYPES)
    for name, stage in corpus_pipeline.STAGES[1:]:  # no labels, no items: nothing goes
        assert stage(spark, few, str(tmp_path)).count() == 2, name


def test_each_stage_against_brute_force(spark, tmp_path):
    """Lines, near copies, benchmark and tokens by plain loops over a small corpus."""
    import random
    import re

    from tokenizers import Tokenizer

    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(9))
    shared = [" ".join(word() for _ in range(9)) for _ in range(4)]
    texts = []
    for _ in range(40):
        lines = [rng.choice(shared) if rng.random() < 0.25 else " ".join(word() for _ in range(12)) for _ in range(rng.randrange(1, 7))]
        texts.append("\n".join(lines))
    texts += [t + " more" for t in texts[:8]] + [texts[0], "", "short"]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    items = [(1, " ".join(texts[5].split()[:14])), (2, texts[9].split("\n")[0])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame(docs, _TYPES)

    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for i, t, *_ in docs:
        for line in t.split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    want = {i: "\n".join(x for x in t.split("\n") if len(holders.get(key(x), ())) < 3 or min(holders[key(x)]) == i) for i, t, *_ in docs}
    lines = corpus_pipeline.line_stage(spark, df, str(tmp_path))
    assert {r.doc_id: r.text for r in lines.collect()} == want

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, least = {i: shingles(t) for i, t in want.items()}, {i: i for i in want}
    changed = True
    while changed:
        changed = False
        for a in want:
            for b in want:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in want.items()], _TYPES)
    near = corpus_pipeline.near_duplicate_stage(spark, rows, str(tmp_path))
    assert {r.doc_id for r in near.collect()} == {i for i in want if least[i] == i}

    words = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    windows = {tuple(words(t)[k : k + 8]): i for i, t in items for k in range(max(1, len(words(t)) - 7))}
    leaked = {i for i, t, *_ in docs if any(tuple(words(t)[k : k + 8]) in windows for k in range(len(words(t)) - 7))}
    clean = corpus_pipeline.benchmark_stage(spark, df, str(tmp_path))
    assert leaked and {r.doc_id for r in clean.collect()} == {i for i, *_ in docs} - leaked
    lib = Tokenizer.from_file(queries.tokenizer_path())
    for r in corpus_pipeline.token_stage(spark, df, "").collect():
        assert list(r.ids) == lib.encode(texts[r.doc_id], add_special_tokens=False).ids and r.restored


def test_entry_lists_everything():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= names
