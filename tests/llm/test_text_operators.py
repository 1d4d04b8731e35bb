"""Line dedup, decontamination and BPE against brute force."""

import hashlib
import random
import re

import pytest

from tidemark.llm import bpe, decontaminate, line_dedup
from tidemark.llm.queries import tokenizer_path

LONG = "a line of more than twenty characters"
DOCS = [
    (1, f"{LONG}\nshort\n\x0b {LONG.upper()} \x0c"),
    (2, f"x\n{LONG}"),
    (3, f"{LONG}\n{LONG}\nother"),
    (3, f"{LONG}\n{LONG}\nother"),
    (4, ""),
    (5, None),
    (None, f"{LONG}\nÉa line with an accent, long enough"),
    (6, "Éa line with an accent, long enough\nnothing"),
    (7, "éa line with an accent, long enough\n"),
    (8, "éA LINE with an accent, long enough"),
    (9, ("word " * 30000).strip() + "\n" + LONG[:19]),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, pos int, dropped string")


def test_line_dedup(spark):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    held = {}
    for i, t in DOCS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i if i is not None else -1)
    want = []
    for i, t in DOCS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == (i if i is not None else -1)]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.dedup_lines(frame(spark, DOCS), 20, 3).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_hot_key(spark, monkeypatch):
    rows = [(i, f"{LONG}\n{i} is a line that only this one has") for i in range(1500)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 20, 3)
    assert got.agg({"n_dropped": "sum"}).first()[0] == 1499
    assert got.filter("n_dropped = 0").first()["doc_id"] == 1499


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("limit", [100_000, 40])
def test_decontamination(spark, limit):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "Ça", "d9", "e"])
    bench = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 8, 9, 20, 12, 1])] + [(77, None), (78, "?!"), (79, "A, b; a")]
    docs = [(i, "  ".join(word() + rng.choice(["", ",", "\n"]) for _ in range(40)) + (f" {bench[i % 5][1].upper()}!" if i % 2 else "")) for i in range(12)]
    docs += [(50, None), (51, ""), (52, "?"), (53, docs[1][1]), (53, docs[1][1]), (None, docs[3][1])]
    windows = {}
    for i, t in bench:
        w = _words(t)
        for k in range(max(0, len(w) - 8) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(i)
    want = []
    for i, t in docs:
        w, hit, items = _words(t), set(), set()
        for k in range(len(w)):
            for win, owners in windows.items():
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    items |= owners
        want.append((i, len(w), len(hit), sorted(items)))
    b = spark.createDataFrame(bench, "item_id long, text string")
    out = decontaminate.find_contamination(frame(spark, docs), b, 8, limit)
    got = [(r.doc_id, r.n_words, r.n, r["items"]) for r in out.withColumn("n", decontaminate.covered_words(out.hits)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = dict(docs)
    for r in out.collect():
        for s in r.spans:
            assert _words(texts[r.doc_id][s["begin"] : s["end"]])[0].isalnum()
    assert decontaminate.find_contamination(frame(spark, docs), spark.createDataFrame([], "item_id long, text string")).filter("size(items) > 0").count() == 0


def test_decontamination_equals_sql(spark, tmp_path):
    import duckdb

    from tidemark.llm import queries

    rng = random.Random(7)
    word = lambda: rng.choice(["a", "B", "Ça", "d9", "e"])
    bench = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 8, 9, 20, 12, 1])] + [(77, None), (78, "?!"), (100, "a B")]
    docs = [(i, "  ".join(word() + rng.choice(["", ",", "\n"]) for _ in range(60)), 1) for i in range(20)] + [(50, None, 2), (51, "", 3), (52, "?", 4)]
    spark.createDataFrame(docs, "doc_id long, text string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.op9_decontamination(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op9_decontamination']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_library(spark):
    rng = random.Random(1)
    alphabet = "aabcdethe   \n\t'’ÉéßΣ漢😀0129.,!<|>_  \u0085\x1c"
    texts = ["", None, " ", "  ", " a", "a ", "a \n", "a\n ", "a\n \nb", "it's 's 'S", "<|endoftext|>x <|endoftext|>", "a" * 5000, "ab" * 3000, "é" * 2000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    texts += ["".join(rng.choice("thenoring") for _ in range(4000)), "".join(rng.choice("=-*_ ") for _ in range(4000)), "word " * 20000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = bpe.decode(bpe.encode(rows, tokenizer_path()), tokenizer_path()).orderBy("doc_id").collect()
    lib = library()
    for r in out:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids, r.text[:80]
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)


def test_bpe_edges(spark):
    path, lib = tokenizer_path(), library()
    rows = [(1, "twice", [9], "x"), (1, "twice", [9], "x"), (None, "no id", None, None), (2, None, [], ""), (3, "", [1], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string")
    got = bpe.decode(bpe.encode(df, path), path)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for r in got.collect():
        assert r.ids == lib.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert got.count() == 5 and bpe.decode(bpe.encode(df.limit(0), path), path).count() == 0
    assert bpe.decode(df, path).filter("ids IS NULL AND decoded IS NULL").count() == 1


def test_bpe_encode_and_decode_at_once(spark):
    path = tokenizer_path()
    texts = ["", None, " a \n\u0085b", "é漢😀 <|endoftext|>x", "a" * 5000, "ab" * 3000, "word " * 20000] + [f"{i} words of {i * i}" for i in range(6000)]
    rows = [(i % 7 or None, t, [9], "x", f"s{i}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string, source string")
    got, apart = bpe.encode_and_decode(df, path), bpe.decode(bpe.encode(df, path), path)
    assert got.schema == apart.schema and got.columns == ["doc_id", "text", "source", "ids", "decoded"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, apart.collect()))
    assert bpe.encode_and_decode(df.limit(0), path).count() == 0
    body = bpe.encode_and_decode(df.withColumnRenamed("text", "body"), path, "body")
    assert [r.ids for r in body.orderBy("source").collect()] == [r.ids for r in got.orderBy("source").collect()]


def test_bpe_long_texts_in_bounded_segments():
    rng, lib = random.Random(2), library()
    encoder = bpe.Encoder(tokenizer_path())
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    text = " ".join(rng.choice(words) for _ in range(1_600_000))  # some 10 MB
    segments = [x for _, x in encoder._segments(text)]
    assert max(map(len, segments)) < bpe.SEGMENT + 200 and "".join(segments) == text
    assert encoder.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    run = "".join(rng.choice("abc") for _ in range(200_000))
    assert encoder.encode(f"x {run} <|endoftext|> y").tolist() == lib.encode(f"x {run} <|endoftext|> y", add_special_tokens=False).ids
    assert encoder.known <= bpe.REMEMBERED + bpe.STEP


def test_lookahead_bounds_what_follows():
    merges = bpe.Merges(tokenizer_path())
    assert merges.longest <= merges.lookahead < 2000
    rng = random.Random(5)
    for _ in range(300):
        data = "".join(rng.choice("aeinorsth -=") for _ in range(rng.randrange(merges.window, 2 * merges.window))).encode()
        whole = merges._merge([merges.first[b] for b in data])
        assert list(merges.stream(data)) == whole


def test_text_machine_keeps_halves():
    machine = bpe.TextMachine([b"\xc3", b"\xa9", b"a"])
    assert [machine.feed([0]), machine.feed([1]), machine.feed([2]), machine.feed([0]), machine.feed([], True)] == ["", "é", "a", "", "�"]


def test_queries_digests(spark, tmp_path):
    from tidemark.llm import queries

    spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = queries.op10_bpe(spark, str(tmp_path)).orderBy("doc_id").collect()
    ids = library().encode("hello world", add_special_tokens=False).ids
    assert r[0].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r[0].n_tokens == len(ids)
    assert r[1].decoded_sha256 == hashlib.sha256(b"").hexdigest() and r[1].n_tokens == 0
