"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows, each text scanned once.

Nulls and ties: a null or empty text, or one without words, has no words and no hits. A null doc_id is carried through.
Rows that repeat get a result each. An item without words has no window; items that share a window are all reported.
Columns besides doc_id, item_id and text are ignored. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, importable, lean, stored, text_bytes, word_bounds

#: Windows that one automaton holds, and bytes of their text. As many windows of eight words take some 230 MB in a worker,
#: measured; a larger benchmark is scanned for in as many passes as it needs, one after the other.
MAX_WINDOWS, MAX_BYTES = 100_000, 8 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
#: Bytes of words, A-Z lower-cased; every other byte becomes a space. UTF-8 keeps all other characters at 80-FF.
_NORMAL = bytes(b + 32 if 65 <= b < 91 else b if _WORD[b] else 32 for b in range(256))

SCHEMA = "doc_id long, row_hash long, n_words long, hits array<struct<first:int,last:int>>, items array<bigint>, longest int, spans array<struct<begin:int,end:int>>"


def _normalised(text: bytes) -> tuple[int, str]:
    """The number of words, and the words between single spaces, one character for each byte."""
    found = text.translate(_NORMAL).split()
    return len(found), f" {b' '.join(found).decode('latin-1')} "


def item_windows(bench: DataFrame, size: int) -> DataFrame:
    """Rows (window, item_id): every ``size`` consecutive words of an item; of an item with fewer, all its words."""

    def windows(batches):
        import pyarrow as pa

        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = (text or "").encode().translate(_NORMAL).split()
                for i in range(max(0, len(found) - size) + 1 if found else 0):
                    ids.append(item)
                    out.append(b" ".join(found[i : i + size]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(ids, pa.int64())], ["window", "item_id"])

    rows = bench.select(F.col("item_id").cast("long"), "text").filter(F.col("item_id").isNotNull())
    return rows.mapInArrow(lean(windows), "window binary, item_id long").distinct()


_automata: dict[int, tuple] = {}


def _automaton(broadcast):
    """Built once in each worker for each broadcast."""
    import ahocorasick

    if broadcast.value is not None and id(broadcast.value) not in _automata:
        _automata.clear()
        machine = ahocorasick.Automaton()
        for window, items in broadcast.value:
            machine.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
        if len(machine):
            machine.make_automaton()
        _automata[id(broadcast.value)] = (machine, broadcast.value)
    return _automata[id(broadcast.value)][0]


def _scan(machine, text: str) -> tuple[list[tuple[int, int]], set, int]:
    """Runs of word numbers (first and last) that windows cover, overlapping runs merged, the items found, and the number
    of words of the longest window found."""
    runs: list[list[int]] = []
    items: set = set()
    words = at = longest = 0
    for end, (n, owners) in machine.iter(text) if len(machine) else ():
        words += text.count(" ", at, end)
        at = end
        items.update(owners)
        longest = max(longest, n)
        if runs and words - n <= runs[-1][1] + 1:
            runs[-1][0], runs[-1][1] = min(runs[-1][0], words - n), max(runs[-1][1], words - 1)
        else:
            runs.append([words - n, words - 1])
        while len(runs) > 1 and runs[-1][0] <= runs[-2][1] + 1:
            last = runs.pop()
            runs[-1] = [min(runs[-1][0], last[0]), max(runs[-1][1], last[1])]
    return [(a, b) for a, b in runs], items, longest


def _pass(docs: DataFrame, shared) -> DataFrame:
    importable(docs.sparkSession)

    def scan(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.int64())), ("longest", pa.int32()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))])
        machine = _automaton(shared)
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            n_words, hits, items, longest, spans = [], [], [], [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                n, text = _normalised(data[lo:hi].tobytes())
                runs, found, most = _scan(machine, text)
                n_words.append(n)
                hits.append([{"first": a, "last": b} for a, b in runs])
                items.append(sorted(found))
                longest.append(most)
                spans.append([])
                if runs:
                    raw = data[lo:hi]
                    begins, ends = word_bounds(raw, np.array([0, hi - lo]), _WORD)
                    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    spans[-1] = [{"begin": int(points[begins[a]]), "end": int(points[ends[b]])} for a, b in runs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, t) for x, t in zip((n_words, hits, items, longest, spans), schema.types[2:], strict=True))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"), "text")
    return rows.mapInArrow(lean(scan), SCHEMA)


def find_contamination(docs: DataFrame, bench: DataFrame, size: int = 8, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Rows (doc_id, row_hash, n_words, hits, items, longest, spans): runs of words inside windows of ``size`` item words,
    the items whose windows occur, the words of the longest window that occurs (0 if none does; fewer than ``size`` if only
    whole items shorter than that do), and the runs' code points in the original text."""
    bounded_batches(docs.sparkSession)
    windows = item_windows(bench, size).groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    windows = stored(windows, "windows")
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + 8 * F.size("items")), F.lit(0))).first()
    passes = max(1, -(-n // max_windows), -(-size // MAX_BYTES))
    context = docs.sparkSession.sparkContext
    if passes == 1:
        return _pass(docs, context.broadcast([tuple(r) for r in windows.collect()]))
    passes *= 2  # parts by hash differ in size
    union = _pass(docs, context.broadcast([])).select("doc_id", "row_hash", "n_words", "hits", "items", "longest", "spans")
    for i in range(passes):
        shared = context.broadcast([tuple(r) for r in windows.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == i).collect()])
        union = union.unionByName(stored(_pass(docs, shared).filter(F.size("hits") > 0), "contaminated"))
        shared.destroy()
    # Rows that repeat a doc_id and its text have equal results, so the sums of the passes stay right for each of them.
    rows = union.groupBy("doc_id", "row_hash", "n_words").agg(F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.max("longest").alias("longest"), F.flatten(F.collect_set("spans")).alias("spans"))
    copies = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row"))
    return copies.join(rows, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_row") == F.col("row_hash"))).drop("_id", "_row")


def covered_words(hits):
    """Number of distinct words in the runs."""
    numbers = F.flatten(F.transform(hits, lambda r: F.sequence(r["first"], r["last"])))
    return F.size(F.array_distinct(numbers)).cast("long")
