"""N-gram Jaccard join: token-combination prefixes over sets of word shingles.

A token is a shingle's hash. Texts with equal sets are one class and take part once. The join then runs in four steps.

1. Every class sends its tokens, packed, to the partition of their hash range, where each token's document frequency is
   counted. Tokens of one class only can't be shared; those that are shared go back. A class of which fewer than the
   least possible overlap are shared links with nothing and is done.
2. Prefixes. Tokens are ordered from rare to frequent. Two sets that share neither a rare token nor, within any class of
   frequent tokens, a pair of them, miss at least (rare tokens) + sum over classes (tokens - 1) of the prefix. A prefix is
   extended until that exceeds what a linked set may miss. Its signatures are its rare tokens singly and the pairs of
   frequent tokens of one class. Frequent tokens are dealt to classes by hash, their number following the set's size, so
   that a class holds a few tokens of a prefix; a set emits signatures for each size range that a partner's class
   division may come from.
3. Linking. Within a signature's group everything is first compared with one leader, then one representative of each
   component with another's, and components are merged, so that a large group of near copies costs a comparison or two
   for each member and never all its pairs.
4. What is left: members of a group in different components are compared, first by size and by bitmaps that bound the
   difference of two sets from below, then in full; a large group is cut into parts, and parts meet in pairs, those of its
   largest component only with the others, so that no task holds a whole group. Every pair that shares a signature is thus compared, known to be too
   different, or already connected, and every link connects.

Nulls and ties: a null or empty text, or one without words, has no shingles and links with nothing; a text of fewer words
than a shingle has one, the whole sequence. A null doc_id links with nothing and has a null component. Rows that repeat a
doc_id get a result each. Columns besides doc_id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLOCK_BYTES, bounded_batches, join_small, lean, mix, pack_sorted, partition_labels, shuffle_width, stored, unpack_sorted, words
from tidemark.llm.components import components

#: A token of more documents than this is frequent and is indexed in pairs.
FREQUENT = 100
#: Bits of a token that are kept.
TOKEN_BITS = 56
#: Tokens of a size range for each class of frequent tokens.
CLASS_SHARE = 12
#: 64-bit words of a set's bitmap.
BITMAP_WORDS = 8
#: Members of a part of a group that is compared in full.
GROUP_PART = 512
#: Rounds in which representatives of components are compared before the rest is compared in full.
ROUNDS = 3

_SHIFT = np.uint64(64 - TOKEN_BITS)


def shingle_sets(column, size: int):
    """Sorted distinct shingle hashes of each text of an Arrow column."""
    hashes, counts = words(column)
    factor = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for j in range(size):
        rolled += hashes[j : j + len(rolled)] * factor[j]
    rolled = mix(rolled)
    at = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(rolled[at : at + n - size + 1])
        elif n:
            yield mix((hashes[at : at + n] * factor[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        else:
            yield hashes[:0]
        at += n


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, n_shingles, digest); equal digests stand for equal sets, and empty sets have none."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = list(shingle_sets(batch.column(1), size))
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary())], ["doc_id", "n_shingles", "digest"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), "doc_id long, n_shingles long, digest binary")


_PACKED = "part int, block long, n int, tokens binary, docs binary"


def _packed_tokens(texts: DataFrame, size: int, width: int) -> DataFrame:
    """A row for each block of texts and hash range, and one, with n < 0, of the block's documents and set sizes."""
    labels = partition_labels(width)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            sets = list(shingle_sets(batch.column(1), size))
            counts = np.array([len(s) for s in sets], dtype=np.int32)
            tokens = np.concatenate(sets) >> _SHIFT if sets else np.zeros(0, np.uint64)
            of = np.repeat(np.arange(len(sets), dtype=np.uint16), counts)
            order = np.argsort(tokens, kind="stable")
            tokens, of = tokens[order], of[order]
            starts = np.searchsorted(tokens, np.array([(i << TOKEN_BITS) // width for i in range(width)], dtype=np.uint64))
            ends = np.append(starts[1:], len(tokens))
            used = np.flatnonzero(ends > starts)
            rows = [(labels[i], first + number, ends[i] - starts[i], pack_sorted(tokens[starts[i] : ends[i]]), of[starts[i] : ends[i]].tobytes()) for i in used]
            rows.append((labels[(first + number) % width], first + number, -1, batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), counts.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "block", "n", "tokens", "docs"])

    return texts.mapInArrow(lean(run), _PACKED)


def _shared_tokens(packed: DataFrame, width: int) -> DataFrame:
    """Back to the blocks: the tokens that more than one document has, with their document frequency."""
    labels = partition_labels(width)

    def run(batches):
        import pyarrow as pa

        names, blocks, tokens, docs = ["part", "block", "n", "tokens", "docs"], [], [], []
        for batch in batches:
            for _, block, n, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([labels[block % width]], pa.int32()), pa.array([block]), pa.array([n], pa.int32()), pa.array([a]), pa.array([b])], names)
                else:
                    blocks.append(np.full(n, block, np.int64))
                    tokens.append(unpack_sorted(a))
                    docs.append(np.frombuffer(b, np.uint16))
        if not tokens:
            return
        token = np.concatenate(tokens)
        tokens.clear()
        order = np.argsort(token, kind="stable")
        token = token[order]
        new = np.append(True, token[1:] != token[:-1])
        run_of = np.cumsum(new) - 1
        frequency = np.bincount(run_of)[run_of]
        keep = frequency > 1
        token, frequency, order = token[keep], np.minimum(frequency[keep], 0xFFFFFFFF).astype(np.uint32), order[keep]
        block, doc = np.concatenate(blocks)[order], np.concatenate(docs)[order]
        order = np.argsort(block, kind="stable")
        block, doc, token, frequency = block[order], doc[order], token[order], frequency[order]
        if not len(block):
            return
        edges = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for lo, hi in zip(edges, np.append(edges[1:], len(block)), strict=True):
            b = int(block[lo])
            yield pa.RecordBatch.from_arrays([pa.array([labels[b % width]], pa.int32()), pa.array([b]), pa.array([hi - lo], pa.int32()), pa.array([pack_sorted(token[lo:hi])]), pa.array([doc[lo:hi].tobytes() + frequency[lo:hi].tobytes()])], names)

    return packed.repartition(width, "part").mapInArrow(lean(run), _PACKED)


def _signatures(n: int, least: int, tokens: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Signatures of a set of ``n`` tokens of which ``tokens`` are shared; a linked set shares at least ``least``."""
    missing = n - least + 1 - (n - len(tokens))
    order = np.lexsort((tokens, frequency))
    tokens, frequency = tokens[order], frequency[order]
    rare = int(np.searchsorted(frequency, FREQUENT, "right"))
    if rare >= missing:
        return tokens[:missing]
    out = [tokens[:rare]]
    missing -= rare
    often = tokens[rare:]
    for size_range in sorted({n.bit_length() - 1, least.bit_length() - 1}):
        n_classes = max(1, (1 << size_range) // CLASS_SHARE)
        of = (mix(often) % np.uint64(n_classes)).astype(np.int64)
        met = np.zeros(len(often), dtype=bool)
        met[np.unique(of, return_index=True)[1]] = True  # the first token of a class adds nothing
        end = int(np.searchsorted(np.cumsum(~met), missing)) + 1
        by_class = np.argsort(of[:end], kind="stable")
        token, group = often[:end][by_class], of[:end][by_class]
        step = 1
        while step < len(token):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            a, b = token[:-step][same], token[step:][same]
            out.append(mix(mix(np.minimum(a, b)) * np.uint64(3) + mix(np.maximum(a, b)) * np.uint64(5) + np.uint64(size_range)))
            step += 1
    return np.concatenate(out)


def _bitmap(tokens: np.ndarray) -> list[int]:
    """For each bit whether an odd number of tokens hash to it. Two bitmaps differ in at most as many bits as two sets
    differ in tokens."""
    odd = np.bincount((mix(tokens) >> np.uint64(64 - 9)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _sets(shared: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, own, bits, tokens, signatures) of the sets that can link at all; tokens: the shared ones, sorted;
    own: the number of the others; bits: the bitmap of the shared ones."""

    def run(batches):
        import pyarrow as pa

        def rows(parts):
            ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
            token, doc, frequency = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint32)]
            for n, a, b in parts:
                if n < 0:
                    ids, counts = np.frombuffer(a, "<i8"), np.frombuffer(b, np.int32)
                else:
                    token.append(unpack_sorted(a))
                    doc.append(np.frombuffer(b, np.uint16, n))
                    frequency.append(np.frombuffer(b, np.uint32, n, 2 * n))
            token, doc, frequency = np.concatenate(token), np.concatenate(doc), np.concatenate(frequency)
            order = np.lexsort((token, doc))
            token, doc, frequency = token[order], doc[order], frequency[order]
            edges = np.searchsorted(doc, np.arange(len(ids) + 1))
            for i in range(len(ids)):
                n, m = int(counts[i]), int(edges[i + 1] - edges[i])
                least = -(-n * percent // 100)
                if m and m >= least:
                    part = slice(edges[i], edges[i + 1])
                    yield int(ids[i]), n, n - m, _bitmap(token[part]), token[part].tobytes(), _signatures(n, least, token[part], frequency[part]).astype(np.int64)

        held: dict[int, list] = {}
        for batch in batches:
            for _, block, n, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(block, []).append((n, a, b))
        for block in sorted(held):
            out = list(rows(held.pop(block)))
            for at in range(0, len(out), 256):
                types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
                columns = [pa.array(c, t) for c, t in zip(zip(*out[at : at + 256], strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "own", "bits", "tokens", "signatures"])

    return shared.repartition(width, "part").mapInArrow(lean(run), "doc_id long, n long, own long, bits array<bigint>, tokens binary, signatures array<bigint>")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets really reach the similarity. A token of one set only can't be in the intersection."""
    of = lambda name: sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"n{name}"), F.col("tokens").alias(f"t{name}"))
    rows = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "na", "nb", "ta", "tb")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            common = np.array([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)], dtype=np.int64)
            linked = pa.array(100 * common >= percent * (na + nb - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(linked)

    return rows.mapInArrow(lean(run), "a long, b long")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (doc_id, label) after the links (a, b) between labels have connected some of them."""
    groups = components(links).select(F.col("node").alias("label"), "component")
    return stored(labels.join(groups, "label", "left").select("doc_id", F.coalesce("component", "label").alias("label")), "labels")


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (signature, doc_id, label, ...) twice, with i and j, so that each two members of a signature with different
    labels meet once where signature, i and j are equal: with labels in order where i = j, with labels apart where i < j.

    A large group is cut into parts, and each pair of parts is compared in a task of its own. The members of its largest
    component come first, in parts that meet only those of the others: they are connected already. So a group of which few
    are outside that component is sent about once, and another one half its number of parts for each side."""
    labels = rows.groupBy("signature", "label").agg(F.count("*").alias("n"))
    sizes = labels.groupBy("signature").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    large, parts = F.col("n") > GROUP_PART, lambda n: F.ceil(n / F.lit(GROUP_PART)).cast("int")
    sizes = sizes.select("signature", F.when(large, F.col("most.label")).alias("main"), F.when(large, parts(F.col("most.n"))).otherwise(0).alias("before"), F.when(large, parts(F.col("n") - F.col("most.n"))).otherwise(1).alias("after"))
    inside, dealt = F.col("label").eqNullSafe(F.col("main")), lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    rows = rows.join(sizes, "signature").withColumn("inside", inside)
    rows = rows.withColumn("part", F.when(F.col("inside"), dealt("before")).otherwise(F.col("before") + dealt("after")))
    later = F.sequence(F.when(F.col("inside"), F.col("before")).otherwise(F.col("part")), F.col("before") + F.col("after") - 1)
    spare = ("main", "before", "after", "inside", "part")
    x = rows.withColumns({"i": F.col("part"), "j": F.explode(later)}).drop(*spare)
    y = rows.filter(~F.col("inside")).withColumns({"j": F.col("part"), "i": F.explode(F.sequence(F.lit(0), F.col("part")))}).drop(*spare)
    return x, y


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    spark = docs.sparkSession
    bounded_batches(spark, BLOCK_BYTES)
    width = shuffle_width(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = stored(fingerprints(docs, size), "fingerprints")
    classes = prints.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    classes = stored(classes, "classes")
    spare = stored(prints.select("doc_id").distinct().join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_anti"), "copies")
    texts = join_small(docs.filter("doc_id IS NOT NULL"), spare, "doc_id", "left_anti")
    sets = stored(_sets(_shared_tokens(_packed_tokens(texts, size, width), width), width, percent), "sets")
    entries = stored(sets.select("doc_id", F.explode("signatures").alias("signature")).distinct(), "signatures")

    # Leaders: the first document of a signature; each document is compared with the one it shares most signatures with.
    leaders = entries.groupBy("signature").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).filter("n > 1").select("signature", "leader")
    entries = stored(entries.join(leaders, "signature"), "entries")
    shares = entries.filter("doc_id <> leader").groupBy("doc_id", "leader").agg(F.count("*").alias("n"))
    best = shares.groupBy("doc_id").agg(F.max(F.struct("n", "leader"))["leader"].alias("leader"))
    links = stored(_links(best.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")), sets, percent), "links")
    labels = _merged(entries.select("doc_id", F.col("doc_id").alias("label")).distinct(), links)
    entries = entries.select("signature", "doc_id")
    tried = best.select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b"))

    def open_groups(entries, labels):
        """The signatures whose members are not yet all connected."""
        rows = entries.join(labels, "doc_id")
        mixed = rows.groupBy("signature").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("signature")
        return stored(rows.join(mixed, "signature"), "open-groups")

    for _ in range(ROUNDS):
        rows = open_groups(entries, labels)
        entries = rows.select("signature", "doc_id")
        if rows.isEmpty():
            break
        chosen = rows.groupBy("signature", "label").agg(F.min("doc_id").alias("doc_id"))
        heads = chosen.groupBy("signature").agg(F.min(F.struct("label", "doc_id")).alias("head"))
        pairs = chosen.join(heads, "signature").filter(F.col("label") != F.col("head.label"))
        pairs = pairs.select(F.least("doc_id", "head.doc_id").alias("a"), F.greatest("doc_id", "head.doc_id").alias("b")).distinct()
        found = stored(_links(pairs, sets, percent), "links")
        if found.isEmpty():
            break
        of = lambda name: labels.select(F.col("doc_id").alias(name), F.col("label").alias(f"l{name}"))  # noqa: E731, B023
        labels = _merged(labels, found.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))

    rows = open_groups(entries, labels)
    if not rows.isEmpty():
        rows = rows.join(sets.select("doc_id", "n", "own", "bits"), "doc_id")
        x, y = (side.alias(name) for side, name in zip(_sides(rows), "xy", strict=True))
        apart = (F.col("x.label") < F.col("y.label")) | (F.col("x.i") < F.col("x.j")) & (F.col("x.label") != F.col("y.label"))
        fits = apart & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        # Linked sets differ in few tokens: in those that only one set has at all, and in as many others as bits differ.
        differ = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BITMAP_WORDS)), F.col("x.own") + F.col("y.own"))
        fits &= differ * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)
        same = (F.col("x.signature") == F.col("y.signature")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
        pairs = x.join(y, same & fits)
        pairs = pairs.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
        found = stored(_links(pairs.join(tried, ["a", "b"], "left_anti"), sets, percent), "links")
        of = lambda name: labels.select(F.col("doc_id").alias(name), F.col("label").alias(f"l{name}"))
        labels = _merged(labels, found.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))

    least = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_first = labels.join(least, "label").select(F.col("doc_id").alias("first"), "component_id")
    of_class = stored(classes.join(of_first, "first", "left").select("digest", F.coalesce("component_id", "first").alias("component_id")), "components")
    out = prints.join(of_class, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
