"""Katz backoff language model of order three, with Good-Turing discounts and exactly normalised backoff weights.

P3(w | u v) = d3(r) r / c(u v) where (u, v, w) was seen r >= LEAST[2] times, else a(u v) P2(w | v); P2(w | v) = d2(r) r / c(v)
where (v, w) was seen r > 0 times, else a(v) P1(w); P1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), which leaves mass for one
unknown word. a() is 1 for a context never seen, and otherwise what the seen words leave over what the shorter context gives
to the others, so that each context's sum over all words and the unknown one is exactly 1. A context that would leave
nothing, all its words being seen more than five times, counts one more. d(r) is Katz' discount from the counts of counts
for r <= 5 (1 - 1 / 2 r where they give none) and 1 beyond. Trigrams seen once aren't kept (``LEAST``): their mass goes to
the shorter context. A text begins with one start and ends with one end; its first token
has the start alone as context.

Tables, written to the shared folder and read from there: words, a row for each part of the words' hashes with words, ids,
counts; bigrams, a row for each group of contexts v with their words and counts; contexts, a row for each group with each v's total and log_backoff; trigrams, a row for each
group of middle words v with u, w, count of those kept; and the backoff weights of (u, v) where they are asked for.

How it runs. Texts are gathered into blocks of a bounded number of tokens and coded by the block's own list of words. Words
are counted and numbered by parts of their hashes, frequent ones with small numbers, and the numbers go back to the blocks;
the number of parts is fixed, so a block has a bounded number of rows. Then, level by
level, a block sends what it holds to the tables and gets counts and weights back: one row for each group of words v, with
what stands around them, each distinct n-gram once and packed in few bytes. Groups have a fixed number of the vocabulary's
words each, so the rows grow in proportion to the input and never with the square of anything. A frequent v is a group of
its own, split by w at level two and by u at level three, and a frequent pair (u, v) by w besides, so no task gets more than
a bounded share. Level three is done in ``SLICES`` parts of the words, and the end in as many parts of
the blocks, which bounds the disk that a shuffle takes. Last, each block
evaluates its tokens by recursion from the longest context down.

Nulls and ties: a null or empty text has one token, its end. A null in the held-out column counts as false. Rows that
repeat get a result each, and are learnt from each time. Other columns are ignored. An empty table gives no rows; without
any training text every word is unknown.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, from_plane_rows, importable, lean, lean_pair, mix, pack_numbers, pack_planes, packed_rows, plane_rows, shuffle_width, stored, unpack_numbers, unpack_planes, unpacked_rows, words

#: Counts up to this are discounted.
MOST_DISCOUNTED = 5
#: How often an n-gram of each order must be seen to be kept.
LEAST = (1, 1, 2)
#: A context with this share of all tokens or more is split; there are at most 1 / HOT_SHARE such words, and such pairs.
HOT_SHARE = 1 / 2000
ADDED = 0.1
#: Tokens of a block at most, unless one batch of texts has more.
BLOCK_TOKENS = 1 << 20
#: The words' hashes are dealt into 2 ** WORD_BITS parts, whatever the input.
WORD_BITS = 11
#: Words of the vocabulary in a group. A row costs about as much as what stands around a hundred words, so groups aren't small.
GROUP_WORDS = 512
#: Parts in which level three, and then the evaluation, is done.
SLICES = 2
#: Bytes of an Arrow batch.
BATCH = "8m"
#: Rows of a batch that a worker returns.
ROWS = 2048
_END = int(mix(np.array([11], np.uint64)).view(np.int64)[0])
_K = MOST_DISCOUNTED


# ---------------------------------------------------------------------------------------------------------------------
# Blocks and words


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each block: doc_ids, whether each is held out, numbers of tokens, the tokens as numbers of the block's
    words (frequent ones first), those words' hashes in their order, which of them each number is, and how often each occurs
    in texts to learn from."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = ["block", "ids", "held", "sizes", "codes", "order", "words", "n"]
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def row():
            ids, out = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
            token, sizes = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
            coded = pa.array(token).dictionary_encode()
            used, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            by_hash = np.argsort(used)
            learnt = np.bincount(code, weights=np.repeat(~out, sizes), minlength=len(used)).astype(np.int64)[by_hash]
            order = np.argsort(-np.bincount(code, minlength=len(used))[by_hash], kind="stable")
            place = np.empty(len(used), np.int32)
            place[by_hash[order]] = np.arange(len(used))
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            raw = lambda values: pa.array([values.tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([block]), one(ids.to_pylist(), pa.int64()), one(out, pa.bool_()), one(sizes, pa.int32()), pa.array([pack_planes(place[code])], pa.binary()), raw(order.astype(np.int32)), raw(used[by_hash]), raw(pack_numbers(learnt)[0])], names)

        tokens = 0
        for batch in batches:
            hashes, counts = words(batch.column(2))
            token = np.full(len(hashes) + len(counts), _END, np.int64)
            token[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes.view(np.int64)
            held.append((batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), token, counts + 1))
            tokens += len(token)
            if tokens >= BLOCK_TOKENS:
                yield row()
                held, tokens, block = [], 0, block + 1
        if tokens:
            yield row()

    return rows.mapInArrow(lean(run), "block long, ids array<bigint>, held array<boolean>, sizes array<int>, codes binary, order binary, words binary, n binary")


_ANSWERS, _TABLE, _STATS, _SEEN = 0, 1, 2, 3


def _send_words(blocks: DataFrame) -> DataFrame:
    """A block's words by parts of their hashes, and how often each is to learn from."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in _rows(batch):
                word, n = np.frombuffer(row["words"], np.int64), unpack_numbers(np.frombuffer(row["n"], np.uint8))
                part = word >> (64 - WORD_BITS)
                edges = _edges(part)
                heads = part[edges[:-1]].astype(np.int32)
                yield from pa.Table.from_arrays([pa.array(heads), pa.array(np.full(len(heads), row["block"])), _raw(word, edges), packed_rows(n, edges)], ["part", "block", "words", "n"]).to_batches(ROWS)

    return blocks.select("block", "words", "n").mapInArrow(lean(run), "part int, block long, words binary, n binary")


def _number_words(sent: DataFrame, width: int) -> DataFrame:
    """Answers to the blocks (ids and counts), the word table, and of each task its tokens, words to learn from, texts and
    the end's id. Ids are above 0, small for frequent words, without a global order."""

    def run(batches):
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        word = np.frombuffer(b"".join(rows.column("words").to_pylist()), np.int64)
        n, edges = unpacked_rows(rows.column("n"))
        first, of = _distinct(word)
        count = np.bincount(of, weights=n, minlength=len(first)).astype(np.int64)
        word = word[first]
        part = word >> (64 - WORD_BITS)
        order, heads = np.lexsort((word, -count, part)), _edges(part)
        rank = np.arange(1, len(word) + 1) - np.repeat(heads[:-1], np.diff(heads))
        ids = np.empty(len(word), np.int64)
        ids[order] = (rank << WORD_BITS) + part + (1 << WORD_BITS >> 1)
        names = ["kind", "part", "block", "words", "ids", "counts", "stats"]
        whole = lambda kind, k, columns: pa.Table.from_arrays([pa.array(np.full(k, kind, np.int32)), *columns], names).to_batches(ROWS)
        raw, many = pa.binary(), pa.list_(pa.int64())
        k = rows.num_rows
        yield from whole(_ANSWERS, k, [rows.column("part"), rows.column("block"), pa.nulls(k, raw), packed_rows(ids[of], edges), packed_rows(count[of], edges), pa.nulls(k, many)])
        k = len(heads) - 1
        yield from whole(_TABLE, k, [pa.array(part[heads[:-1]].astype(np.int32)), pa.nulls(k, pa.int64()), _raw(word, heads), packed_rows(ids, heads), packed_rows(count, heads), pa.nulls(k, many)])
        end = word == _END
        stats = [count.sum(), (count > 0).sum(), count[end].sum(), ids[end].sum()]
        yield from whole(_SEEN, 1, [pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), *[pa.nulls(1, raw)] * 3, pa.array([list(map(int, stats))], many)])

    return sent.repartition(width, "part").mapInArrow(lean(run), "kind int, part int, block long, words binary, ids binary, counts binary, stats array<bigint>")


_KNOWN = "block long, ids array<bigint>, held array<boolean>, sizes array<int>, codes binary, place binary, wid binary, wc binary"


def _numbered(blocks: DataFrame, answers: DataFrame, facts: _Facts) -> DataFrame:
    """The blocks with the ids and counts of their words in the order of their groups and ids, and the place, from 1, that
    each number of ``codes`` has in it."""

    def run(left, right):
        import pyarrow as pa

        order = np.frombuffer(left.column("order")[0].as_py(), np.int32)
        wid, wc = (_in_order(right, ["part"], c)[order] for c in ("ids", "counts"))
        by_group = np.lexsort((wid, facts.group(wid, wc)))
        place = np.empty(len(wid), np.int64)
        place[by_group] = np.arange(1, len(wid) + 1)
        out = left.drop_columns(["order"])
        for name, values in (("place", place), ("wid", wid[by_group]), ("wc", wc[by_group])):
            out = out.append_column(name, pa.array([pack_planes(values)], pa.binary()))
        return out

    return blocks.drop("words", "n").groupBy("block").cogroup(answers.select("block", "part", "ids", "counts").groupBy("block")).applyInArrow(lean_pair(run), _KNOWN)


@dataclass
class _Facts:
    """What holds for all blocks: training tokens, their words, texts to learn from, the end's id, and the start's total and
    weight."""

    n: int
    v: int
    texts: int
    end: int
    hot: float
    start: tuple[int, float] = (0, 0.0)

    @property
    def z(self) -> float:
        return self.n + ADDED * (self.v + 1)

    def group(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The group of each word; below 0 for the start and for frequent words, which have groups of their own."""
        groups = mix(ids.astype(np.uint64)) % np.uint64(max(1, self.v // GROUP_WORDS))
        return np.where((counts >= self.hot) | (ids == 0), ids - (1 << 62), groups.astype(np.int64))


class _Block:
    """One block, its words numbered from 1 in the order of their groups and ids; 0 is the start of a text."""

    def __init__(self, row: dict, facts: _Facts):
        wid, wc = (unpack_planes(row[k]).astype(np.int64) for k in ("wid", "wc"))
        self.facts, self.number, self.ids = facts, row["block"], row["ids"]
        self.word = unpack_planes(row["place"]).astype(np.int32)[unpack_planes(row["codes"])]
        self.id = np.append(0, wid)
        self.count = np.append(facts.texts, wc)
        self.group = np.append(-(1 << 62), facts.group(wid, wc))
        self.frequent = self.count >= facts.hot
        self.sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.held = np.asarray(row["held"], dtype=bool)
        self.base = len(self.id)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.first] = 0
        self.learnt = ~np.repeat(self.held, self.sizes)
        self.low = unpack_planes(row["low"]) if row.get("low") is not None else None

    def pairs(self):
        """Distinct pairs: v, w, split, in the order of rows, and the pair of each token."""
        first, of = _distinct(self.before * np.int64(self.base) + self.word)
        v, w = self.before[first].astype(np.int64), self.word[first].astype(np.int64)
        split, some = np.zeros(len(v), np.int64), np.flatnonzero(self.frequent[v])
        split[some] = _split(self.count[v[some]], self.facts.hot, self.id[w[some]])
        order = _resorted(some, v, split)
        if order is not None:
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            v, w, split, of = v[order], w[order], split[order], place[of]
        return v, w, split, of

    def triples(self, at: np.ndarray):
        """Distinct trigrams of the tokens ``at``: u, v, w, split, own, in the order of rows, and the trigram of each token.
        A frequent pair (u, v) has rows of its own, of which ``own`` tells u."""
        u, v, w = self.before[at - 1], self.before[at], self.word[at]
        base = np.int64(self.base)
        first, of = _distinct(_distinct(v * base + u)[1] * base + w)
        u, v, w = (x[first].astype(np.int64) for x in (u, v, w))
        split, own, some = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64), np.flatnonzero(self.frequent[v])
        alone, of_u = self.low[at[first[some]] - 1] >= self.facts.hot, self.id[u[some]]
        split[some] = _split(self.count[v[some]], self.facts.hot, np.where(alone, self.id[w[some]] + 7 * of_u, of_u))
        own[some[alone]] = of_u[alone] + 1
        order = _resorted(some, v, split, own)
        if order is not None:
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            u, v, w, split, own, of, first = u[order], v[order], w[order], split[order], own[order], place[of], first[order]
        return u, v, w, split, own, of, at[first]

    def later(self, which: int | None = None, slices: int = 1) -> np.ndarray:
        """The tokens that have two before them, the start counted, and about which level three is asked; of one slice or of
        all. A context seen less often than a trigram must be has no kept trigram, so its weight is 1 and nothing need be
        asked, but for what comes back about v: its weight, if a pair with it was never seen, and its total, if that can be
        above its count. For the latter one token of each v will do."""
        has, before = np.zeros(len(self.word), bool), self.word[:-1]
        has[1:] = (self.low[:-1] >= LEAST[2]) | (self.low[1:] == 0) & (self.count > 0)[before]
        has[self.first] = False
        # Words with a total that can be above their count, and none of whose tokens is asked about yet.
        alone = self.count > MOST_DISCOUNTED
        alone[before[has[1:]]] = False
        some = alone[self.before]
        some[self.first] = False
        at = np.flatnonzero(some)
        has[at[np.unique(self.before[at], return_index=True)[1]]] = True
        if which is not None and slices > 1:
            has[1:] &= (self.group % slices == which)[self.word[:-1]]
        return np.flatnonzero(has)


def _split(total: np.ndarray, hot: float, by: np.ndarray) -> np.ndarray:
    """Which part of a frequent context's rows each n-gram is in."""
    return (mix(by.astype(np.uint64)) % np.ceil(total / hot).astype(np.uint64)).astype(np.int64)


def _resorted(some: np.ndarray, v: np.ndarray, *then: np.ndarray) -> np.ndarray | None:
    """A stable order by v, which is sorted, and then by what is 0 but at the places ``some``, which are all that their v
    have."""
    keys = [t[some] for t in then]
    if not any(k.any() for k in keys):
        return None
    for i, k in enumerate(keys):
        if len(k) and k.max() >> 20:  # few different numbers, but large ones
            odd, keys[i] = np.flatnonzero(k), np.zeros(len(k), np.int64)
            keys[i][odd] = np.unique(k[odd], return_inverse=True)[1] + 1
    order = np.arange(len(v))
    order[some] = some[_stable(v[some], *keys)]
    return order


def _whole(keys) -> np.ndarray | None:
    """One number for the keys, all >= 0, the first counting most, if they fit into 63 bits."""
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    if sum(bits) > 63:
        return None
    whole = keys[0].astype(np.int64)
    for k, n in zip(keys[1:], bits[1:], strict=True):
        whole <<= n
        whole |= k
    return whole


def _stable(*keys: np.ndarray) -> np.ndarray:
    """A stable order by numbers >= 0, the first key first."""
    whole = _whole([*keys, np.arange(len(keys[0]))])
    if whole is None:
        return np.lexsort(keys[::-1])
    whole.sort()
    return whole & ((1 << max(0, len(whole) - 1).bit_length()) - 1)


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by numbers >= 0, the first key first, and where in it others begin, and the end."""
    whole = _whole(keys)
    if whole is None:
        order = np.lexsort(keys[::-1])
        return order, _edges(*(k[order] for k in keys))
    order, whole = _sorted(whole)
    return order, _edges(whole)


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by numbers, and the numbers in it. Where number and place fit into 63 bits they are sorted as one, which is
    several times faster than sorting places."""
    bits = len(key).bit_length()
    if not len(key) or int(key.min()) < 0 or int(key.max()) >> (63 - bits):
        order = np.argsort(key)
        return order, key[order]
    whole = key.astype(np.int64) << bits
    whole |= np.arange(len(key))
    whole.sort()
    return whole & ((1 << bits) - 1), whole >> bits


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each different key, in their order, a place where it stands; and for each place which of these it has. As
    np.unique, whose stable sort for first places takes far longer."""
    order, key = _sorted(key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    of = np.empty(len(key), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], of


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins, and the end."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def _ranked(rows: list[np.ndarray], of_row: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each v of a row a number that stands for the key of the row and for v, in their order."""
    by_key = np.lexsort(rows[::-1])
    key = np.empty(len(by_key), np.int64)
    key[by_key] = np.repeat(np.arange(len(cuts := _edges(*(r[by_key] for r in rows))) - 1), np.diff(cuts))
    order, new = _grouped(key[of_row], v)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.repeat(np.arange(len(new) - 1), np.diff(new))
    return rank


def _totals(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums between edges."""
    return np.add.reduceat(values, edges[:-1]) if len(edges) > 1 else values[:0]


def _any(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.logical_or.reduceat(values, edges[:-1]) if len(edges) > 1 else values[:0]


def _lists(values: np.ndarray, edges: np.ndarray, kind):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values, kind))


def _raw(values: np.ndarray, edges: np.ndarray):
    """An Arrow binary array: row i has the eight bytes of each of values[edges[i]:edges[i + 1]]."""
    import pyarrow as pa

    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 8).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _rows(df: DataFrame):
    """Rows of an Arrow batch as dictionaries whose lists are arrays."""
    for i in range(df.num_rows):
        row = {}
        for name, column in zip(df.schema.names, df.columns, strict=True):
            value = column[i]
            values = getattr(value, "values", None)
            row[name] = values.to_numpy(zero_copy_only=False) if values is not None and name != "ids" else value.as_py() if name != "ids" else values
        yield row


def _by_count(counts: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    """For each of ``n`` contexts, how many of its counts are 1, ..., _K + 1, and the sum of those above _K. ``of``: the context
    of each count."""
    by = np.bincount(of * (_K + 3) + np.minimum(counts, _K + 2), minlength=n * (_K + 3)).reshape(n, _K + 3)
    large = np.flatnonzero(counts > _K)
    return [*by.T[1 : _K + 2], np.bincount(of[large], weights=counts[large], minlength=n).astype(np.int64)]


def discounts(counts: np.ndarray) -> np.ndarray:
    """Katz' discounts d(0..k+1) from the numbers of n-grams seen 1, ..., k + 1 times; 1 - 1 / 2 r where
    they give none in (0, 1)."""
    d = np.append(1 - 0.5 / np.maximum(np.arange(_K + 1), 1), 1.0)
    if counts[0] > 0:
        common = (_K + 1) * counts[_K] / counts[0]
        for r in range(1, _K + 1):
            if counts[r - 1] > 0 and common < 1:
                value = ((r + 1) * counts[r] / (r * counts[r - 1]) - common) / (1 - common)
                d[r] = value if 0 < value < 1 else d[r]
    return d


# ---------------------------------------------------------------------------------------------------------------------
# Level two


_TWO = "kind int, grp long, split int, block long, data binary, rest binary, v array<bigint>, sizes array<int>, words array<bigint>, counts array<bigint>, stats array<double>"


def _steps(values: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers, which begin anew with each new key."""
    out = np.diff(values, prepend=0)
    heads = _edges(*keys)[:-1]
    out[heads] = values[heads]
    return out


def _from_steps(steps: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    edges = _edges(*keys)
    sums = np.cumsum(steps)
    return sums - np.repeat(np.append(0, sums)[edges[:-1]], np.diff(edges))


#: Columns of a row: its words v as packed steps, and how many n-grams each has; in their order, n-grams then are columns of
#: planes without v.
_HEADS = ("v", "per_v")


def _planes(*names: str) -> list[str]:
    return [f"{n}{part}" for n in names for part in ("", "_rest")]


def _sent(block: _Block, v: np.ndarray, split: np.ndarray, *own: np.ndarray):
    """The plain columns of a block's rows, in each of which the n-grams have one group, split and own; where rows begin; and
    the columns _HEADS."""
    import pyarrow as pa

    runs = _edges(v, split, *own)
    at = runs[:-1]
    keys = [block.group[v[at]], split[at], *(o[at] for o in own)]
    rows = _edges(*keys)
    heads = rows[:-1]
    packed = [packed_rows(_steps(block.id[v[at]], *keys), rows), packed_rows(np.diff(runs), rows)]
    plain = [pa.array(keys[0][heads]), pa.array(keys[1][heads].astype(np.int32)), *(pa.array(k[heads]) for k in keys[2:]), pa.array(np.full(len(heads), block.number))]
    return plain, runs[rows], packed


def _received(rows, first: int):
    """Of the columns _HEADS, the first of which is ``first``: where each row's words v begin, the row of each, the words, and
    where the n-grams of each begin."""
    v, edges = unpacked_rows(rows.column(first))
    of_row = np.repeat(np.arange(rows.num_rows), np.diff(edges))
    return edges, of_row, _from_steps(v, of_row), np.append(0, np.cumsum(unpacked_rows(rows.column(first + 1))[0]))


def _send_pairs(corpus: DataFrame, facts: _Facts) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in _rows(batch):
                block = _Block(row, facts)
                v, w, split, of = block.pairs()
                n = np.bincount(of, weights=block.learnt, minlength=len(v)).astype(np.int64)
                plain, edges, packed = _sent(block, v, split)
                columns = [*plain, *packed, *plane_rows(block.id[w], edges, np.uint16), *plane_rows(block.count[w], edges, np.uint16), *plane_rows(n, edges)]
                yield from pa.Table.from_arrays(columns, ["grp", "split", "block", *names]).to_batches(ROWS)

    names = [*_HEADS, *_planes("w", "c", "n")]
    return corpus.mapInArrow(lean(run), "grp long, split int, block long, " + ", ".join(f"{n} binary" for n in names))


def _count_pairs(sent: DataFrame, width: int, end: int) -> DataFrame:
    """Answers to the blocks (each pair's count), the bigram table with each context's statistics, and of each task how many
    pairs were seen 1, ..., _K + 1 times, and how many once with another word than the end."""

    def run(batches):
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        row_group, row_split, row_block = (rows.column(i).to_numpy() for i in range(3))
        _, of_row, v, runs = _received(rows, 3)
        (w, edges), (c, _), (n, _) = (from_plane_rows(rows.column(i), rows.column(i + 1), low) for i, low in ((5, np.uint16), (7, np.uint16), (9, np.uint8)))
        del batches, rows
        of_v = np.repeat(np.arange(len(v), dtype=np.int32), np.diff(runs))
        rank = _ranked([row_group, row_split], of_row, v)[of_v]
        order, cuts = _grouped(rank, w)
        total = _totals(n[order], cuts)
        back = np.empty(len(w), np.int64)
        back[order] = np.repeat(total, np.diff(cuts))
        names = ["kind", "grp", "split", "block", "data", "rest", "v", "sizes", "words", "counts", "stats"]
        many, real = pa.list_(pa.int64()), pa.list_(pa.float64())
        whole = lambda kind, k, columns: pa.Table.from_arrays([pa.array(np.full(k, kind, np.int32)), *columns], names).to_batches(ROWS)
        k = len(row_group)
        yield from whole(_ANSWERS, k, [pa.array(row_group), pa.array(row_split), pa.array(row_block), *plane_rows(back, edges), pa.nulls(k, many), pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, many), pa.nulls(k, many), pa.nulls(k, real)])

        seen = np.flatnonzero(total > 0)
        first = order[cuts[:-1][seen]]
        at = _edges(rank[first])
        word, total, c, heads = w[first], total[seen], c[first], of_v[first[at[:-1]]]
        v, split, group = v[heads], row_split[of_row[heads]], row_group[of_row[heads]]
        rows = _edges(group, split)
        k = len(rows) - 1
        of = np.repeat(np.arange(len(heads)), np.diff(at))
        stats = np.stack([*_by_count(total, of, len(heads)), _totals(total, at), _totals(c + ADDED, at)], axis=1).astype(np.float64) if k else np.zeros((0, _K + 4))
        of_words = at[rows]
        yield from whole(_TABLE, k, [pa.array(group[rows[:-1]]), pa.array(split[rows[:-1]].astype(np.int32)), pa.nulls(k, pa.int64()), *[pa.nulls(k, pa.binary())] * 2, _lists(v, rows, pa.int64()), _lists(np.diff(at).astype(np.int32), rows, pa.int32()), _lists(word, of_words, pa.int64()), _lists(total, of_words, pa.int64()), _lists(stats.reshape(-1), rows * (_K + 4), pa.float64())])
        counts = [*((total == r).sum() for r in range(1, _K + 2)), ((total == 1) & (word != end)).sum()]
        yield from whole(_SEEN, 1, [pa.array([0]), pa.array([0], pa.int32()), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 2, pa.nulls(1, many), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, many), pa.nulls(1, many), pa.array([list(map(float, counts))], real)])

    return sent.repartition(width, "grp", "split").mapInArrow(lean(run), _TWO)


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    """The sums of the first ``width`` numbers of the column stats in what the tasks tell of all they have seen."""
    row = rows.filter(F.col("kind") == _SEEN).agg(*(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(width))).first()
    return np.array(list(row))


def _left(stats, d: np.ndarray, total):
    """What the seen words of a context leave; for Columns and arrays alike. stats[i]: as _by_count gives them."""
    return total - sum((stats[r - 1] * (r * float(d[r])) for r in range(1, _K + 1)), stats[_K + 1])


def contexts(table: DataFrame, d: np.ndarray, z: float, hot: float) -> DataFrame:
    """Rows (grp, split, v, total, more, log_backoff) of the bigram table's contexts, a row for each group, and for each split
    of a frequent word: words, their totals, what these are above their counts, all packed, and log10 of their weights as
    doubles. A context that leaves nothing counts one more.

    Packed, because Spark measures a batch anew at each row, and that takes as long as a list column has rows."""
    importable(table.sparkSession)
    width = _K + 4
    # A frequent word's statistics are in as many rows as it has splits: sums of a few numbers each.
    sums = table.filter("grp < 0").groupBy("grp").agg(F.first("v").alias("v"), *(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(width)))
    frequent = sums.select("grp", "v", F.array(*(f"s{i}" for i in range(width))).alias("stats"))
    rows = table.filter("grp >= 0").select("grp", "v", "stats").unionByName(frequent)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            edges = np.append(0, np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False)))
            stats = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T
            n, above = stats[_K + 2], stats[_K + 1]
            nothing = above == n
            left = np.where(nothing, 1.0, _left(stats, d, n))
            back = np.log10(left / (n + nothing)) - np.log10(1 - stats[_K + 3] / z)
            words = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            lists = [*(packed_rows(x.astype(np.int64), edges) for x in (words, n + nothing, nothing)), _raw(back, edges)]
            parts = np.where(n >= hot, np.ceil(n / hot), 1).astype(np.int32)[edges[:-1]] if len(edges) > 1 else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts), *lists], ["grp", "parts", "v", "total", "more", "log_backoff"])

    found = rows.mapInArrow(lean(run), "grp long, parts int, v binary, total binary, more binary, log_backoff binary")
    return found.select("grp", F.explode(F.sequence(F.lit(0), F.when(F.col("grp") < 0, F.col("parts")).otherwise(1) - 1)).alias("split"), "v", "total", "more", "log_backoff")


def _answered(corpus: DataFrame, answers: DataFrame, facts: _Facts) -> DataFrame:
    """The blocks with the count of the pair that ends at each token (``low``)."""

    def run(left, right):
        import pyarrow as pa

        block = _Block(next(_rows(left.combine_chunks().to_batches()[0])), facts)
        counts = _in_order(right, ["split", "grp"], "data", "rest")
        return left.append_column("low", pa.array([pack_planes(counts[block.pairs()[3]])], pa.binary()))

    return corpus.groupBy("block").cogroup(answers.select("block", "grp", "split", "data", "rest").groupBy("block")).applyInArrow(lean_pair(run), f"{_KNOWN}, low binary")


def _in_order(table, keys: list[str], data: str, rest: str | None = None, kind=None) -> np.ndarray:
    """The numbers of a block's answers, rows sorted by ``keys`` (the last first), as the block sent them. ``rest``: the other
    column of planes."""
    import pyarrow as pa

    table = table.combine_chunks()
    order = np.lexsort(tuple(table.column(k).to_numpy() for k in keys))
    column = table.column(data).take(pa.array(order))
    if rest:
        return from_plane_rows(column, table.column(rest).take(pa.array(order)))[0]
    if kind is None:
        return unpacked_rows(column)[0]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), kind)


# ---------------------------------------------------------------------------------------------------------------------
# Level three


def _send_triples(corpus: DataFrame, facts: _Facts, which: int, slices: int) -> DataFrame:
    """Rows of the trigrams around each group's words v, of one slice: u, v, w, how often to learn from, and the count of
    (v, w)."""
    names = ["grp", "split", "own", "block", *_HEADS, *_planes("u", "w", "n", "low")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in _rows(batch):
                block = _Block(row, facts)
                at = block.later(which, slices)
                if not len(at):
                    continue
                u, v, w, split, own, of, first = block.triples(at)
                n = np.bincount(of, weights=block.learnt[at], minlength=len(u)).astype(np.int64)
                plain, edges, packed = _sent(block, v, split, own)
                columns = [*plain, *packed, *plane_rows(block.id[u], edges, np.uint16), *plane_rows(block.id[w], edges, np.uint16), *plane_rows(n, edges), *plane_rows(block.low[first], edges)]
                yield from pa.Table.from_arrays(columns, names).to_batches(ROWS)

    return corpus.mapInArrow(lean(run), "grp long, split int, own long, block long, " + ", ".join(f"{n} binary" for n in names[4:]))


_THREE = "kind int, grp long, split int, own long, block long, data binary, rest binary, above binary, masses binary, extra binary, low_backs binary, v array<bigint>, u array<bigint>, w array<bigint>, counts array<bigint>, stats array<double>"


def _count_triples(sent: DataFrame, known: DataFrame, width: int, facts: _Facts, which: int, slices: int, d2: np.ndarray) -> DataFrame:
    """Answers to the blocks, the trigram table, the statistics of frequent pairs, whose trigrams are in many tasks, and of
    each task how many trigrams were seen 1, ..., _K + 1 times.

    ``data``: 2 r + 1 for a kept trigram whose context leaves nothing, 2 r for another kept one, 1 for one not kept whose
    context has others that are, else 0. For each context with a 1, ``above`` holds how many of its kept trigrams were seen
    1, ..., _K times and the sum of the counts above, and ``masses`` what the shorter context gives to the kept ones: all
    that its weight depends on besides the discounts. ``extra``: for each v of a row what its total is above its count;
    ``low_backs``: log10 of the weight of each v of which a pair was never seen. ``known``: the contexts."""
    ours = [*_HEADS, *_planes("u", "w", "n", "low")]
    empty = [F.lit(b"").alias(c) for c in ours]
    lists = {"cv": "v", "ctotal": "total", "cmore": "more", "cback": "log_backoff"}
    own = known.filter(F.pmod("grp", F.lit(slices)) == which).select("grp", "split", F.lit(-1).cast("long").alias("own"), F.lit(-1).cast("long").alias("block"), *empty, *(F.col(c).alias(n) for n, c in lists.items()))
    both = sent.withColumns({n: F.lit(b"") for n in lists}).unionByName(own)
    columns = ["grp", "split", "own", "block", *lists, *ours]

    def run(batches):
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        cv, ctotal, cmore = (np.append(unpacked_rows(rows.column(i))[0], 0) for i in range(4, 7))
        cback = np.append(np.frombuffer(b"".join(rows.column(7).to_pylist())), 0.0)
        by_word = np.argsort(cv[:-1], kind="stable")
        cv, ctotal, cmore, cback = (np.append(x[:-1][by_word], x.dtype.type(0)) for x in (cv, ctotal, cmore, cback))
        row_group, row_split, row_own, row_block = (rows.column(i).to_numpy() for i in range(4))
        per_row, of_row, v, runs = _received(rows, 8)
        (u, edges), (w, _), (n, _), (low, _) = (from_plane_rows(rows.column(i), rows.column(i + 1), kind) for i, kind in ((10, np.uint16), (12, np.uint16), (14, np.uint8), (16, np.uint8)))
        del batches, rows

        def of(words):
            at = np.minimum(np.searchsorted(cv[:-1], words), len(cv) - 1)
            return np.where(cv[at] == words, at, len(cv) - 1) if len(cv) > 1 else np.zeros(len(words), np.int64)

        of_v, place = np.repeat(np.arange(len(v), dtype=np.int32), np.diff(runs)), of(v)
        rank = _ranked([row_group, row_split, row_own], of_row, v)[of_v]
        order, cuts = _grouped(rank, u, w)
        first = order[cuts[:-1]]
        count = _totals(n[order], cuts)
        pair = _edges(rank[first], u[first])
        context = np.repeat(np.arange(len(pair) - 1), np.diff(pair))
        kept = count >= LEAST[2]
        at = np.flatnonzero(kept)
        r2, k = low[first[at]], len(pair) - 1
        lower = d2[np.minimum(r2, _K + 1)] * r2 / np.maximum(ctotal[place[of_v[first[at]]]], 1)
        sums = _by_count(count[at], context[at], k)
        total = _totals(count, pair)
        mass = np.bincount(context[at], weights=lower, minlength=k)
        nothing = (sums[_K + 1] == total) & (total > 0)
        code = (mass > 0).astype(np.int64)[context]
        code[at] = 2 * count[at] + nothing[context[at]]
        which_one = np.empty(len(u), np.int32)
        which_one[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(cuts))
        answer = code[which_one]
        of_pair = _edges(of_v, u)
        asked = of_pair[:-1][_any(answer == 1, of_pair)]
        asked = asked[row_own[of_row[of_v[asked]]] == 0]
        of_asked = np.searchsorted(asked, edges)
        its_context = context[which_one[asked]]
        above = np.stack([*sums[:_K], sums[_K + 1]], axis=1)[its_context].reshape(-1)
        unseen = _any(low == 0, runs)
        names = ["kind", "grp", "split", "own", "block", "data", "rest", "above", "masses", "extra", "low_backs", "v", "u", "w", "counts", "stats"]
        many, real, raw = pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary()
        whole = lambda kind, k, columns: pa.Table.from_arrays([pa.array(np.full(k, kind, np.int32)), *columns], names)
        k = len(row_group)
        weights = [packed_rows(above, of_asked * (_K + 1)), _raw(mass[its_context], of_asked), packed_rows(cmore[place], per_row), _raw(cback[place[unseen]], np.append(0, np.cumsum(unseen))[per_row])]
        out = whole(_ANSWERS, k, [pa.array(row_group), pa.array(row_split), pa.array(row_own), pa.array(row_block), *plane_rows(answer, edges), *weights, *[pa.nulls(k, many)] * 4, pa.nulls(k, real)])
        yield from out.filter(pa.array(row_own >= 0)).to_batches(ROWS)
        del out, weights, answer, which_one

        row = of_row[of_v[first[at]]]
        rows = _edges(row_group[row], row_split[row], row_own[row])
        k, heads = len(rows) - 1, row[rows[:-1]]
        yield from whole(_TABLE, k, [pa.array(row_group[heads]), pa.array(row_split[heads].astype(np.int32)), pa.array(row_own[heads]), pa.nulls(k, pa.int64()), *[pa.nulls(k, raw)] * 6, *(_lists(x, rows, pa.int64()) for x in (v[of_v[first[at]]], u[first[at]], w[first[at]], count[at])), pa.nulls(k, real)]).to_batches(ROWS)

        # Contexts seen once are left out here, whether they were sent or not; they are counted by the pairs.
        heads = of_v[first[pair[:-1]]]
        own_of = row_own[of_row[heads]]
        often = ((total >= LEAST[2]) | (own_of > 0))[context]
        seen = np.bincount(np.minimum(count[often], _K + 2), minlength=_K + 3)[1 : _K + 2].astype(np.float64)
        one = lambda value, kind: pa.array([value], kind)
        yield from whole(_SEEN, 1, [one(0, pa.int64()), one(0, pa.int32()), *[one(0, pa.int64())] * 2, *[pa.nulls(1, raw)] * 6, *[pa.nulls(1, many)] * 4, one(seen, real)]).to_batches()
        alone = np.flatnonzero(own_of > 0)
        if len(alone):
            heads, k = heads[alone], len(alone)
            row = of_row[heads]
            stats = np.stack([*sums, total, mass], axis=1)[alone].astype(np.float64)
            yield from whole(_STATS, k, [pa.array(row_group[row]), pa.array(row_split[row].astype(np.int32)), pa.array(row_own[row]), pa.array(v[heads]), *[pa.nulls(k, raw)] * 6, *[pa.nulls(k, many)] * 4, _lists(stats.reshape(-1), np.arange(k + 1) * stats.shape[1], pa.float64())]).to_batches(ROWS)

    return both.select(columns).repartition(width, "grp", "split").mapInArrow(lean(run), _THREE)


def _weight(by_count, above, total, mass, d3: np.ndarray):
    """log10 of a context's weight, from the numbers of its kept trigrams by count, the sum of the counts above, its total,
    and what the shorter context gives to the kept ones."""
    nothing = (above == total) & (np.asarray(total) > 0)
    left = np.where(nothing, 1.0, _left([*by_count, 0, above], d3, total))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.asarray(mass) > 0, np.log10(left / (total + nothing)) - np.log10(1 - np.asarray(mass)), 0.0)


def _hot_pairs(tables: list[DataFrame], d3: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
    """For each frequent pair (u, v), at most 1 / HOT_SHARE of them: log10 of its weight, and 1 if it leaves nothing."""
    out: dict[tuple[int, int], tuple[float, int]] = {}
    for t in tables:  # a pair is in one slice
        for row in t.filter(F.col("kind") == _STATS).groupBy(F.col("block").alias("v"), "own").agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(_K + 4))).collect():
            s = [row[f"s{i}"] for i in range(_K + 4)]
            total, mass = s[_K + 2], s[_K + 3]
            out[row.own - 1, row.v] = float(_weight(s[:_K], s[_K + 1], total, mass, d3)), int(0 < total == s[_K + 1])
    return out


def _logs(d: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of discounted counts, each count's taken once where that is less work."""
    each = np.arange(counts.max() + 1) if len(counts) and counts.max() < len(counts) else counts
    out = np.log10(d[np.minimum(each, _K + 1)] * each)
    return out if each is counts else out[counts]


def _evaluated(corpus: DataFrame, answers: DataFrame, facts: _Facts, d2: np.ndarray, d3: np.ndarray, hot: dict) -> DataFrame:
    def run(left, right):
        import pyarrow as pa

        block = _Block(next(_rows(left.combine_chunks().to_batches()[0])), facts)
        one = np.log10(block.count + ADDED) - np.log10(facts.z)
        at = block.later()
        u, v, w, split, own, of, first = block.triples(at)
        total, back = block.count.astype(np.float64), np.zeros(block.base)
        low = block.low[first]
        if len(u):
            keys = ["own", "split", "grp"]
            answer = _in_order(right, keys, "data", "rest")
            runs = _edges(v, split, own)
            words, unseen = v[runs[:-1]], _any(low == 0, runs)
            total[words] = block.count[words] + _in_order(right, keys, "extra")
            back[words[unseen]] = _in_order(right, keys, "low_backs", kind=np.float64)
            r, more = answer >> 1, answer & 1
            contexts = _edges(v, split, own, u)
            asked = np.flatnonzero(_any(answer == 1, contexts) & (own[contexts[:-1]] == 0))
            above = _in_order(right, keys, "above").reshape(-1, _K + 1)
            of_context = np.zeros(len(contexts) - 1)
            of_context[asked] = _weight(above[:, :_K].T, above[:, _K], block.low[first[contexts[asked]] - 1], _in_order(right, keys, "masses", kind=np.float64), d3)
            weight = np.repeat(of_context, np.diff(contexts))
            alone = np.flatnonzero(own > 0)
            for edge in _edges(u[alone], v[alone])[:-1] if len(alone) else ():
                i = alone[edge]
                mine = alone[(u[alone] == u[i]) & (v[alone] == v[i])]
                weight[mine], more[mine] = hot.get((int(block.id[u[i]]), int(block.id[v[i]])), (0.0, 0))
        total[0], back[0] = facts.start
        before, low_of = block.before, block.low
        with np.errstate(divide="ignore"):
            value = np.where(low_of > 0, _logs(d2, low_of) - np.log10(total)[before], back[before] + one[block.word])
            if len(u):
                three, some = weight + value[first], np.flatnonzero(r > 0)
                three[some] = _logs(d3, r[some]) - np.log10(block.low[first[some] - 1] + more[some])
                value[at] = three[of]
        edges = np.append(block.first, len(value))
        ids = left.column("ids").combine_chunks()
        ids = (ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids).flatten()
        known = _totals((block.count > 0)[block.word].astype(np.int64), edges)
        columns = [ids, block.held, block.sizes, known, np.full(len(block.sizes), facts.n), _totals(one[block.word], edges), _totals(value, edges)]
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    answers = answers.select("block", "grp", "split", "own", "data", "rest", "above", "masses", "extra", "low_backs")
    return corpus.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lean_pair(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, held_out, slices: int = SLICES, hot_share: float = HOT_SHARE) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out``: a Column; texts where it is true aren't learnt from."""
    spark = docs.sparkSession
    importable(spark)
    width = shuffle_width(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = stored(_blocks(rows), "katz-blocks", batch=BATCH)
    # Stored by themselves, so that the shuffle that makes them is gone when the blocks are shuffled.
    numbers = stored(_number_words(_send_words(blocks), width), "katz-numbers", by="kind", batch=BATCH)
    n, v, texts, end = map(int, _sums(numbers, 4))
    facts = _Facts(n, v, texts, end, max(float(LEAST[2]), n * hot_share))
    corpus = stored(_numbered(blocks, numbers.filter(F.col("kind") == _ANSWERS), facts), "katz-corpus", batch=BATCH)
    discard(blocks)
    discard(numbers, part=f"kind={_ANSWERS}")

    two = stored(_count_pairs(_send_pairs(corpus, facts), width, end), "katz-bigrams", by="kind", batch=BATCH)
    bigrams = two.filter(F.col("kind") == _TABLE)
    *seen, once = _sums(two, _K + 2)
    d2 = discounts(np.array(seen))
    after = stored(contexts(bigrams, d2, facts.z, facts.hot), "katz-contexts", batch=BATCH)
    facts.start = next(((int(unpack_numbers(np.frombuffer(r.total, np.uint8))[0]), float(np.frombuffer(r.log_backoff)[0])) for r in after.filter(F.col("grp") == -(1 << 62)).limit(1).collect()), (0, 0.0))
    known = stored(_answered(corpus, two.filter(F.col("kind") == _ANSWERS), facts), "katz-known", batch=BATCH)
    discard(corpus)
    discard(two, part=f"kind={_ANSWERS}")

    three = [stored(_count_triples(_send_triples(known, facts, i, slices), after, width, facts, i, slices, d2), "katz-trigrams", by="kind", batch=BATCH) for i in range(slices)]
    rows = functools.reduce(DataFrame.unionByName, three)
    # A pair seen once, and not at the end of a text, is the context of one trigram seen once.
    d3 = discounts(_sums(rows, _K + 1) + np.array([once] + [0] * _K))
    hot, answers = _hot_pairs(three, d3), rows.filter(F.col("kind") == _ANSWERS)
    mine = F.pmod(F.xxhash64("block"), F.lit(slices))
    parts = [stored(_evaluated(known.filter(mine == i), answers.filter(mine == i), facts, d2, d3, hot), "katz-scores", batch=BATCH) for i in range(slices)]
    out = functools.reduce(DataFrame.unionByName, parts)
    discard(known)
    for t in three:
        discard(t, part=f"kind={_ANSWERS}")
    return out
