"""Byte-level BPE as a bounded-lookahead streaming transducer, and decoding as an incremental byte-to-text machine.

Merging works from the strongest rule to the weakest, so what follows a text can change its tokens only near its end. How
near follows from the merge list alone (``Merges.lookahead``). A text is read in segments of a bounded number of characters,
cut where a single space stands between two other characters, since no piece of the split goes across that. The pieces of a
segment are merged together, column by column in numpy, and their tokens are emitted: nothing that follows can change them.
A run without such a place is merged in windows: tokens that end at least the lookahead before a window's end are stable
and are emitted; the next window begins behind the last of them. What a worker holds besides a text and its ids is one
segment, one window and a memory of known pieces of bounded size, however long the text or the run is.

Nulls and ties: a null text is an empty one and has no tokens; rows that repeat get a result each; a null doc_id and all
other columns are carried through by ``encode``. A column named ids or decoded is replaced. An empty table stays empty.
"""

from __future__ import annotations

import codecs
import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, lean

#: How the public vocabulary files split a text before merging (a fixed value of their format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks of text whose tokens a worker remembers, and how many bytes a piece of them may have; the memory is emptied when
#: full and at the end of a task, so that an idle worker holds little.
REMEMBERED, LONGEST_REMEMBERED = 120_000, 48
#: Characters of a segment, and of the segments that are merged together.
SEGMENT, STEP = 1 << 16, 1 << 20


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def vocabulary(spec: dict) -> list[bytes]:
    """The bytes of each id of a tokenizer file."""
    of, special = byte_characters(), {x["content"]: x["id"] for x in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    bytes_of = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in vocab.items():
        bytes_of[i] = bytes(of[c] for c in token)
    for token, i in special.items():
        bytes_of[i] = token.encode()
    return bytes_of


_NONE = 1 << 60


class Merges:
    """A merge list with its vocabulary, read from a tokenizer file in JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of, vocab = byte_characters(), spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = vocabulary(spec)
        self.first = [0] * 256
        for character, b in of.items():
            self.first[b] = vocab[character]
        self.rules: dict[int, int] = {}  # a pair's rank, and in the lower 20 bits what it makes
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.rules.setdefault(a << 20 | b, rank << 20 | made)
            self.parts.setdefault(made, (a, b))
        self.keys = np.array(sorted(self.rules), dtype=np.int64)
        self.values = np.array([self.rules[k] for k in self.keys.tolist()], dtype=np.int64)
        self.longest = max(map(len, self.bytes_of))
        self.lookahead = self._lookahead()
        self.window = self.lookahead + 2 * self.longest

    def _lookahead(self) -> int:
        """Bytes before the end of a text whose tokens what follows can still change.

        What is tokenised alike with and without the rest reaches up to a frontier, at first the text's end. Only a rule
        whose left part ends at the frontier can move it, by that part's length, and the next such rule is weaker and its
        right part begins with the left part of the one before. The longest such chain bounds the frontier's way.
        """
        ended: dict[int, int] = {}  # by left part: the longest chain that ends with a rule of that left part
        most = 0
        for key in self.rules:  # in order of rank
            left, right = key >> 20, key & 0xFFFFF
            spine, before = right, ended.get(right, 0)
            while spine in self.parts:
                spine = self.parts[spine][0]
                before = max(before, ended.get(spine, 0))
            chain_length = len(self.bytes_of[left]) + before
            ended[left] = max(ended.get(left, 0), chain_length)
            most = max(most, chain_length)
        return most

    def _merge(self, ids: list[int]) -> list[int]:
        rules = self.rules.get
        none = 1 << 60
        found = [rules(a << 20 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            made = best & 0xFFFFF
            ids[i : i + 2] = [made]
            del found[i]
            if i:
                found[i - 1] = rules(ids[i - 1] << 20 | made, none)
            if i < len(found):
                found[i] = rules(made << 20 | ids[i + 1], none)
        return ids

    def stream(self, data: bytes):
        """Tokens of a run of bytes, emitted once stable."""
        first, at, sizes = self.first, 0, self.bytes_of
        while len(data) - at > self.window:
            stable = self.window - self.lookahead
            done = 0
            for token in self._merge([first[b] for b in data[at : at + self.window]]):
                if done + len(sizes[token]) > stable:
                    break
                done += len(sizes[token])
                yield token
            at += done
        yield from self._merge([first[b] for b in data[at:]])

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rules of pairs, as in ``rules``; _NONE where there is none."""
        if not len(self.keys):
            return np.full(left.shape, _NONE)
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many pieces, and how many each has. Pieces of one length are rows of a matrix: in each round every row
        applies its strongest rule where it first fits, and so gets shorter by one."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.array(self.first, dtype=np.int64)
        out, counts = np.zeros(int(sizes.sum()), np.int32), sizes.copy()
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(pieces), np.uint8)
        for size in np.unique(sizes).tolist():
            row = np.flatnonzero(sizes == size)
            if size > LONGEST_REMEMBERED:
                for i in row.tolist():
                    tokens = np.fromiter(self.stream(pieces[i]), np.int32)
                    out[begins[i] : begins[i] + len(tokens)], counts[i] = tokens, len(tokens)
                continue
            ids = first[data[begins[row][:, None] + np.arange(size)]]
            rules = self._found(ids[:, :-1], ids[:, 1:])
            while size and len(row):
                best = rules.min(axis=1) if size > 1 else np.full(len(row), _NONE)
                done = best == _NONE
                if done.any():
                    mine = row[done]
                    out[begins[mine][:, None] + np.arange(size)] = ids[done]
                    counts[mine] = size
                    row, ids, rules, best = row[~done], ids[~done], rules[~done], best[~done]
                    if not len(row):
                        break
                nth = np.arange(len(row))
                at = (rules == best[:, None]).argmax(axis=1)
                made = best & 0xFFFFF
                ids[nth, at] = made
                left = np.ones(ids.shape, bool)
                left[nth, at + 1] = False
                ids = ids[left].reshape(len(row), size - 1)
                left = np.ones(rules.shape, bool)
                left[nth, at] = False
                rules = rules[left].reshape(len(row), size - 2)
                size -= 1
                some = np.flatnonzero(at > 0)
                rules[some, at[some] - 1] = self._found(ids[some, at[some] - 1], made[some])
                some = np.flatnonzero(at < size - 1)
                rules[some, at[some]] = self._found(made[some], ids[some, at[some] + 1])
        return out[np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())], counts


class _Codes(dict):
    """The number of each chunk; a new one gets the next."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, key):
        code = self[key] = self.add(key)
        return code


class Encoder:
    """Texts to ids. A space before a chunk belongs to it, so where no other white space is beside a single space, the
    chunks between spaces can be encoded one by one."""

    def __init__(self, path: str):
        import regex

        self.merges = Merges(path)
        self.split = regex.compile(SPLIT)
        self.odd = regex.compile(r" \s|\s \Z")
        self.cut = regex.compile(r"(?<=\S) (?=\S)")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")") if self.merges.special else None
        self.clear()

    def clear(self) -> None:
        self.spaced, self.exact = _Codes(self._chunk), _Codes(lambda piece: self._add([piece]))
        self.tokens, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.new: list[list[str]] = []
        self.known = 0

    def _add(self, pieces: list[str]) -> int:
        self.new.append(pieces)
        return self.known + len(self.new) - 1

    def _chunk(self, chunk: str) -> int:
        """A chunk that a space precedes. Letters alone are one piece, and so is a comma or full stop after them."""
        if chunk.isalpha():
            return self._add([f" {chunk}"])
        if chunk[:-1].isalpha() and chunk[-1] in ",.":
            return self._add([f" {chunk[:-1]}", chunk[-1]])
        return self._add(self.split.findall(f" {chunk}"))

    def _segments(self, text: str):
        """(whether it is a special token, part) of a text, the parts of bounded length where the text can be cut."""
        parts = self.specials.split(text) if self.specials and self.specials.search(text) else [text]
        for i, part in enumerate(parts):
            at = 0
            while i % 2 == 0 and len(part) - at > SEGMENT:
                m = self.cut.search(part, at + SEGMENT)
                if m is None:
                    break
                yield False, part[at : m.start()]
                at = m.start()
            if len(part) > at:
                yield i % 2 == 1, part[at:] if at else part

    def _codes(self, segment: str, codes: list[int]) -> None:
        if self.odd.search(segment):
            codes.extend(map(self.exact.__getitem__, self.split.findall(segment)))
            return
        first, *chunks = segment.split(" ")
        if first:
            codes.extend(map(self.exact.__getitem__, self.split.findall(first)))
        codes.extend(map(self.spaced.__getitem__, chunks))

    def _emitted(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of chunks; new ones are merged first."""
        if self.new:
            tokens, counts = self.merges.merged([p.encode() for pieces in self.new for p in pieces])
            of = np.repeat(np.arange(len(self.new)), [len(pieces) for pieces in self.new])
            sizes = np.bincount(of, weights=counts, minlength=len(self.new)).astype(np.int64)
            self.tokens = np.concatenate([self.tokens, tokens])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
            self.known += len(self.new)
            self.new = []
        code = np.array(codes, dtype=np.int64)
        begins, sizes = self.begins[code], self.begins[code + 1] - self.begins[code]
        out = self.tokens[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        if self.known > REMEMBERED or len(self.tokens) > 8 * REMEMBERED:
            self.clear()
        return out, sizes

    def encode_batch(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        out, total = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        codes, of, length = [], [], 0

        def emit():
            ids, sizes = self._emitted(codes)
            out.append(ids)
            ends = np.append(0, np.cumsum(sizes))[np.array([n for _, n in of])]
            np.add.at(total, [i for i, _ in of], np.diff(ends, prepend=0))
            codes.clear()
            of.clear()

        for i, text in enumerate(texts):
            for special, segment in self._segments(text) if text else ():
                if special:
                    if codes:
                        emit()
                    out.append(np.array([self.merges.special[segment]], np.int32))
                    total[i] += 1
                    length = 0
                    continue
                self._codes(segment, codes)
                of.append((i, len(codes)))
                length += len(segment)
                if length >= STEP:
                    emit()
                    length = 0
        if codes:
            emit()
        return np.concatenate(out), total

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]


_encoders: dict[str, Encoder] = {}
_vocabularies: dict[str, list[bytes]] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _bytes_of(path: str) -> list[bytes]:
    """The vocabulary of a tokenizer file; an encoder's own where this worker has one."""
    if path in _encoders:
        return _encoders[path].merges.bytes_of
    if path not in _vocabularies:
        with open(path, encoding="utf-8") as file:
            _vocabularies[path] = vocabulary(json.load(file))
    return _vocabularies[path]


class TextMachine:
    """Ids to text, a token at a time: bytes that do not yet make a character are kept until they do."""

    def __init__(self, bytes_of: list[bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        return self.machine.decode(b"".join([self.bytes_of[i] for i in ids]), last)


def decode_ids(ids: np.ndarray, bytes_of: list[bytes], step: int = 65536) -> str:
    machine = TextMachine(bytes_of)
    parts = [machine.feed(ids[i : i + step].tolist()) for i in range(0, len(ids), step)]
    return "".join(parts) + machine.feed([], True)


def _encoding(path: str, at: int):
    """A function over Arrow batches that adds ids, of the texts in column ``at``."""

    def run(batches):
        import pyarrow as pa

        of = encoder(path)
        for batch in batches:
            values, sizes = of.encode_batch(batch.column(at).to_pylist())
            made = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "ids"])
            del values, made
        of.clear()

    return run


def _decoding(path: str, at: int):
    """A function over Arrow batches that adds decoded, of the ids in column ``at``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            of, column = _bytes_of(path), batch.column(at)
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            null = column.is_null().to_pylist()
            out = [None if null[i] else decode_ids(values[offsets[i] : offsets[i + 1]], of) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "decoded"])

    return run


_IDS, _DECODED = T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ids array<int>; ``path``: a tokenizer file that every executor can read."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("ids")
    return docs.mapInArrow(lean(_encoding(path, docs.columns.index(text))), T.StructType([*docs.schema.fields, _IDS]))


def decode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` and decoded, the text of its ids; null where ids is null."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("decoded")
    return docs.mapInArrow(lean(_decoding(path, docs.columns.index("ids"))), T.StructType([*docs.schema.fields, _DECODED]))


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """What ``decode`` gives of what ``encode`` gives, but by one Python worker for each task instead of two, which count
    towards an executor's memory even while idle."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    encoding, decoding = _encoding(path, docs.columns.index(text)), _decoding(path, len(docs.columns))
    return docs.mapInArrow(lean(lambda batches: decoding(encoding(batches))), T.StructType([*docs.schema.fields, _IDS, _DECODED]))


def ids_text(ids):
    """Decimal ids joined by commas."""
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")
