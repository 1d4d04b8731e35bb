"""Secret scanning over a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived: what every match must contain, lower-cased. The index has
a posting (trigram, document) for each trigram of a vocabulary and each document that contains it, found in one pass over
the text. The vocabulary is that of the rules, or a larger one that later rules can use without another pass. Intersecting
postings gives a rule's candidates, and its regex is then run on those alone. A rule without mandatory trigrams scans
everything.

Nulls and ties: a null text is empty and has no spans. A null doc_id is carried through. Rows that repeat get a result
each. Matches of one rule don't overlap; matches of different rules may. Columns besides doc_id and text are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, stored

#: Alternatives that are followed through a regex before they are turned into trigrams.
MOST_STRINGS = 24


@dataclass(frozen=True)
class Rule:
    """``regex`` in the syntax that Python and Java share; a match counts if its group has at least ``least`` characters."""

    name: str
    regex: str
    group: int = 0
    least: int = 0


#: The rules that the contract of op7 fixes, in its order. A run of hexadecimal digits is taken whole by a greedy match, so
#: asking for 24 in the regex itself finds the same matches as dropping shorter ones, without listing every short run.
BASE_RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
]
#: Further rules: token formats with a fixed beginning, and the head of a private key.
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
]

# A query is True (any document), or ("and" | "or", frozenset of trigrams and queries).


def _all(parts) -> object:
    parts = [p for p in parts if p is not True]
    return ("and", frozenset(parts)) if parts else True


def _any(parts) -> object:
    parts = list(parts)
    return True if not parts or True in parts else ("or", frozenset(parts)) if len(set(parts)) > 1 else parts[0]


def _of_string(text: str) -> object:
    return _all(text[i : i + 3] for i in range(len(text) - 2))


class _Regex:
    """A regex as a tree, of the syntax that the rules use: ("char", set of lower-cased characters, or None for many),
    ("all", parts), ("any", branches), ("repeat", least, most or None, part), ("at",), or ("unknown",) for anything else."""

    _ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "v": "\v", "a": "\a"}

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _next(self) -> str:
        return self.text[self.at : self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def parse(self):
        tree = self._branches()
        return tree if self.at == len(self.text) else ("unknown",)

    def _branches(self):
        branches = [self._sequence()]
        while self._next() == "|":
            self._take()
            branches.append(self._sequence())
        return branches[0] if len(branches) == 1 else ("any", branches)

    def _sequence(self):
        parts = []
        while self._next() not in ("", "|", ")"):
            parts.append(self._repeated(self._atom()))
        return "all", parts

    def _repeated(self, part):
        while True:
            c = self._next()
            if c and c in "*+?":
                self._take()
                part = ("repeat", int(c == "+"), 1 if c == "?" else None, part)
            elif c == "{" and (m := re.compile(r"\{(\d*)(,?)(\d*)\}").match(self.text, self.at)) and (m[1] or m[3]):
                self.at = m.end()
                least = int(m[1] or 0)
                part = ("repeat", least, int(m[3]) if m[3] else None if m[2] else least, part)
            else:
                return part
            if self._next() and self._next() in "?+":  # lazy and possessive ones match no other strings
                self._take()

    def _atom(self):
        c = self._take()
        if c == "(":
            known = True
            if self._next() == "?":
                m = re.compile(r"\?(?::|P?<[A-Za-z]\w*>|[aims]+\))").match(self.text, self.at)
                known = m is not None
                self.at = m.end() if m else self.at + 1
                if m and m[0].endswith(")"):
                    return ("at",)
            inside = self._branches()
            self.at += 1
            return inside if known else ("repeat", 0, None, ("unknown",))
        if c == "[":
            return "char", self._class()
        if c == ".":
            return "char", None
        if c in "^$":
            return ("at",)
        if c == "\\":
            e = self._next()
            if e and e in "bBAZz":
                self._take()
                return ("at",)
            found = self._escaped()
            return ("unknown",) if found == "back" else ("char", found)
        return "char", {c.lower()} if c.isascii() else None

    def _escaped(self):
        e = self._take()
        if e == "x":
            self.at += 2
            return {chr(int(self.text[self.at - 2 : self.at], 16)).lower()}
        if e in self._ESCAPES:
            return {self._ESCAPES[e]}
        if e == "d":
            return set("0123456789")
        if e.isdigit():
            return "back"
        return None if e.isalpha() else {e}

    def _class(self) -> set[str] | None:
        many, out, first = self._next() == "^", set(), True
        if many:
            self._take()
        while self.at < len(self.text) and (first or self._next() != "]"):
            first = False
            c = self._take()
            if c == "[" and self._next() == ":":
                many = True
            found = self._escaped() if c == "\\" else {c}
            if found is None or found == "back":
                many = True
            elif self._next() == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", "") and len(found) == 1:
                self._take()
                end = self._take()
                end = self._escaped() if end == "\\" else {end}
                low, high = ord(min(found)), ord(min(end)) if end and end != "back" else 1 << 20
                found = {chr(x) for x in range(low, high + 1)} if high - low < MOST_STRINGS else None
            if found is None:
                many = True
            elif found != "back":
                out |= {x.lower() for x in found}
        self.at += 1
        return None if many or len(out) > MOST_STRINGS or not all(x.isascii() for x in out) else out


def _strings(tree) -> tuple[set[str] | None, object]:
    """All strings that a part of a regex can match (lower-cased; None: too many), and a query that its matches satisfy."""
    kind = tree[0]
    if kind == "char":
        return tree[1], True
    if kind == "at":
        return {""}, True
    if kind == "any":
        each = [_strings(b) for b in tree[1]]
        exact = set().union(*(e for e, _ in each)) if all(e is not None for e, _ in each) else None
        return (exact if exact is not None and len(exact) <= MOST_STRINGS else None), _any(q if q is not True or e is None else _any(_of_string(s) for s in e) for e, q in each)
    if kind == "repeat":
        _, low, high, body = tree
        inner, query = _strings(body)
        exact = {"".join(s) for n in range(low, high + 1) for s in product(inner, repeat=n)} if inner is not None and high is not None and high <= 2 and len(inner) ** high <= MOST_STRINGS else None
        if low and query is True and inner is not None:
            query = _any(_of_string(s) for s in inner)
        return exact, (query if low else True)
    if kind != "all":
        return None, True
    exact, whole, queries = {""}, True, []
    for part in tree[1]:
        strings, query = _strings(part)
        queries.append(query)
        grown = {a + b for a in exact for b in strings} if strings is not None else None
        if grown is not None and len(grown) <= MOST_STRINGS:
            exact = grown
        else:
            queries.append(_any(_of_string(s) for s in exact))
            exact, whole = strings if strings is not None else {""}, False
    queries.append(_any(_of_string(s) for s in exact))
    return (exact if whole else None), _all(queries)


def trigram_query(regex: str) -> object:
    """What every match of ``regex`` contains, as a Boolean query over lower-case trigrams; True if nothing is known."""
    return _strings(_Regex(regex).parse())[1]


def _trigrams(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1]))


def _satisfied(query, found: Column) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(found, query)
    parts = [_satisfied(q, found) for q in sorted(query[1], key=str)]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"), F.coalesce("text", F.lit("")).alias("text"))


def _alternatives(grams: Sequence[str]) -> str:
    """A pattern that finds any of the trigrams at a place, by its first character, then the second, then the third."""
    tree: dict[str, dict[str, set[str]]] = {}
    for a, b, c in grams:
        tree.setdefault(a, {}).setdefault(b, set()).add(c)
    quoted = lambda c: c if c.isalnum() else f"\\x{ord(c):02x}"
    return "|".join(quoted(a) + "(?:" + "|".join(f"{quoted(b)}[{''.join(map(quoted, sorted(last)))}]" for b, last in sorted(rest.items())) + ")" for a, rest in sorted(tree.items()))


def build_index(docs: DataFrame, rules: Sequence[Rule], vocabulary: Sequence[str] = ()) -> DataFrame:
    """Postings (trigram, doc_id, row_hash) of the trigrams that the rules' queries name, and of a vocabulary of others."""
    grams = sorted(set(vocabulary).union(*(_trigrams(trigram_query(r.regex)) for r in rules)))
    rows = _keyed(docs).withColumn("low", F.lower("text"))
    found = F.array_distinct(F.regexp_extract_all("low", F.lit(f"(?s)(?=({_alternatives(grams)}))"), F.lit(1))) if grams else F.array().cast("array<string>")
    return rows.select(F.explode(found).alias("trigram"), "doc_id", "row_hash")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows (doc_id, row_hash, rules): the rules whose query a document's postings satisfy. A document has at most as many
    postings as the rules have trigrams."""
    found = index.groupBy("doc_id", "row_hash").agg(F.collect_set("trigram").alias("found"))
    named = F.array_compact(F.array(*[F.when(_satisfied(trigram_query(r.regex), F.col("found")), F.lit(r.name)) for r in rules]))
    return found.select("doc_id", "row_hash", named.alias("rules")).filter(F.size("rules") > 0)


def _pieces(rows: DataFrame, rule: Rule, number: int) -> DataFrame:
    """A row for each match of ``rule``, whether it counts or not: its number, its length and that of the text before it."""
    matches = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0))
    groups = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(rule.group)) if rule.group else matches
    between = F.split("text", rule.regex, -1)
    rows = rows.select("doc_id", "row_hash", matches.alias("m"), groups.alias("g"), between.alias("b"))
    sizes = F.arrays_zip(F.transform("m", F.char_length).alias("m"), F.transform("g", F.char_length).alias("g"), F.transform(F.slice("b", 1, F.size("m")), F.char_length).alias("b"))
    rows = rows.select("doc_id", "row_hash", F.posexplode(sizes).alias("i", "s"))
    return rows.select("doc_id", "row_hash", F.lit(number).alias("rule"), "i", F.col("s.m").alias("length"), F.col("s.b").alias("before"), (F.col("s.g") >= rule.least).alias("counts"))


def find_spans(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows (doc_id, row_hash, rule, begin, end) of the matches that count; rule is its place in ``rules``, and begin and
    end are code points. Rows that repeat a doc_id and its text have their spans once."""
    from pyspark.sql import Window

    indexed = [r for r in rules if trigram_query(r.regex) is not True]
    parts = [_pieces(_keyed(docs), r, i) for i, r in enumerate(rules) if r not in indexed]
    if indexed:
        index = stored(build_index(docs, indexed), "trigram-postings")
        found = stored(candidates(index, indexed).select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_row"), "rules"), "secret-candidates")
        texts = join_small(_keyed(docs), found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_row")), "inner")
        texts = stored(texts.select("doc_id", "row_hash", "text", "rules"), "secret-texts")
        parts += [_pieces(texts.filter(F.array_contains("rules", r.name)), r, i) for i, r in enumerate(rules) if r in indexed]
    matches = parts[0]
    for p in parts[1:]:
        matches = matches.unionByName(p)
    matches = matches.groupBy("doc_id", "row_hash", "rule", "i").agg(*(F.first(c).alias(c) for c in ("length", "before", "counts")))
    order = Window.partitionBy("doc_id", "row_hash", "rule").orderBy("i")
    end = F.sum(F.col("before") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = matches.withColumn("end", end.cast("int")).withColumn("begin", (F.col("end") - F.col("length")).cast("int"))
    return spans.filter("counts").select("doc_id", "row_hash", "rule", "begin", "end")


def scan(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A row for each row of ``docs``: doc_id and spans, array<struct<begin, rule, end>>, by begin and then rule."""
    spans = find_spans(docs, rules).groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_list(F.struct("begin", "rule", "end"))).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_row"), "spans")
    out = _keyed(docs).select("doc_id", "row_hash").join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_row")), "left")
    return out.select("doc_id", F.coalesce("spans", F.array().cast("array<struct<begin:int,rule:int,end:int>>")).alias("spans"))
