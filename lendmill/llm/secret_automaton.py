"""Secret scan by one combined deterministic automaton.

Each rule is a head and a tail pattern. All rules, reversed, go through subset construction and
minimisation into one transition array. One pass over a text's bytes from its end to its start
then says for every position which rules match from there; the end of a match that is taken comes
from the rule's own small automaton, run forward from that position only. Per rule the matches
are leftmost, longest and do not overlap; a match whose tail is too short is dropped but still
covers its characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lendmill.llm import runtime


@dataclass(frozen=True)
class Rule:
    """`head` then `tail`, patterns over ASCII bytes; a match counts if the tail has `least` bytes.

    `mark` is put in place of the match by `redact`. Supported syntax: literals, `\\xHH` and other
    escapes, classes, groups, `|`, `?`, `*`, `+`, `{m}`, `{m,}` and `{m,n}`. `any_case` lets the
    head's letters match in either case.
    """

    kind: str
    head: str
    tail: str
    least: int = 1
    any_case: bool = False


# The kinds that every scan reports, in their order.
BASE_RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 8, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 12),
    Rule("hex", r"", r"[0-9a-f]{32,}", 32),
)
# Public token formats found besides.
MORE_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("jwt", r"eyJ", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20),
    Rule("pem", r"-----BEGIN\x20", r"([A-Z]+\x20)*PRIVATE\x20KEY-----", 1),
)
RULES = BASE_RULES + MORE_RULES


# ---- patterns to small trees: ("set", bytes) ("cat", [..]) ("or", [..]) ("rep", node, least, most or None)

class _Parser:
    def __init__(self, pattern: str, any_case: bool):
        self.p, self.i, self.any_case = pattern, 0, any_case

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def either(self):
        ways = [self.sequence()]
        while self.peek() == "|":
            self.take()
            ways.append(self.sequence())
        return ways[0] if len(ways) == 1 else ("or", ways)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            node = self.atom()
            while self.peek() and self.peek() in "?*+{":
                node = ("rep", node, *self.bounds())
            parts.append(node)
        return ("cat", parts)

    def bounds(self) -> tuple[int, int | None]:
        c = self.take()
        if c != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        end = self.p.index("}", self.i)
        low, comma, high = self.p[self.i : end].partition(",")
        self.i = end + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def byte(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def cased(self, found: set[int]):
        if self.any_case:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
        return ("set", frozenset(found))

    def atom(self):
        if self.peek() == "(":
            self.take()
            node = self.either()
            self.take()
            return node
        if self.peek() != "[":
            return self.cased({self.byte()})
        self.take()
        found: set[int] = set()
        while self.peek() != "]":
            low = self.byte()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                found |= set(range(low, self.byte() + 1))
            else:
                found.add(low)
        self.take()
        return self.cased(found)


def parse(pattern: str, any_case: bool = False):
    return _Parser(pattern, any_case).either()


class _Nfa:
    """States with byte edges and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, node, start: int, reverse: bool) -> int:
        """Put the node after `start`; its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in reversed(node[1]) if reverse else node[1]:
                start = self.add(part, start, reverse)
            return start
        if kind == "or":
            end = self.state()
            for way in node[1]:
                into = self.state()
                self.empty[start].append(into)
                self.empty[self.add(way, into, reverse)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start, reverse)
        end = self.state()
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop, reverse)].append(loop)
            self.empty[loop].append(end)
            return end
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start, reverse)
            self.empty[start].append(end)
        return end

    def closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """`table[state * 256 + byte]` is the next state times 256; `hits[state]` the rules accepted there.

    States are ordered so that those from `first_hit` on accept something.
    """

    table: list[int]
    hits: list[tuple[int, ...]]
    start: int
    first_hit: int
    dead: int  # state * 256 from which nothing is accepted, or -1


def compile_rules(nodes: list, reverse: bool, anywhere: bool) -> Automaton:
    """Subset construction over byte classes, then minimisation by partition refinement."""
    nfa = _Nfa()
    root, ends = nfa.state(), {}
    for k, node in enumerate(nodes):
        into = nfa.state()
        nfa.empty[root].append(into)
        ends[nfa.add(node, into, reverse)] = k
    sets = {s for edges in nfa.edges for s, _ in edges}
    signature = [tuple(b in s for s in sets) for b in range(256)]
    classes = {c: i for i, c in enumerate(dict.fromkeys(signature))}
    byte_class = [classes[c] for c in signature]
    sample = [byte_class.index(i) for i in range(len(classes))]

    begin = nfa.closed([root])
    number, rows, todo = {begin: 0}, [], [begin]
    while todo:
        now = todo.pop(0)
        row = []
        for b in sample:
            goal = {t for s in now for chars, t in nfa.edges[s] if b in chars}
            goal = nfa.closed(goal | ({root} if anywhere else set()))
            if goal not in number:
                number[goal] = len(number)
                todo.append(goal)
            row.append(number[goal])
        rows.append(row)
    hit = [tuple(sorted({ends[s] for s in subset if s in ends})) for subset in number]
    moves = np.array(rows)

    group = np.unique(np.array([hash(h) for h in hit]), return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    count = int(group.max()) + 1
    member = [int(np.flatnonzero(group == g)[0]) for g in range(count)]
    order = sorted(range(count), key=lambda g: (bool(hit[member[g]]), g))
    place = {g: i for i, g in enumerate(order)}
    table, hits, dead = [], [], -1
    for i, g in enumerate(order):
        row = [place[int(group[t])] for t in moves[member[g]]]
        if not hit[member[g]] and all(t == i for t in row):
            dead = i * 256
        table += [row[c] * 256 for c in byte_class]
        hits.append(hit[member[g]])
    first = next((i for i, h in enumerate(hits) if h), len(hits))
    return Automaton(table, hits, place[int(group[0])], first, dead)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    starts: Automaton
    whole: tuple[Automaton, ...]
    heads: tuple[Automaton, ...]

    def _end(self, automaton: Automaton, data: bytes, at: int) -> int:
        """The longest match from `at`, or `at` itself."""
        table, state, first, dead, end = automaton.table, automaton.start * 256, automaton.first_hit * 256, automaton.dead, at
        for i in range(at, len(data)):
            state = table[state + data[i]]
            if state >= first:
                end = i + 1
            elif state == dead:
                break
        return end

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(byte start, byte end, rule number) of the matches that count, by start, then rule."""
        table, state, first, hits = self.starts.table, self.starts.start * 256, self.starts.first_hit * 256, self.starts.hits
        at: list[tuple[int, int]] = []
        i = len(data)
        for b in reversed(data):
            i -= 1
            state = table[state + b]
            if state >= first:
                at.append((i, state >> 8))
        covered = [0] * len(self.rules)
        out = []
        for i, s in reversed(at):
            for k in hits[s]:
                if i >= covered[k]:
                    end = covered[k] = self._end(self.whole[k], data, i)
                    if end - self._end(self.heads[k], data, i) >= self.rules[k].least:
                        out.append((i, end, k))
        return out


@lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    heads = [parse(r.head, r.any_case) for r in rules]
    nodes = [("cat", [h, parse(r.tail)]) for h, r in zip(heads, rules)]
    return Scanner(rules, compile_rules(nodes, True, True), tuple(compile_rules([n], False, False) for n in nodes), tuple(compile_rules([h], False, False) for h in heads))


def text_spans(scan: Scanner, data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    found = scan.spans(data)
    if not found:
        return []
    if data.isascii():
        return [(scan.rules[k].kind, a, b) for a, b, k in found]
    places = sorted({p for a, b, _ in found for p in (a, b)})
    point, last, code = {}, 0, 0
    for p in places:
        code += len(data[last:p].decode("utf-8", "replace"))
        point[p], last = code, p
    return [(scan.rules[k].kind, point[a], point[b]) for a, b, k in found]


def listing(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, span list of kind, start, end) for every row; a null or empty text has an empty list."""
    runtime.prepare(docs.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            spans = [text_spans(scan, t.encode()) if t else [] for t in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], SPANS)], ["id", "spans"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text")).mapInArrow(
        found, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _texts(column: pa.Array) -> Iterator[str | None]:
    for value in column:
        yield value.as_py()


def scan_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, and all spans.

    Rows are independent: repeated ids or rows give one result row each; a null text counts as
    empty, a null id stays null; other columns are ignored.
    """
    runtime.prepare(docs.sparkSession)
    kinds = [r.kind for r in base]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            counts: list[list[int]] = [[] for _ in kinds]
            digests, spans = [], []
            for text in _texts(batch.column(1)):
                found = text_spans(scan, text.encode()) if text else []
                kept = [s for s in found if s[0] in kinds]
                for c, kind in zip(counts, kinds):
                    c.append(sum(s[0] == kind for s in kept))
                digests.append(hashlib.sha256(listing(kept).encode()).hexdigest())
                spans.append(listing(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        digested, f"doc_id {id_type}, {', '.join(f'n_{k} bigint' for k in kinds)}, base_sha256 string, spans string"
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with every found secret replaced by `[kind]` (n_chars follows the text).

    Overlapping spans are replaced together under the kind that starts first. A null text stays null.
    """
    runtime.prepare(docs.sparkSession)
    schema = docs.schema
    text_at = schema.fieldNames().index("text")
    length_at = schema.fieldNames().index("n_chars") if "n_chars" in schema.fieldNames() else None

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            columns = list(batch.columns)
            texts = []
            for text in _texts(columns[text_at]):
                spans = text_spans(scan, text.encode()) if text else []
                if spans:
                    parts, last = [], 0
                    for kind, a, b in spans:
                        if a >= last:
                            parts += [text[last:a], f"[{kind}]"]
                        last = max(last, b)
                    text = "".join([*parts, text[last:]])
                texts.append(text)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if length_at is not None:
                kept = columns[length_at]
                columns[length_at] = pa.array([n if t is None else len(t) for n, t in zip(kept.to_pylist(), texts)], kept.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(cleaned, schema)

