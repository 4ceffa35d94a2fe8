"""Secret scan by one combined, minimised deterministic automaton.

The rules' regular expressions become one Thompson automaton, subset construction makes it deterministic, and
partition refinement minimises it.  The scan runs it backwards: the automaton of the reversed expressions goes over
the texts' UTF-8 bytes once, from the last to the first, and its accept bits at a byte name the rules of which a
match starts there.  Bytes that lead from every state to the start state cut the texts into stretches that no match
can cross; the pass runs over many stretches at once.  From the starts, leftmost first and past the end of the match
before, a second transition array (the same rules, anchored) gives the longest match and its tail's length.

Edge cases: null and empty texts have no spans; an empty table gives an empty result; repeated rows each give
a row; other columns are ignored, whatever their names; there is no limit on text or match length.
"""

from __future__ import annotations

import hashlib
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bound_batches, lean, pieces, utf8_buffers


@dataclass(frozen=True)
class Rule:
    """``head`` and then one or more ``tail`` bytes; a match counts if it has at least ``least`` tail bytes."""

    kind: str
    head: str
    tail: str
    least: int

    @property
    def regex(self) -> str:
        """The whole match.  A rule without a head counts its tail here, since a shorter run can't hide a longer one."""
        return f"(?:{self.head}){self.tail}+" if self.head else f"{self.tail}{{{self.least}}}{self.tail}*"


_KEYWORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The three base rules.
BASE = (
    Rule("assign", f"(?:{_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
#: Well-known public token shapes.
EXTRA = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ", "[A-Za-z0-9_.-]", 20),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY", "-", 5),
)


class _Nfa:
    """A Thompson automaton for literals, classes, groups, alternation and ? * + {n}."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset | None, int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def reverse(self) -> None:
        turned: list[list[tuple[frozenset | None, int]]] = [[] for _ in self.edges]
        for a, edges in enumerate(self.edges):
            for s, b in edges:
                turned[b].append((s, a))
        self.edges = turned

    def parse(self, pattern: str) -> tuple[int, int]:
        self.p, self.i = pattern, 0
        return self._either()

    def _peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def _either(self):
        parts = [self._chain()]
        while self._peek() == "|":
            self.i += 1
            parts.append(self._chain())
        a, b = self.state(), self.state()
        for x, y in parts:
            self.edges[a].append((None, x))
            self.edges[y].append((None, b))
        return a, b

    def _chain(self):
        a = b = self.state()
        while self._peek() and self._peek() not in "|)":
            at = self.i
            x, y = self._atom()
            x, y = self._repeat(x, y, at)
            self.edges[b].append((None, x))
            b = y
        return a, b

    def _repeat(self, x, y, at):
        end = self.i
        c = self._peek()
        if c in ("?", "*", "+") and c:
            self.i += 1
            a, b = self.state(), self.state()
            self.edges[a].append((None, x))
            self.edges[y].append((None, b))
            if c != "+":
                self.edges[a].append((None, b))
            if c != "?":
                self.edges[y].append((None, x))
            return a, b
        if c == "{":
            close = self.p.index("}", self.i)
            n = int(self.p[self.i + 1 : close])
            for _ in range(n - 1):
                self.i = at
                u, v = self._atom()
                self.edges[y].append((None, u))
                y = v
            self.i = close + 1
            return x, y
        self.i = end
        return x, y

    def _byte(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "\\":
            c = self.p[self.i]
            self.i += 1
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def _atom(self):
        c = self._peek()
        if c == "(":
            self.i += 3 if self.p.startswith("(?:", self.i) else 1
            got = self._either()
            self.i += 1
            return got
        if c == "[":
            self.i += 1
            found = set()
            while self._peek() != "]":
                lo = hi = self._byte()
                if self._peek() == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    hi = self._byte()
                found.update(range(lo, hi + 1))
            self.i += 1
        else:
            found = {self._byte()}
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(found), b))
        return a, b


class Automaton:
    """Byte classes, ``next`` (states x classes), ``accept`` (a bit for each rule) and ``resets`` (256 booleans).

    backwards: of the reversed expressions, where a match may end at any byte; else anchored at the start state."""

    def __init__(self, rules: tuple[Rule, ...], backwards: bool):
        nfa = _Nfa()
        ends = [nfa.parse(r.regex) for r in rules]
        if backwards:
            nfa.reverse()
            ends = [(b, a) for a, b in ends]
        bits: dict[int, int] = {}
        for k, (_, b) in enumerate(ends):
            bits[b] = 1 << k
        self.classes = self._byte_classes(nfa)
        moves, accept = self._subsets(nfa, [a for a, _ in ends], bits, backwards)
        self.next, self.accept = self._minimise(moves, accept)
        self.resets = (self.next == 0).all(axis=0)[self.classes] if not self.accept[0] else np.zeros(256, bool)
        self.bytewise = self.next[:, self.classes].tolist()
        self.bits = self.accept.tolist()
        live = self.accept > 0
        while True:  # states from which some match can still come
            more = live | live[self.next].any(axis=1)
            if (more == live).all():
                break
            live = more
        self.live = live.tolist()

    @staticmethod
    def _byte_classes(nfa) -> np.ndarray:
        sets = {s for edges in nfa.edges for s, _ in edges if s is not None}
        sets = sorted(sets, key=sorted)
        names: dict[tuple, int] = {}
        return np.array([names.setdefault(tuple(b in s for s in sets), len(names)) for b in range(256)], np.uint8)

    def _subsets(self, nfa, roots, ends, anywhere):
        def closed(states):
            seen, todo = set(states), list(states)
            while todo:
                for s, t in nfa.edges[todo.pop()]:
                    if s is None and t not in seen:
                        seen.add(t)
                        todo.append(t)
            return frozenset(seen)

        sample = {int(c): b for b, c in reversed(list(enumerate(self.classes)))}
        start = closed(roots)
        again = start if anywhere else frozenset()  # every step adds it: a match may begin at any byte
        number, moves, todo = {start: 0}, [], deque([start])
        while todo:
            now = todo.popleft()
            row = []
            for c in range(len(sample)):
                to = again | closed([t for q in now for s, t in nfa.edges[q] if s is not None and sample[c] in s])
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            moves.append(row)
        accept = [0] * len(number)
        for states, k in number.items():
            for q in states:
                accept[k] |= ends.get(q, 0)
        return np.array(moves), np.array(accept)

    @staticmethod
    def _minimise(moves, accept):
        block = np.unique(accept, return_inverse=True)[1]
        while True:
            key = np.column_stack([block, block[moves]])
            _, new = np.unique(key, axis=0, return_inverse=True)
            new = new.reshape(-1)
            if new.max() == block.max():
                break
            block = new
        order = [block[0], *[b for b in range(block.max() + 1) if b != block[0]]]  # the start state is 0
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        block = rank[block]
        first = np.array([np.flatnonzero(block == b)[0] for b in range(len(order))])
        return block[moves[first]].astype(np.int32), accept[first].astype(np.uint16)

    def starts(self, data: np.ndarray, offsets: np.ndarray, shortest: int, few: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which some rule's match starts, ascending, and the rules' bits; of the backwards automaton."""
        places, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
        if len(data):
            cut = self.resets[data]
            border = np.zeros(len(data) + 1, bool)
            border[:-1] = cut
            border[1:] |= cut
            border[offsets] = True
            edges = np.flatnonzero(border)
            begin, size = edges[:-1], np.diff(edges)
            keep = size >= shortest
            begin, size = begin[keep], size[keep]
            order = np.argsort(-size, kind="stable")
            begin, size = begin[order], size[order]
            live = np.searchsorted(-size, -np.arange(1, (int(size[0]) if len(size) else 0) + 1), "right")
            width = self.next.shape[1]
            flat, classes = (self.next * width).astype(np.int32).reshape(-1), self.classes[data].astype(np.int32)
            accept = np.repeat(self.accept, width)
            state, place, done = np.zeros(len(begin), np.int32), begin + size - 1, 0
            for k in live:
                if k < few:
                    break
                state = flat[state[:k] + classes[place[:k]]]
                got = accept[state]
                if got.any():
                    at = np.flatnonzero(got)
                    places.append(place[at])
                    marks.append(got[at])
                place = place[:k] - 1
                done += 1
            if len(live) > done:
                raw, rows, bits = data.tobytes(), self.bytewise, self.bits
                for j in range(int(live[done])):
                    q, last = (int(state[j]) // width if done else 0), int(begin[j] + size[j]) - done
                    long_places, long_marks = [], []
                    for i in range(last - 1, int(begin[j]) - 1, -1):
                        q = rows[q][raw[i]]
                        if bits[q]:
                            long_places.append(i)
                            long_marks.append(bits[q])
                    places.append(np.array(long_places, np.int64))
                    marks.append(np.array(long_marks, np.uint16))
        place, mark = np.concatenate(places), np.concatenate(marks)
        order = np.argsort(place, kind="stable")
        return place[order], mark[order]

    def longest(self, raw: bytes, start: int, end: int, bit: int) -> tuple[int, int]:
        """Ends of the shortest and of the longest match of the rule ``bit`` from ``start``; of the anchored automaton."""
        q, first, last = 0, 0, 0
        rows, bits, live = self.bytewise, self.bits, self.live
        for i in range(start, end):
            q = rows[q][raw[i]]
            if bits[q] & bit:
                first, last = first or i + 1, i + 1
            elif not live[q]:
                break
        return first, last


class Scanner:
    """Both automata of a set of rules (16 at most)."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + EXTRA):
        self.rules = rules
        self.backwards, self.anchored = Automaton(rules, True), Automaton(rules, False)
        self.shortest = 1 + min(len(r.head) > 0 or r.least - 1 for r in rules)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each document with a match: (start, rule, end) in code points, in order."""
        places, marks = self.backwards.starts(data, offsets, self.shortest)
        if not len(places):
            return {}
        raw, found = data.tobytes(), []
        owner = np.searchsorted(offsets, places, "right") - 1
        for k, r in enumerate(self.rules):
            mine = np.flatnonzero(marks >> k & 1)
            before = 0
            for start, doc in zip(places[mine].tolist(), owner[mine].tolist()):
                if start >= before:  # else inside the match before, also a short one
                    first, before = self.anchored.longest(raw, start, int(offsets[doc + 1]), 1 << k)
                    if not r.head or before - first + 1 >= r.least:
                        found.append((doc, start, k, before))
        out: dict[int, list] = {}
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if found else None
        for doc, start, k, end in found:
            zero = letters[offsets[doc]]
            out.setdefault(doc, []).append((int(letters[start] - zero), k, int(letters[end] - zero)))
        for spans in out.values():
            spans.sort()
        return out


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """One row per document: its key and its spans as structs of kind, start and end (code points, end exclusive)."""
    bound_batches(docs.sparkSession)
    scanner = Scanner(rules)
    kinds = [r.kind for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            out: list[list] = [[]] * batch.num_rows
            for i, j in pieces(offsets):
                for doc, spans in scanner.spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).items():
                    out[i + doc] = [{"kind": kinds[k], "start": s, "end": e} for s, k, e in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], ["key", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(lean(run), f"key {kind}, spans array<struct<kind:string,start:int,end:int>>")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """The text with each span replaced; overlapping spans are joined first."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
