"""Rules compiled into one deterministic automaton over bytes.

A rule's regular expression becomes a position automaton; subset construction turns each rule into a scanner
that restarts itself, the scanners run as one product, and partition refinement merges its equal states.
The result is a pair of arrays: byte -> class and (state, class) -> state, with one bit per rule on each state.

Supported syntax (ASCII): literals, ``[...]`` with ranges and ``\\xNN``, groups, ``|``, ``? * +``, ``{m}``,
``{m,}``, ``{m,n}`` and a leading ``(?i)`` for letters in either case.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Rule:
    """``keep`` gets the matched bytes and may reject the match, which is consumed all the same."""

    kind: str
    pattern: str
    keep: object = None


@dataclass
class Positions:
    """Position automaton: each position reads one byte set."""

    sets: list = field(default_factory=list)
    first: frozenset = frozenset()
    last: frozenset = frozenset()
    follow: list = field(default_factory=list)


class _Parser:
    def __init__(self, pattern: str):
        self.fold = pattern.startswith("(?i)")
        self.src, self.at = pattern.removeprefix("(?i)"), 0
        self.out = Positions()

    def peek(self) -> str:
        return self.src[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.src[self.at - 1]

    def leaf(self, chars: set[int]):
        if self.fold:
            chars = {o for c in chars for o in (ord(chr(c).lower()), ord(chr(c).upper())) if o < 128} | chars
        self.out.sets.append(frozenset(chars))
        self.out.follow.append(set())
        p = frozenset([len(self.out.sets) - 1])
        return False, p, p

    def either(self):
        node = self.sequence()
        while self.peek() == "|":
            self.take()
            other = self.sequence()
            node = (node[0] or other[0], node[1] | other[1], node[2] | other[2])
        return node

    def joined(self, a, b):
        for p in a[2]:
            self.out.follow[p] |= b[1]
        return a[0] and b[0], a[1] | b[1] if a[0] else a[1], a[2] | b[2] if b[0] else b[2]

    def sequence(self):
        node = (True, frozenset(), frozenset())
        while self.peek() not in ("", "|", ")"):
            node = self.joined(node, self.repeated())
        return node

    def looped(self, node):
        for p in node[2]:
            self.out.follow[p] |= node[1]
        return node

    def repeated(self):
        start = self.at
        node = self.atom()
        sign = self.peek()
        if sign == "?":
            self.take()
            return True, node[1], node[2]
        if sign in ("*", "+"):
            self.take()
            node = self.looped(node)
            return node[0] or sign == "*", node[1], node[2]
        if sign != "{":
            return node
        stop = self.src.index("}", self.at)
        low, comma, high = self.src[self.at + 1 : stop].partition(",")
        copies = int(high) if high else int(low) + bool(comma and int(low) == 0)
        parts = [node]
        for _ in range(copies - 1):
            self.at = start
            parts.append(self.atom())
        self.at = stop + 1
        if comma and not high:
            parts[-1] = self.looped(parts[-1])
        parts = [(p[0] or i >= int(low), p[1], p[2]) for i, p in enumerate(parts)]
        node = parts[0]
        for p in parts[1:]:
            node = self.joined(node, p)
        return node

    def char(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.src[self.at - 2 : self.at], 16)
        if c.isalnum():
            raise ValueError(f"escape \\{c} is not supported")
        return ord(c)

    def atom(self):
        if self.peek() == "(":
            self.take()
            if self.src.startswith("?:", self.at):
                self.at += 2
            node = self.either()
            if self.take() != ")":
                raise ValueError("unbalanced group")
            return node
        if self.peek() != "[":
            return self.leaf({self.char()})
        self.take()
        chars: set[int] = set()
        while self.peek() != "]":
            low = self.char()
            if self.peek() == "-" and self.src[self.at + 1] != "]":
                self.take()
                chars |= set(range(low, self.char() + 1))
            else:
                chars.add(low)
        self.take()
        return self.leaf(chars)


def positions(pattern: str) -> Positions:
    parser = _Parser(pattern)
    nullable, first, last = parser.either()
    if parser.at != len(parser.src) or nullable:
        raise ValueError(f"cannot use pattern {pattern!r}")
    parser.out.first, parser.out.last = first, last
    return parser.out


def _step(rule: Positions, state: tuple, byte: int) -> tuple:
    """State: (in a match, attempts from the oldest to the youngest). The oldest attempt that matches wins; it is
    extended as far as possible, and no attempt begins inside a match."""
    matched, attempts = state
    out: list[frozenset] = []
    seen: set[int] = set()
    for attempt in attempts:
        moved = frozenset(q for p in attempt for q in rule.follow[p] if byte in rule.sets[q] and q not in seen)
        if not moved:
            continue
        if moved & rule.last:
            if out:
                raise ValueError("a later start would match before an earlier one is decided")
            return True, (moved,)
        if matched:
            raise ValueError("a match must stay a match while it is extended")
        seen |= moved
        out.append(moved)
    fresh = frozenset(q for q in rule.first if byte in rule.sets[q] and q not in seen)
    if fresh & rule.last:
        raise ValueError("a match needs two bytes at least")
    return False, tuple(out) + ((fresh,) if fresh else ())


@dataclass
class Automaton:
    classes: bytes  # byte -> class
    table: np.ndarray  # (state, class) -> state; state 0 is the start
    bits: np.ndarray  # state -> bit per rule that matches up to here
    rules: list  # of Rule
    parts: list  # of Positions

    def linked(self) -> list:
        """Each state as a list of its successors with its bits at the end, for the scan loop."""
        rows = [[None] * self.table.shape[1] for _ in range(len(self.table))]
        for row, targets, bits in zip(rows, self.table.tolist(), self.bits.tolist(), strict=True):
            row[:] = [rows[t] for t in targets]
            row.append(bits)
        return rows


def compile_rules(rules: list[Rule]) -> Automaton:
    parts = [positions(r.pattern) for r in rules]
    sets = [s for p in parts for s in p.sets]
    signature = {b: tuple(b in s for s in sets) for b in range(256)}
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(signature[b], len(kinds)) for b in range(256))
    sample = {c: b for b, c in reversed(list(enumerate(classes)))}
    start = tuple((False, ()) for _ in parts)
    number, todo, table = {start: 0}, [start], []
    known: dict[tuple, tuple] = {}
    for state in todo:  # grows while it is read
        row = []
        for c in range(len(kinds)):
            moved = []
            for k, (part, own) in enumerate(zip(parts, state, strict=True)):
                if (k, own, c) not in known:
                    known[k, own, c] = _step(part, own, sample[c])
                moved.append(known[k, own, c])
            moved = tuple(moved)
            if moved not in number:
                number[moved] = len(todo)
                todo.append(moved)
            row.append(number[moved])
        table.append(row)
    bits = np.array([sum(1 << k for k, s in enumerate(state) if s[0]) for state in todo])
    return Automaton(classes, *_minimised(np.array(table), bits), rules, parts)


def _minimised(table: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input can tell apart, refining the partition by successors until it is stable."""
    part = np.unique(bits, return_inverse=True)[1]
    while True:
        refined = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == part.max():
            break
        part = refined
    order = np.full(part.max() + 1, -1)
    chosen = []
    for state, p in enumerate(part.tolist()):
        if order[p] < 0:
            order[p] = len(chosen)
            chosen.append(state)
    return order[part[table[chosen]]], bits[chosen]


class Scanner:
    """Finds the matches of all rules in one pass over the bytes."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.root = automaton.linked()[0]
        self.before = []
        for part in automaton.parts:
            back = [set() for _ in part.sets]
            for p, after in enumerate(part.follow):
                for q in after:
                    back[q].add(p)
            self.before.append(back)

    def start_of(self, kind: int, data: bytes, end: int, floor: int) -> int:
        """The first byte of the match that ends at ``end`` and begins at ``floor`` or later."""
        part, back = self.automaton.parts[kind], self.before[kind]
        alive, found = part.last, end
        for i in range(end - 1, floor - 1, -1):
            alive = {p for p in alive if data[i] in part.sets[p]}
            if not alive:
                break
            if alive & part.first:
                found = i
            alive = {q for p in alive for q in back[p]}
        return found

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(kind number, first byte, end) of every kept match, ends ascending."""
        ends: list[tuple[int, int]] = []
        state, held = self.root, 0
        for i, c in enumerate(data.translate(self.automaton.classes)):
            state = state[c]
            now = state[-1]
            if now != held:
                ends += [(k, i) for k in range(held.bit_length()) if held & ~now & 1 << k]
                held = now
        ends += [(k, len(data)) for k in range(held.bit_length()) if held & 1 << k]
        out = []
        floor = [0] * len(self.automaton.rules)
        for kind, end in ends:
            begin = self.start_of(kind, data, end, floor[kind])
            floor[kind] = end
            keep = self.automaton.rules[kind].keep
            if keep is None or keep(data[begin:end]):
                out.append((kind, begin, end))
        return out
