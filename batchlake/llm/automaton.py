"""Regular expressions compiled together into one minimal deterministic automaton over bytes.

``parse`` reads a small regex language (literals, classes, groups, ``|``, ``?``, ``*``, ``+``,
``{m,n}``) into a tree, ``determinise`` builds transition arrays by subset construction over byte
classes, and ``minimise`` merges states by partition refinement. A state knows which rules accept.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np

#: Stands between texts in a scan; never a byte of UTF-8.
BREAK = 0xFF


# ---- regex trees: ("set", bytes) | ("cat", parts) | ("or", parts) | ("rep", part, least, most) --


class _Reader:
    def __init__(self, pattern: str, fold: bool):
        self.p, self.i, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def members(self, codes) -> tuple:
        found = set(codes)
        if self.fold:
            found |= {c ^ 32 for c in found if 65 <= c & ~32 <= 90}
        return ("set", frozenset(found))

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            code = int(self.p[self.i : self.i + 2], 16)
            self.i += 2
            return code
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def one_of(self) -> tuple:
        codes: list[int] = []
        inverse = self.peek() == "^"
        self.i += inverse
        while self.peek() != "]":
            c = self.take()
            first = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                c = self.take()
                last = self.escaped() if c == "\\" else ord(c)
                codes += range(first, last + 1)
            else:
                codes.append(first)
        self.i += 1
        return self.members(set(range(128)) - set(codes) if inverse else codes)

    def atom(self) -> tuple:
        c = self.take()
        if c == "(":
            inner = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"group not closed in {self.p!r}")
            return inner
        if c == "[":
            return self.one_of()
        code = self.escaped() if c == "\\" else ord(c)
        if code > 127:
            raise ValueError(f"only ASCII in {self.p!r}")
        return self.members([code])

    def repeated(self) -> tuple:
        part = self.atom()
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.p.index("}", self.i)
                low, comma, high = self.p[self.i : end].partition(",")
                self.i = end + 1
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            part = ("rep", part, least, most)
        return part

    def sequence(self) -> tuple:
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def alternatives(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            parts.append(self.sequence())
        return ("or", parts) if len(parts) > 1 else parts[0]


def parse(pattern: str, fold: bool = False) -> tuple:
    """The tree of a pattern; ``fold``: letters match in either case."""
    reader = _Reader(pattern, fold)
    tree = reader.alternatives()
    if reader.i < len(pattern):
        raise ValueError(f"unexpected {reader.peek()!r} in {pattern!r}")
    return tree


def mirror(tree: tuple) -> tuple:
    """The tree of all matches read backwards."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", mirror(tree[1]), *tree[2:])
    parts = [mirror(t) for t in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Net:
    """A nondeterministic automaton with empty moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree: tuple, begin: int) -> int:
        """Put a tree behind state ``begin``; its last state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[begin].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "or":
            end = self.state()
            for part in tree[1]:
                own = self.state()
                self.empty[begin].append(own)
                self.empty[self.add(part, own)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            begin = self.add(part, begin)
        end = self.state()
        if most is None:
            loop = self.state()
            self.empty[begin].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            self.empty[loop].append(end)
            return end
        for _ in range(most - least):
            self.empty[begin].append(end)
            begin = self.add(part, begin)
        self.empty[begin].append(end)
        return end

    def closure(self, states) -> frozenset:
        found, work = set(states), list(states)
        while work:
            for s in self.empty[work.pop()]:
                if s not in found:
                    found.add(s)
                    work.append(s)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``step[state * 256 + byte]`` is the next state; ``accepts[state]`` has bit r set if rule r
    accepts. State 0 is the first one; ``dead`` has no way out and accepts nothing (-1: none)."""

    step: np.ndarray
    accepts: np.ndarray
    dead: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def _byte_classes(net: _Net) -> np.ndarray:
    """Bytes that no transition tells apart share a class."""
    marks = defaultdict(list)
    for k, members in enumerate({m for row in net.moves for m, _ in row}):
        for c in members:
            marks[c].append(k)
    numbers: dict[tuple, int] = {}
    return np.array([numbers.setdefault(tuple(marks[c]), len(numbers)) for c in range(256)])


def determinise(trees: list[tuple], anywhere: bool) -> Automaton:
    """Subset construction over all trees at once; ``anywhere``: a match may begin at any byte.

    The break byte leads back to the first state.
    """
    net = _Net()
    begin, ends = net.state(), []
    for tree in trees:
        own = net.state()
        net.empty[begin].append(own)
        ends.append(net.add(tree, own))
    classes = _byte_classes(net)
    sample = {int(k): c for c, k in reversed(list(enumerate(classes)))}
    first = net.closure([begin])
    numbers, order, table = {first: 0}, [first], []
    for now in order:
        row = []
        for k in range(len(sample)):
            after = {t for s in now for members, t in net.moves[s] if sample[k] in members}
            after = net.closure(after | ({begin} if anywhere else set()))
            if after not in numbers:
                numbers[after] = len(order)
                order.append(after)
            row.append(numbers[after])
        table.append(row)
    bits = [sum(1 << r for r, e in enumerate(ends) if e in states) for states in order]
    step = np.array(table)[:, classes]
    step[:, BREAK] = 0
    return minimise(step, np.array(bits, dtype=np.int64))


def minimise(step: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that accept alike and lead to merged states, until nothing changes."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, first, new = np.unique(
            np.column_stack([group, group[step]]), axis=0, return_index=True, return_inverse=True
        )
        new = new.ravel()
        if new.max() == group.max():
            break
        group = new
    # State 0 stays the first one.
    order = np.concatenate(([new[0]], np.delete(np.arange(new.max() + 1), new[0])))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    rows = first[order]
    small = np.uint8 if len(rows) <= 256 else np.uint16 if len(rows) <= 65536 else np.uint32
    table = rank[new[step[rows]]].astype(small)
    kept = accepts[rows]
    inner = np.delete(np.arange(256), BREAK)
    stuck = [s for s in range(len(rows)) if not kept[s] and (table[s][inner] == s).all()]
    return Automaton(table.ravel(), kept, stuck[0] if stuck else -1)


# ---- scanning --------------------------------------------------------------------------------


def states_of(auto: Automaton, data: np.ndarray, lanes: int = 4096) -> np.ndarray:
    """The state after each byte of ``data``.

    The bytes are cut into lanes that advance together, each from the first state. A lane whose
    true beginning is another state is run again from there until it meets what it had; lanes are
    corrected until none is left, so the result is that of one run.
    """
    n = len(data)
    out = np.zeros(n, dtype=auto.step.dtype)
    if not n:
        return out
    lanes = max(1, min(lanes, n // 64))
    width = -(-n // lanes)
    lanes = -(-n // width)
    padded = np.full(lanes * width, BREAK, dtype=np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
    found = np.empty((width, lanes), dtype=auto.step.dtype)
    state = np.zeros(lanes, dtype=np.int64)
    for k in range(width):
        state = auto.step[(state << 8) + columns[k]].astype(np.int64)
        found[k] = state
    entry = np.zeros(lanes, dtype=np.int64)
    while True:
        true = np.concatenate(([0], found[-1, :-1].astype(np.int64)))
        odd = np.flatnonzero(true != entry)
        if not len(odd):
            break
        entry[odd] = state = true[odd]
        for k in range(width):
            state = auto.step[(state << 8) + columns[k, odd]].astype(np.int64)
            changed = state != found[k, odd]
            if not changed.all():
                odd, state = odd[changed], state[changed]
                if not len(odd):
                    break
            found[k, odd] = state
    return found.T.ravel()[:n]


def longest(auto: Automaton, data: bytes, begin: int) -> int:
    """End of the longest match that begins at ``begin`` and crosses no break, or -1."""
    step, accepts, dead = auto.step, auto.accepts, auto.dead
    state, end = 0, -1
    for i in range(begin, len(data)):
        if data[i] == BREAK:
            break
        state = int(step[(state << 8) + data[i]])
        if accepts[state]:
            end = i + 1
        elif state == dead:
            break
    return end
