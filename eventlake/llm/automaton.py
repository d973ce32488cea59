"""Rule patterns to one minimal deterministic automaton over bytes.

A pattern's syntax tree becomes an automaton with empty moves, the union of
all rules is made deterministic by subset construction and minimised by
splitting states until equal ones can't be told apart. What results is a
transition array over byte classes and, per state, the set of rules that end
there as a bit mask.

Scanning. A byte that leads every state back to the first one ends all matches
that are under way: texts are cut behind such bytes (for rules without line
ends, at every line end) into segments, which are scanned side by side, each
step for all that are still running. Segments too short for any match are
skipped; where few long ones are left, they are finished one by one, byte by
byte in plain Python, which is faster for few. Both are linear in the text, and
memory is a few numbers a segment.
"""

from __future__ import annotations

from array import array
from re import _constants as sre
from re import _parser as parser

import numpy as np

#: Segments that are finished one by one.
FEW = 48

ALL_BYTES = (1 << 256) - 1


def byte_set(items: list) -> int:
    """A character class of the syntax tree as a 256-bit set; ASCII only."""
    bits, negate = 0, False
    for op, value in items:
        if op is sre.NEGATE:
            negate = True
        elif op is sre.LITERAL:
            bits |= 1 << value
        elif op is sre.RANGE:
            bits |= (1 << value[1] + 1) - (1 << value[0])
        else:
            raise ValueError(f"not supported in a class: {op}")
    if bits >> 128:
        raise ValueError("classes may name ASCII characters only")
    return ALL_BYTES & ~bits if negate else bits


class Builder:
    """An automaton with empty moves, grown pattern by pattern."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def sequence(self, tree, start: int) -> int:
        """Add a tree's nodes after ``start``; returns the state behind them."""
        for op, value in tree:
            start = self.node(op, value, start)
        return start

    def node(self, op, value, start: int) -> int:
        if op is sre.LITERAL:
            return self.on(byte_set([(op, value)]), start)
        if op is sre.NOT_LITERAL:
            return self.on(byte_set([(sre.NEGATE, None), (sre.LITERAL, value)]), start)
        if op is sre.IN:
            return self.on(byte_set(value), start)
        if op is sre.SUBPATTERN:
            return self.sequence(value[3], start)
        if op is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                self.empty[self.sequence(branch, start)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            return self.repeat(*value, start)
        raise ValueError(f"not supported in a rule: {op}")

    def on(self, bits: int, start: int) -> int:
        end = self.state()
        self.moves[start].append((bits, end))
        return end

    def repeat(self, least: int, most, tree, start: int) -> int:
        for _ in range(least):
            start = self.sequence(tree, start)
        if most is sre.MAXREPEAT:
            loop, end = self.state(), self.state()
            self.empty[start].append(loop)
            self.empty[self.sequence(tree, loop)].append(loop)
            self.empty[loop].append(end)
            return end
        end = self.state()
        for _ in range(most - least):
            self.empty[start].append(end)
            start = self.sequence(tree, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


class Automaton:
    """``table[state, byte]`` and ``rules[state]``, a bit per rule that a text
    has ended in when the state is entered. Matches may start anywhere."""

    def __init__(self, patterns: list[str]):
        table, accept = subsets(patterns)
        group = minimal_groups(table, accept)
        n = int(group.max()) + 1
        pick = np.zeros(n, np.int64)
        pick[group[::-1]] = np.arange(len(group))[::-1]
        self.start = int(group[0])
        self.table = group[table[pick]].astype(np.uint16 if n < 1 << 16 else np.uint32)
        self.rules = accept[pick]
        self.reset = (self.table == self.start).all(axis=0)
        self.shortest = self.least_bytes()
        self.rows: tuple[np.ndarray, np.ndarray] | None = None
        self.plain: tuple[array, bytes] | None = None

    def least_bytes(self) -> int:
        """Bytes of the shortest match."""
        reached, n = np.zeros(len(self.table), bool), 0
        reached[self.start] = True
        while not self.rules[reached].any():
            before = reached.sum()
            reached[self.table[reached].ravel()] = True
            n += 1
            if reached.sum() == before:  # no rule can match
                return 1 << 62
        return n

    def segments(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, rules) of the segments of some texts, laid end to end
        in ``data``, in which a rule matches; by start."""
        starts = np.unique(np.concatenate([np.flatnonzero(self.reset[data]) + 1, np.cumsum(sizes) - sizes]))
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))
        long = ends - starts >= max(1, self.shortest)
        starts, ends = starts[long], ends[long]
        order = np.argsort(starts - ends, kind="stable")  # longest first: those still running are a prefix
        at, length = starts[order], (ends - starts)[order]
        if self.rows is None:  # while scanning, a state is the offset of its row
            width = self.table.shape[1]
            self.rows = self.table.ravel().astype(np.int32) * width, np.repeat(self.rules, width)
            self.plain = array("i", self.rows[0].tobytes()), [int(m) for m in self.rules.tolist()]
        flat, ending = self.rows
        state = np.full(len(at), self.start * self.table.shape[1], np.int64)
        seen = np.zeros(len(at), self.rules.dtype)
        step, n = 0, len(at)
        while n > FEW:
            upto = int(length[n - 1])  # all of the first n run that far
            for step in range(step, upto):
                now = flat[state[:n] + data[at[:n] + step]]
                state[:n] = now
                seen[:n] |= ending[now]
            step = upto
            n = int(np.searchsorted(-length[:n], -step, side="left"))
        for i in range(n):
            seen[i] |= self.finish(data[at[i] + step : at[i] + length[i]].tobytes(), int(state[i]))
        hit = np.zeros(len(at), self.rules.dtype)
        hit[order] = seen
        found = hit != 0
        return starts[found], ends[found], hit[found]

    def finish(self, data: bytes, state: int) -> int:
        """The rules met when ``data`` is read from a state."""
        flat, rules = self.plain
        seen, width = 0, self.table.shape[1]
        for byte in data:
            state = flat[state + byte]
            seen |= rules[state // width]
        return seen

    def scan(self, texts: list[bytes]) -> np.ndarray:
        """Per text the bit mask of the rules that match somewhere in it."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        out = np.full(len(texts), self.rules[self.start])
        starts, _, masks = self.segments(data, sizes)
        owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
        np.bitwise_or.at(out, owner, masks)
        return out


def subsets(patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Subset construction: table over bytes, and the rules ending in each state."""
    builder = Builder()
    root = builder.state()
    builder.moves[root].append((ALL_BYTES, root))
    final = {}
    for rule, pattern in enumerate(patterns):
        start = builder.state()
        builder.empty[root].append(start)
        final[builder.sequence(parser.parse(pattern), start)] = 1 << rule
    kinds = byte_classes({bits for moves in builder.moves for bits, _ in moves})
    sample = [int(np.flatnonzero(kinds == k)[0]) for k in range(kinds.max() + 1)]
    closed = [builder.closure([s]) for s in range(len(builder.moves))]
    on_class = [[[t for bits, t in moves if bits >> b & 1] for b in sample] for moves in builder.moves]
    number = {closed[root]: 0}
    todo, rows, accept = [closed[root]], [], []
    for states in todo:
        accept.append(sum({final[s] for s in states if s in final}))
        row = []
        for k in range(len(sample)):
            after = frozenset().union(*(closed[t] for s in states for t in on_class[s][k]))
            if after not in number:
                number[after] = len(todo)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    return np.array(rows)[:, kinds], np.array(accept, np.int64)


def byte_classes(sets: set[int]) -> np.ndarray:
    """Bytes that no set tells apart get one number."""
    marks = [tuple(bits >> b & 1 for bits in sorted(sets)) for b in range(256)]
    number = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    return np.array([number[m] for m in marks])


def minimal_groups(table: np.ndarray, accept: np.ndarray) -> np.ndarray:
    """The group of every state, split until the groups' moves agree."""
    columns = np.unique(table, axis=1)
    group = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[columns]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            return finer
        group = finer
