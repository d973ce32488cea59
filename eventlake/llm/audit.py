"""Cheapest repairs of a sequence of roles, by dynamic programming over
persistent edit histories.

A history is a string of edit initials: ``D``elete, ``I``nsert, ``K``eep,
``R``erole. ``Node`` is its last edit and links to the history before it, so
histories share their prefixes and adding an edit costs a node. A node knows
its ancestors 1, 2, 4, ... edits back and a rolling hash of its whole history;
two histories of equal cost are compared by a search for their longest common
prefix, halving over the ancestors. Equal hashes are not trusted: the prefix
that the search finds is confirmed (``shared``), and where hashes collide the
true first difference is taken.

``Audit`` takes rows one by one and keeps, for each state of the grammar
``(s?(ua)+)?``, the cheapest history that ends there, the ASCII-least one
where costs tie, with the SHA-256 of the repaired text so far. Equal costs
never meet with one history a prefix of the other, as both have taken the same
rows and an insertion costs; so a lesser history stays lesser whatever
follows. Edits that all living histories share are moved to a byte string now
and then. What is held grows with the edits that are still open, not with the
texts. They stay open for long only where two histories never meet again, as
in a conversation without a single valid role (some 400 bytes an edit then).
"""

from __future__ import annotations

import hashlib

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a role initial is taken in a state.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that reroling and insertion give in a state, and the state after it.
GIVEN = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}
FINAL = (START, ASSISTANT)
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Any state is reached from ASSISTANT at no more than a deletion, and from
#: USER at an insertion more: what costs more than that is never cheapest.
DETOUR = {ASSISTANT: DELETE, USER: DELETE + INSERT}
BASE, MOD = 1_000_003, (1 << 61) - 1
#: Rows after which shared edits are moved out.
SETTLE_ROWS = 4096


class Node:
    """The last edit of a history."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None, letter: str):
        self.letter = letter
        if parent is None:  # the history so far: nothing before it is kept
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MOD
        up = [parent]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)


def ancestor(node: Node, depth: int) -> Node:
    """The history's beginning of ``depth`` edits."""
    while node.depth > depth:
        node = node.up[(node.depth - depth).bit_length() - 1]
    return node


def shared(x: Node, y: Node) -> int:
    """How many edits two histories of equal length, with equal hashes, share
    from their beginning: all of them unless hashes collide."""
    common = x.depth
    while x is not y and x.up:
        if x.letter != y.letter:
            common = x.depth - 1
        x, y = x.up[0], y.up[0]
    return common


def common_prefix(x: Node, y: Node) -> int:
    """Edits in the longest common prefix of two histories."""
    depth = min(x.depth, y.depth)
    a, b = ancestor(x, depth), ancestor(y, depth)
    if a.hash != b.hash:
        for k in range(len(a.up) - 1, -1, -1):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        a, b = a.up[0], b.up[0]
    return shared(a, b)


def less(x: Node, y: Node) -> bool:
    """Whether history x comes before y in ASCII order."""
    n = common_prefix(x, y)
    if n == x.depth or n == y.depth:
        return x.depth < y.depth
    return ancestor(x, n + 1).letter < ancestor(y, n + 1).letter


class Audit:
    """``take`` the rows of one conversation in order, then ask for ``result``."""

    def __init__(self) -> None:
        self.settled = bytearray()
        #: state: (cost, history, SHA-256 so far, whether a row is in it)
        self.cells = {START: (0, Node(None, ""), hashlib.sha256(), False)}
        self.insert()
        self.rows = 0

    def offer(self, cells: dict, state: int, cell: tuple, letter: str, cost: int, role: str | None = None, text: str = "") -> None:
        """Extend ``cell`` by an edit if that beats what ``state`` has."""
        had = cells.get(state)
        if had is not None and cost > had[0]:
            return
        node = Node(cell[1], letter)
        if had is not None and cost == had[0] and not less(node, had[1]):
            return
        cells[state] = (cost, node, cell, role, text)

    def write(self, cells: dict) -> dict:
        """Cells as ``offer`` left them, with the repaired text hashed."""
        out = {}
        for state, (cost, node, before, role, text) in cells.items():
            digest, begun = before[2], before[3]
            if role is not None:
                digest = digest.copy()
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            out[state] = (cost, node, digest, begun)
        return out

    def insert(self) -> None:
        """Add insertions until none is cheaper."""
        while True:
            found: dict = {s: (c, n, None, None, None) for s, (c, n, _, _) in self.cells.items()}
            for state, cell in self.cells.items():
                role, to = GIVEN[state]
                self.offer(found, to, cell, "I", cell[0] + INSERT, role)
            new = self.write({s: x for s, x in found.items() if x[2] is not None})
            if not new:
                return
            self.cells.update(new)

    def take(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        found: dict = {}
        for state, cell in self.cells.items():
            self.offer(found, state, cell, "D", cell[0] + DELETE)
            if must_go:
                continue
            kept = cell[0] + (TRUNCATED if truncated else 0)
            if (state, role[:1]) in NEXT:
                self.offer(found, NEXT[state, role[:1]], cell, "K", kept, role, text)
            given, to = GIVEN[state]
            self.offer(found, to, cell, "R", kept + REROLE, given, text)
        self.cells = self.write(found)
        self.insert()
        most = min(self.cells[s][0] + d for s, d in DETOUR.items())
        self.cells = {s: c for s, c in self.cells.items() if c[0] <= most}
        self.rows += 1
        if self.rows % SETTLE_ROWS == 0:
            self.settle()

    def settle(self) -> None:
        """Move the edits that all living histories share to ``settled``."""
        nodes = [c[1] for c in self.cells.values()]
        depth = min(common_prefix(nodes[0], n) for n in nodes)
        self.settled += letters(ancestor(nodes[0], depth), depth)
        again = {id(ancestor(n, depth)): Node(None, "") for n in nodes}
        for n in nodes:
            chain = []
            while id(n) not in again:
                chain.append(n)
                n = n.up[0]
            for old in reversed(chain):
                again[id(old)] = Node(again[id(old.up[0])], old.letter)
        self.cells = {s: (c, again[id(n)], *rest) for s, (c, n, *rest) in self.cells.items()}

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired text) of the cheapest repair."""
        best = None
        for state in FINAL:
            cell = self.cells.get(state)
            if cell and (best is None or cell[0] < best[0] or (cell[0] == best[0] and less(cell[1], best[1]))):
                best = cell
        cost, node, digest, _ = best
        return cost, (self.settled + letters(node, node.depth)).decode(), digest.hexdigest()


def letters(node: Node, n: int) -> bytes:
    """The last ``n`` edits of a history."""
    out = bytearray()
    for _ in range(n):
        out += node.letter.encode()
        node = node.up[0]
    return bytes(reversed(out))
