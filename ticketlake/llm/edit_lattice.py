"""Cheapest edits that make a sequence of roles alternate: bidirectional Dijkstra over the edit lattice.

A node is (rows read, state). States: nothing written, the system message written, the last one from the user, the
last one from the assistant. Written roles must spell `(s?(ua)+)?`. Letters of an audit: K keep, R change the role,
D delete, I insert. In each state a letter leads to one state only, so an audit names its edits.
"""

from __future__ import annotations

from heapq import heappop, heappush

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES, FINAL = range(4), (EMPTY, ASSISTANT)
# What an edit costs; an undeleted truncated row costs TRUNCATED besides.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# Where a state goes when a role's initial is written.
_WRITES = {(EMPTY, "s"): SYSTEM, (SYSTEM, "u"): USER, (EMPTY, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# Where each state goes by the one role of a user or an assistant that it allows, and that role.
TURN = {EMPTY: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}

# What the lattice needs of a row, as one letter: whether it must go, and its initial (other: none fits), in upper case
# for a truncated row.
MUST_GO, OTHER = "d", "o"


def symbol(initial: str, must_go: bool, truncated: bool) -> str:
    if must_go:
        return MUST_GO
    letter = initial if initial in ("s", "u", "a") else OTHER
    return letter.upper() if truncated else letter


def _row_edges() -> dict[str, list[tuple[int, int, int, str]]]:
    """Per symbol (from state, to state, cost, letter)."""
    edges: dict[str, list[tuple[int, int, int, str]]] = {}
    for letter in "suao":
        for cut in (0, TRUNCATED):
            out = [(q, q, DELETE, "D") for q in STATES]
            out += [(q, TURN[q][0], RENAME + cut, "R") for q in STATES]
            out += [(q, _WRITES[q, letter], cut, "K") for q in STATES if (q, letter) in _WRITES]
            edges[letter.upper() if cut else letter] = out
    edges[MUST_GO] = [(q, q, DELETE, "D") for q in STATES]
    return edges


_ROWS = _row_edges()
_INSERTS = [(q, TURN[q][0], INSERT, "I") for q in STATES]


def _by(end: int, edges: list[tuple[int, int, int, str]]) -> list[list[tuple[int, int, str]]]:
    """Per state at one end of the edges: (state at the other end, cost, letter)."""
    return [[(e[1 - end], e[2], e[3]) for e in edges if e[end] == q] for q in STATES]


_FORWARD, _BACK = ({s: _by(end, e) for s, e in _ROWS.items()} for end in (0, 1))
_INSERT_FORWARD, _INSERT_BACK = (_by(end, _INSERTS) for end in (0, 1))


class _Side:
    """One of the two searches. Nodes of equal cost are settled in the order of rows, as edges without cost lead to
    the next row: a settled node has its final cost and, of equal costs, its least audit."""

    def __init__(self, rows: str, starts: list[tuple[int, int]], forward: bool):
        self.rows, self.forward = rows, forward
        self.best: dict[tuple[int, int], tuple[int, str]] = {}
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        self.heap: list[tuple[int, int, int]] = []
        for at, state in starts:
            self._offer(at, state, 0, "")

    def _offer(self, at: int, state: int, cost: int, audit: str) -> None:
        old = self.best.get((at, state))
        if old is None or (cost, audit) < old:
            self.best[at, state] = cost, audit
            if old is None or cost < old[0]:
                heappush(self.heap, (cost, at if self.forward else len(self.rows) - at, state))

    def top(self) -> int | None:
        while self.heap:
            cost, step, state = self.heap[0]
            node = (step if self.forward else len(self.rows) - step, state)
            if node not in self.settled and self.best[node][0] == cost:
                return cost
            heappop(self.heap)
        return None

    def settle(self) -> None:
        """The node at the top gets its final label, and its neighbours an offer."""
        _, step, state = heappop(self.heap)
        at = step if self.forward else len(self.rows) - step
        cost, audit = self.settled[at, state] = self.best[at, state]
        for other_at, other, more, letter in self.edges(at, state):
            self._offer(other_at, other, cost + more, audit + letter if self.forward else letter + audit)

    def edges(self, at: int, state: int) -> list[tuple[int, int, int, str]]:
        if self.forward:
            out = [(at, q, c, x) for q, c, x in _INSERT_FORWARD[state]]
            if at < len(self.rows):
                out += [(at + 1, q, c, x) for q, c, x in _FORWARD[self.rows[at]][state]]
            return out
        out = [(at, q, c, x) for q, c, x in _INSERT_BACK[state]]
        if at > 0:
            out += [(at - 1, q, c, x) for q, c, x in _BACK[self.rows[at - 1]][state]]
        return out


def cheapest(rows: str, start: int = EMPTY, ends: tuple[int, ...] = FINAL) -> tuple[int, str] | None:
    """Least cost and, of the edits that cost as little, the least audit, from `start` before the rows to one of the
    `ends` behind them; None where there is no way.

    Two heaps grow towards each other, always the one with the smaller top. They stop once no way through an
    unsettled node can be as cheap as the best meeting, so that every equally cheap way has a crossing: an
    edge from what one side has settled to what the other has, or an end that was reached. The least of their
    audits is the answer, as labels of settled nodes are the least for their parts.
    """
    ahead = _Side(rows, [(0, start)], True)
    behind = _Side(rows, [(len(rows), q) for q in ends], False)
    best = None
    while True:
        a, b = ahead.top(), behind.top()
        if a is None or b is None or (best is not None and a + b > best):
            break
        side, other = (ahead, behind) if a <= b else (behind, ahead)
        _, step, state = side.heap[0]
        at = step if side.forward else len(rows) - step
        side.settle()
        here = side.settled[at, state][0]
        if (at, state) in other.best:
            met = here + other.best[at, state][0]
            best = met if best is None else min(best, met)
    if best is None:
        return None
    crossings = []
    for node, (cost, audit) in ahead.settled.items():
        if node[0] == len(rows) and node[1] in ends and cost == best:
            crossings.append(audit)
        for at, q, more, letter in ahead.edges(*node):
            rest = behind.settled.get((at, q))
            if rest is not None and cost + more + rest[0] == best:
                crossings.append(audit + letter + rest[1])
    return best, min(crossings)


def replay(audit: str, initials: str, start: int = EMPTY):
    """Per letter of an audit (row read or None, role to write, 'keep' for the row's own, or None), from a state;
    the state behind it comes last."""
    out, at, state = [], 0, start
    for letter in audit:
        row = None
        if letter != "I":
            row, at = at, at + 1
        if letter == "D":
            out.append((row, None))
        elif letter == "K":
            state = _WRITES[state, initials[row]]
            out.append((row, "keep"))
        else:
            state, role = TURN[state]
            out.append((row, role))
    return out, state
