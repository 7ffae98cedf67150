"""Cheapest repair of a sequence of roles, by a generalised LR parser.

The grammar of roles is ``(s?(ua)+)?``: a conversation may open with a system
turn and alternates between user and assistant. It is parsed from the last turn
to the first, because ties are decided by the edit nearest the front: at every
step the new edit stands in front of what was parsed before. The parser's stacks
share their lower parts (a graph-structured stack). At each turn every stack top
tries all actions - keep, rerole, delete the turn, insert another - and tops of
the same state are merged into one with the least (cost, audit). In this
grammar each state has one stack only, so a merge loses nothing; `_stacks` makes
sure of it. A turn costs the same work wherever it stands.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush
from itertools import count

#: Roles by initial; the grammar from the last turn to the first.
NAMES = {"s": "system", "u": "user", "a": "assistant"}
RULES = {"S": ["", "P", "Ps"], "P": ["au", "Pau"]}
START = "S"
#: Terminals that a turn may be changed to, or that may be put in.
FREE = "ua"
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Adjacent initials that the grammar allows.
LEGAL = {"su", "ua", "au"}


def _closed(items: set) -> frozenset:
    """Grammar positions (head, body, place) together with those they may begin."""
    items = set(items)
    todo = list(items)
    while todo:
        _, body, place = todo.pop()
        for begun in RULES.get(body[place : place + 1], ()):
            item = (body[place], begun, 0)
            if item not in items:
                items.add(item)
                todo.append(item)
    return frozenset(items)


def _tables() -> tuple[list[dict[str, int]], list[list[tuple[str, int]]]]:
    """For each LR state, the state behind each symbol and the rules (head, length) that end there."""
    states = [_closed({("", START, 0)})]
    moves: list[dict[str, int]] = []
    for state in states:  # grows while it is read
        behind: dict[str, set] = {}
        for head, body, place in state:
            if place < len(body):
                behind.setdefault(body[place], set()).add((head, body, place + 1))
        moves.append({})
        for symbol, items in sorted(behind.items()):
            target = _closed(items)
            if target not in states:
                states.append(target)
            moves[-1][symbol] = states.index(target)
    ends = [sorted((head, len(body)) for head, body, place in state if head and place == len(body)) for state in states]
    return moves, ends


MOVES, ENDS = _tables()
ACCEPT = MOVES[0][START]


class Node:
    """A state of a stack, and the nodes that lie below it."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: tuple[Node, ...] = ()) -> None:
        self.state = state
        self.below = below


def _under(node: Node, depth: int):
    """All nodes that lie ``depth`` below."""
    if not depth:
        yield node
    for lower in node.below if depth else ():
        yield from _under(lower, depth - 1)


class Top:
    """A stack top at one place: cost, order of its audit among equal costs, audit as a linked list."""

    __slots__ = ("node", "cost", "key", "audit", "rank")

    def __init__(self, node: Node, cost: int, key: tuple, audit: tuple | None) -> None:
        self.node, self.cost, self.key, self.audit = node, cost, key, audit
        self.rank = 0


def _settle(found: list[Top]) -> list[Top]:
    """All tops that reductions and insertions make of the given ones, merged by state and ranked.

    Tops are settled from the cheapest on; a later one of the same state can
    only be worse, and lends its links.
    """
    order = count()
    heap = [(t.cost, t.key, next(order), t) for t in found]
    heap.sort()
    settled: dict[int, Top] = {}
    while heap:
        _, _, _, top = heappop(heap)
        node = top.node
        known = settled.get(node.state)
        if known is not None:
            held = {n.state for n in known.node.below}
            more = tuple(n for n in node.below if n.state not in held)
            if more:
                known.node.below += more
            continue
        settled[node.state] = top
        moves = MOVES[node.state]
        for head, length in ENDS[node.state]:
            for base in _under(node, length):
                reduced = Node(MOVES[base.state][head], (base,))
                heappush(heap, (top.cost, top.key, next(order), Top(reduced, top.cost, top.key, top.audit)))
        for symbol in FREE:
            if symbol in moves:
                key = ("I", *top.key)
                new = Top(Node(moves[symbol], (node,)), top.cost + INSERT, key, ("I", top.audit))
                heappush(heap, (new.cost, key, next(order), new))
    tops = list(settled.values())
    for rank, top in enumerate(tops):  # settled in order of (cost, key)
        top.rank = rank
    return tops


def _read(tops: list[Top], mark: str) -> list[Top]:
    """The tops in front of a turn: every way to keep, rerole or delete it."""
    found = []
    role = mark.lower()
    extra = TRUNCATED if mark != role else 0
    for top in tops:
        found.append(Top(top.node, top.cost + DELETE, ("D", top.rank), ("D", top.audit)))
        if mark == "d":
            continue
        moves = MOVES[top.node.state]
        if role in moves:
            found.append(Top(Node(moves[role], (top.node,)), top.cost + extra, ("K", top.rank), ("K", top.audit)))
        for symbol in FREE:
            if symbol in moves:
                found.append(
                    Top(Node(moves[symbol], (top.node,)), top.cost + REROLE + extra, ("R", top.rank), ("R", top.audit))
                )
    return found


def _stacks() -> dict[int, Node]:
    """The one stack of each state. Fails for a grammar in which a state has several."""
    stacks: dict[int, Node] = {}
    shapes: dict[int, tuple] = {}
    todo = [(Node(0), (0,))]
    while todo:
        node, shape = todo.pop()
        if node.state in stacks:
            if shapes[node.state] != shape:
                raise ValueError(f"state {node.state} has several stacks: merging them would not be exact")
            continue
        stacks[node.state], shapes[node.state] = node, shape
        for head, length in ENDS[node.state]:
            (base,) = _under(node, length)
            target = MOVES[base.state][head]
            todo.append((Node(target, (base,)), (*shape[: len(shape) - length], target)))
        for symbol, target in MOVES[node.state].items():
            if symbol not in RULES:
                todo.append((Node(target, (node,)), (*shape, target)))
    return stacks


STACKS = _stacks()


def _text(audit: tuple | None) -> str:
    letters = []
    while audit is not None:
        letter, audit = audit
        letters.append(letter)
    return "".join(letters)


def parse(marks: str, behind: int = 0) -> dict[int, tuple[int, str]]:
    """Least cost and audit for each state in front of the turns ``marks``.

    A mark is the initial of a turn's role (anything but s, u, a: ``x``), in
    upper case if the turn is truncated, or ``d`` if it has to go. ``behind`` is
    the state that the turns behind have led to; without any it is 0.
    """
    tops = _settle([Top(Node(behind, STACKS[behind].below), 0, (), None)])
    for mark in reversed(marks):
        tops = _settle(_read(tops, mark))
    return {top.node.state: (top.cost, _text(top.audit)) for top in tops}


@lru_cache(maxsize=50_000)
def repair(marks: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation; ties go to the ASCII-least audit."""
    return parse(marks)[ACCEPT]


def joined(behind: dict[int, tuple[int, str]], transfers: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str]]:
    """States in front of a stretch of turns, from those behind it and the stretch's own `parse` by state behind."""
    best: dict[int, tuple[int, str]] = {}
    for state, (cost, audit) in behind.items():
        for front, (own, letters) in transfers[state].items():
            made = (cost + own, letters + audit)
            if front not in best or made < best[front]:
                best[front] = made
    return best


def transfers(marks: str) -> dict[int, dict[int, tuple[int, str]]]:
    """`parse` of a stretch of turns for every state that may lie behind it."""
    return {state: parse(marks, state) for state in STACKS}


def repaired(audit: str, rows):
    """(row or None, role, edit) of each turn that stays or comes in; ``rows`` yields (role, ...) in order."""
    rows, last = iter(rows), ""
    for edit in audit:
        row = None if edit == "I" else next(rows)
        if edit == "D":
            continue
        role = row[0] if edit == "K" else NAMES["a" if last == "u" else "u"]
        last = role[:1]
        yield row, role, edit
