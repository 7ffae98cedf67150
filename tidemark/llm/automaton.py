"""Rule regexes as one deterministic automaton over bytes.

The rules' regexes (literals, classes, groups, ``|``, ``? * +`` and ``{n,}``)
become one nondeterministic automaton, subset construction makes it
deterministic, minimisation merges equal states, and the result is a flat
transition array indexed by state and byte class. One pass over a text's bytes
tells where matches of every rule end; a small reversed automaton for each rule
then finds where a match starts, only at those ends.
"""

from __future__ import annotations

from collections.abc import Sequence


class _Nfa:
    """Thompson's construction; edges carry byte sets, None is an empty move."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1


_ALL = frozenset(range(256))


class _Regex:
    """Parses one regex into a tree: (kind, parts)."""

    def __init__(self, pattern: str) -> None:
        self.text, self.at = pattern, 0
        self.tree = self._either()
        if self.at < len(pattern):
            raise ValueError(f"unexpected {pattern[self.at]!r} in {pattern!r}")

    def _next(self) -> str:
        return self.text[self.at : self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _either(self):
        options = [self._row()]
        while self._next() == "|":
            self._take()
            options.append(self._row())
        return ("either", options)

    def _row(self):
        parts = []
        while self._next() not in ("", "|", ")"):
            part = self._atom()
            while self._next() and self._next() in "?*+{":
                mark = self._take()
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(mark, (0, 0))
                if mark == "{":
                    inner = self.text[self.at : self.text.index("}", self.at)]
                    self.at += len(inner) + 1
                    low, comma, high = inner.partition(",")
                    least, most = int(low), (int(high) if high else None) if comma else int(low)
                part = ("repeat", part, least, most)
            parts.append(part)
        return ("row", parts)

    def _atom(self):
        c = self._take()
        if c == "(":
            inner = self._either()
            if self._take() != ")":
                raise ValueError(f"open group in {self.text!r}")
            return inner
        if c == "[":
            return ("set", self._set())
        return ("set", frozenset([ord(self._escaped(c))]))

    def _escaped(self, c: str) -> str:
        if c != "\\":
            return c
        c = self._take()
        if c == "x":
            self.at += 2
            return chr(int(self.text[self.at - 2 : self.at], 16))
        return c

    def _set(self) -> frozenset[int]:
        members: set[int] = set()
        while self._next() != "]":
            low = ord(self._escaped(self._take()))
            high = low
            if self._next() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self._take()
                high = ord(self._escaped(self._take()))
            members.update(range(low, high + 1))
        self._take()
        return frozenset(members)


def _any_case(on: frozenset[int]) -> frozenset[int]:
    letters = [b for b in on if chr(b).isalpha() and b < 128]
    return on | {b ^ 32 for b in letters}


def _build(nfa: _Nfa, tree, start: int, any_case: bool, backwards: bool) -> int:
    """Adds ``tree`` after ``start`` and gives the state behind it."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.edges[start].append((_any_case(tree[1]) if any_case else tree[1], end))
        return end
    if kind == "row":
        for part in reversed(tree[1]) if backwards else tree[1]:
            start = _build(nfa, part, start, any_case, backwards)
        return start
    if kind == "either":
        end = nfa.state()
        for option in tree[1]:
            nfa.edges[_build(nfa, option, start, any_case, backwards)].append((None, end))
        return end
    _, part, least, most = tree
    for _ in range(least):
        start = _build(nfa, part, start, any_case, backwards)
    if most is None:
        loop = nfa.state()
        nfa.edges[start].append((None, loop))
        nfa.edges[_build(nfa, part, loop, any_case, backwards)].append((None, loop))
        return loop
    end = nfa.state()
    nfa.edges[start].append((None, end))
    for _ in range(most - least):
        start = _build(nfa, part, start, any_case, backwards)
        nfa.edges[start].append((None, end))
    return end


class Automaton:
    """Minimal deterministic automaton of several rules.

    ``classes`` maps a byte to its class, ``table[state + class]`` is the next
    state (states are multiples of the number of classes), ``accepts`` gives the
    rules that end in a state; states from ``first_accept`` on are those with any.
    ``dead`` is the state without a way to accept, or -1.
    """

    def __init__(self, rules: Sequence[tuple[str, bool]], anywhere: bool = True, backwards: bool = False) -> None:
        nfa = _Nfa()
        start = nfa.state()
        if anywhere:
            nfa.edges[start].append((_ALL, start))
        ends: dict[int, int] = {}
        for number, (pattern, any_case) in enumerate(rules):
            own = nfa.state()
            nfa.edges[start].append((None, own))
            ends[_build(nfa, _Regex(pattern).tree, own, any_case, backwards)] = number
        self._determine(nfa, start, ends)

    def _determine(self, nfa: _Nfa, start: int, ends: dict[int, int]) -> None:
        sets = {on for edges in nfa.edges for on, _ in edges if on is not None}
        groups: dict[tuple[bool, ...], list[int]] = {}
        ordered = sorted(sets, key=sorted)
        for byte in range(256):
            groups.setdefault(tuple(byte in on for on in ordered), []).append(byte)
        blocks = list(groups.values())
        width = len(blocks)
        class_of = bytearray(256)
        for number, block in enumerate(blocks):
            for byte in block:
                class_of[byte] = number

        def closure(state: int) -> frozenset[int]:
            seen, todo = {state}, [state]
            while todo:
                for on, target in nfa.edges[todo.pop()]:
                    if on is None and target not in seen:
                        seen.add(target)
                        todo.append(target)
            return frozenset(seen)

        # By state and class: what can be reached, empty moves included.
        reach: list[list[frozenset[int]]] = []
        for edges in nfa.edges:
            own = [[t for on, t in edges if on is not None and block[0] in on] for block in blocks]
            reach.append([frozenset().union(*map(closure, targets)) for targets in own])

        # Subset construction.
        found = {closure(start): 0}
        order, moves = list(found), []
        for subset in order:
            moving = [row for s in subset if any(row := reach[s])]
            row = []
            for number in range(width):
                target = frozenset().union(*[r[number] for r in moving])
                if target not in found:
                    found[target] = len(found)
                    order.append(target)
                row.append(found[target])
            moves.append(row)
        labels = [frozenset(ends[s] for s in subset if s in ends) for subset in order]

        # Minimisation: split blocks of states until all moves agree.
        part = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        block_of = [part[label] for label in labels]
        while True:
            signatures = [(block_of[s], *(block_of[t] for t in moves[s])) for s in range(len(order))]
            names = {signature: n for n, signature in enumerate(dict.fromkeys(signatures))}
            refined = [names[signature] for signature in signatures]
            if len(names) == len(set(block_of)):
                break
            block_of = refined
        member = {}
        for s, block in enumerate(block_of):
            member.setdefault(block, s)
        blocks_in_order = sorted(member, key=lambda b: bool(labels[member[b]]))
        place = {b: n * width for n, b in enumerate(blocks_in_order)}
        self.classes = bytes(class_of)
        self.width = width
        self.table = [place[block_of[t]] for b in blocks_in_order for t in moves[member[b]]]
        self.start = place[block_of[0]]
        self.accepts = {place[b]: tuple(sorted(labels[member[b]])) for b in blocks_in_order if labels[member[b]]}
        self.first_accept = min(self.accepts, default=len(self.table))
        self.dead = next(
            (
                place[b]
                for b in blocks_in_order
                if not labels[member[b]] and all(block_of[t] == b for t in moves[member[b]])
            ),
            -1,
        )

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(position after the byte, state) wherever some rule's match ends."""
        table, state, least = self.table, self.start, self.first_accept
        hits = []
        for at, c in enumerate(data.translate(self.classes), 1):
            state = table[state + c]
            if state >= least:
                hits.append((at, state))
        return hits

    def stretches(self, data: bytes, rules: int) -> list[list[int]]:
        """For each rule, where the maximal stretches of ends of its matches end.

        Memory goes with the number of stretches, however long they are.
        """
        table, state, least, accepts = self.table, self.start, self.first_accept, self.accepts
        stretches: list[list[int]] = [[] for _ in range(rules)]
        for at, c in enumerate(data.translate(self.classes), 1):
            state = table[state + c]
            if state >= least:
                for rule in accepts[state]:
                    own = stretches[rule]
                    if own and own[-1] == at - 1:
                        own[-1] = at
                    else:
                        own.append(at)
        return stretches

    def first_start(self, data: bytes, end: int, bound: int) -> int | None:
        """For a backwards automaton: smallest start from ``bound`` on of a match that ends at ``end``."""
        table, classes, state, least = self.table, self.classes, self.start, self.first_accept
        found = None
        for at in range(end - 1, bound - 1, -1):
            state = table[state + classes[data[at]]]
            if state >= least:
                found = at
            elif state == self.dead:
                break
        return found

    def last_end(self, data: bytes, start: int) -> int:
        """For an automaton of one place: end of the longest match from ``start`` on, ``start`` if there is none."""
        table, classes, state, least = self.table, self.classes, self.start, self.first_accept
        found = start
        for at in range(start, len(data)):
            state = table[state + classes[data[at]]]
            if state >= least:
                found = at + 1
            elif state == self.dead:
                break
        return found
