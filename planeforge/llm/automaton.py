"""A combined deterministic automaton over bytes, for many rules at once.

``Automaton`` reads rule expressions, joins their position automata, determinises them by subset construction over
classes of bytes that no rule tells apart, minimises the result by partition refinement and lays it out as one flat
transition array. Expressions know literals, ``\\xHH`` and escaped characters, classes, groups, ``(?i:...)``, ``|``,
``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``; all of them stand for ASCII bytes.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

Tree = tuple


class _Reader:
    """Recursive descent over one expression; gives a tree of ("set", bytes), ("cat", ...), ("alt", ...), ("rep", x, m, n)."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self, fold: bool) -> Tree:
        out = [self.sequence(fold)]
        while self.peek() == "|":
            self.next()
            out.append(self.sequence(fold))
        return out[0] if len(out) == 1 else ("alt", *out)

    def sequence(self, fold: bool) -> Tree:
        out = []
        while self.peek() not in ("", "|", ")"):
            out.append(self.repeated(self.atom(fold)))
        return ("cat", *out)

    def repeated(self, item: Tree) -> Tree:
        while self.peek() and self.peek() in "?*+{":
            c = self.next()
            if c == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at : end].partition(",")
                self.at = end + 1
                item = ("rep", item, int(low), int(high) if high else None if comma else int(low))
            else:
                item = ("rep", item, int(c == "+"), 1 if c == "?" else None)
        return item

    def letter(self) -> int:
        c = self.next()
        if c != "\\":
            return ord(c)
        c = self.next()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def atom(self, fold: bool) -> Tree:
        if self.peek() == "(":
            self.next()
            if self.text.startswith("?i:", self.at):
                self.at, fold = self.at + 3, True
            tree = self.alternatives(fold)
            self.next()
            return tree
        if self.peek() == "[":
            self.next()
            members: set[int] = set()
            inverse = self.peek() == "^"
            self.at += inverse
            while self.peek() != "]":
                low = self.letter()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.next()
                    members.update(range(low, self.letter() + 1))
                else:
                    members.add(low)
            self.next()
            if inverse:
                members = set(range(256)) - members
        else:
            members = {self.letter()}
        if fold:
            members |= {ord(x) for m in members if m < 128 for x in (chr(m).lower(), chr(m).upper())}
        return ("set", frozenset(members))


def _reverse(tree: Tree) -> Tree:
    kind, *rest = tree
    if kind == "set":
        return tree
    if kind == "rep":
        return (kind, _reverse(rest[0]), *rest[1:])
    parts = [_reverse(x) for x in rest]
    return (kind, *(parts[::-1] if kind == "cat" else parts))


class _Steps:
    """An automaton with empty moves, built from trees."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.move: list[tuple[frozenset[int], int] | None] = []

    def node(self) -> int:
        self.free.append([])
        self.move.append(None)
        return len(self.free) - 1

    def add(self, tree: Tree, start: int) -> int:
        kind, *rest = tree
        if kind == "set":
            here, end = self.node(), self.node()
            self.free[start].append(here)
            self.move[here] = (rest[0], end)
            return end
        if kind == "cat":
            for x in rest:
                start = self.add(x, start)
            return start
        end = self.node()
        if kind == "alt":
            for x in rest:
                self.free[self.add(x, start)].append(end)
            return end
        item, low, high = rest
        for _ in range(low):
            start = self.add(item, start)
        if high is None:
            loop = self.node()
            self.free[start].append(loop)
            self.free[self.add(item, loop)].append(loop)
            self.free[loop].append(end)
            return end
        self.free[start].append(end)
        for _ in range(high - low):
            start = self.add(item, start)
            self.free[start].append(end)
        return end

    def closure(self, nodes: Iterable[int]) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


class Automaton:
    """``table[256 * state + byte]`` is 256 times the next state; states from ``accepting`` on end some rule.

    ``anywhere``: a match may begin at any byte. ``backwards``: the rules are read from their end. ``marks[state]`` has
    a bit for every rule that ends there; state ``dead`` (or -1) can reach no end.
    """

    def __init__(self, rules: list[str], anywhere: bool = True, backwards: bool = False, most: int = 60_000) -> None:
        steps = _Steps()
        begin, ends = steps.node(), []
        for rule in rules:
            tree = _Reader(rule).alternatives(False)
            ends.append(steps.add(_reverse(tree) if backwards else tree, begin))
        bit = {e: 1 << k for k, e in enumerate(ends)}
        sets = {m[0] for m in steps.move if m}
        signature = [tuple(b in s for s in sets) for b in range(256)]
        kinds = {s: k for k, s in enumerate(dict.fromkeys(signature))}
        of_byte = np.array([kinds[s] for s in signature])
        sample = [int(np.argmax(of_byte == k)) for k in range(len(kinds))]

        # Subset construction.
        first = steps.closure([begin])
        numbers, order, rows = {first: 0}, [first], []
        after: dict[tuple[int, int], frozenset[int]] = {}
        for subset in order:
            row = []
            for k, b in enumerate(sample):
                nodes: set[int] = set(first) if anywhere else set()
                for n in subset:
                    if (m := steps.move[n]) and b in m[0]:
                        if (n, k) not in after:
                            after[n, k] = steps.closure([m[1]])
                        nodes |= after[n, k]
                target = frozenset(nodes)
                if target not in numbers:
                    numbers[target] = len(order)
                    order.append(target)
                    if len(order) > most:
                        raise ValueError("the rules need too many states")
                row.append(numbers[target])
            rows.append(row)
        move = np.array(rows)
        mark = np.array([sum(bit.get(n, 0) for n in subset) for subset in order])

        # Minimisation: split classes of states until all of a class agree on the classes they lead to.
        _, group = np.unique(mark, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([group, group[move]]), axis=0, return_inverse=True)
            if finer.max() == group.max():
                break
            group = finer
        _, one = np.unique(group, return_index=True)
        rank = np.argsort(np.argsort(mark[one] > 0, kind="stable"))  # states that end nothing come first
        keep = one[np.argsort(rank)]
        small = rank[group[move[keep]]]
        self.marks: list[int] = mark[keep].tolist()
        self.start = 256 * int(rank[group[0]])
        self.accepting = 256 * int((mark[keep] == 0).sum())
        self.table: list[int] = (256 * small[:, of_byte]).ravel().tolist()
        dead = np.flatnonzero((small == np.arange(len(keep))[:, None]).all(1) & (mark[keep] == 0))
        self.dead = 256 * int(dead[0]) if len(dead) and not anywhere else -1
        self.subsets, self.states = len(order), len(keep)

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(place, rules): where runs of matching ends stop, in one pass over the bytes."""
        table, accepting, marks = self.table, self.accepting, self.marks
        out, state, live, i = [], self.start, 0, 0
        for byte in data:
            state = table[state + byte]
            if state >= accepting or live:
                mark = marks[state >> 8]
                if fell := live & ~mark:
                    out.append((i, fell))
                live = mark
            i += 1
        if live:
            out.append((i, live))
        return out

    def after(self, data: bytes, start: int, end: int, state: int) -> int:
        """The state after ``data[start:end]``."""
        table, dead = self.table, self.dead
        for i in range(start, end):
            if state == dead:
                break
            state = table[state + data[i]]
        return state

    def furthest(self, data: bytes, end: int, stop: int) -> int | None:
        """For a backwards automaton: the least start of a match that ends at ``end``, at or after ``stop``."""
        state, best = self.start, None
        for i in range(end - 1, stop - 1, -1):
            state = self.table[state + data[i]]
            if state >= self.accepting:
                best = i
            elif state == self.dead:
                break
        return best
