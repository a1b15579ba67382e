"""Deterministic byte automata from regular expressions.

Expressions over ASCII (literals, classes, groups, alternatives, repeats, scoped
``(?i:...)``) become one nondeterministic automaton, which subset construction
and minimisation turn into an array of transitions.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser

import numpy as np

_CATEGORIES = {
    sre.CATEGORY_DIGIT: b"0123456789",
    sre.CATEGORY_SPACE: b" \t\n\r\x0b\x0c",
}


class Nondeterministic:
    """Thompson's automaton: byte moves and empty moves between numbered states."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, pattern: str, start: int, reverse: bool = False) -> int:
        """Attach an expression behind ``start``; its last state."""
        return self._sequence(_parser.parse(pattern), start, False, reverse)

    def _sequence(self, items, start: int, either_case: bool, reverse: bool) -> int:
        for item in reversed(list(items)) if reverse else items:
            start = self._item(item, start, either_case, reverse)
        return start

    def _item(self, item, start: int, either_case: bool, reverse: bool) -> int:
        op, value = item
        if op is sre.SUBPATTERN:
            _, added, _, inner = value
            case = either_case or bool(added & re.IGNORECASE)
            return self._sequence(inner, start, case, reverse)
        if op is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                self.empty[self._sequence(branch, start, either_case, reverse)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                start = self._sequence(inner, start, either_case, reverse)
            if most is sre.MAXREPEAT:
                loop = self.state()
                self.empty[start].append(loop)
                self.empty[self._sequence(inner, loop, either_case, reverse)].append(loop)
                return loop
            end = self.state()
            self.empty[start].append(end)
            for _ in range(most - least):
                start = self._sequence(inner, start, either_case, reverse)
                self.empty[start].append(end)
            return end
        end = self.state()
        self.moves[start].append((_bytes_of(op, value, either_case), end))
        return end

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)


def _bytes_of(op, value, either_case: bool) -> frozenset[int]:
    if op is sre.LITERAL:
        found = {value}
    elif op is sre.IN:
        found = set()
        for kind, part in value:
            if kind is sre.LITERAL:
                found.add(part)
            elif kind is sre.RANGE:
                found.update(range(part[0], part[1] + 1))
            elif kind is sre.CATEGORY and part in _CATEGORIES:
                found.update(_CATEGORIES[part])
            else:
                raise ValueError(f"not supported in a class: {kind} {part}")
    else:
        raise ValueError(f"not supported: {op}")
    if max(found) > 127:
        raise ValueError("rules are over ASCII")
    if either_case:
        found |= {ord(c) for b in found for c in (chr(b).lower(), chr(b).upper())}
    return frozenset(found)


class Automaton:
    """A minimal deterministic automaton that recognises several expressions at once.

    ``table[state * classes + byte_class[byte]]`` is the next state; ``mask[state]``
    has bit k set where expression k ends. State 0 is the start. ``search`` lets a
    match begin at every byte; otherwise it begins at the first only. ``reverse``
    reads the expressions from their end.
    """

    def __init__(self, patterns: list[str], search: bool = True, reverse: bool = False) -> None:
        nfa = Nondeterministic()
        start = nfa.state()
        ends: dict[int, int] = {}
        for k, pattern in enumerate(patterns):
            first = nfa.state()
            nfa.empty[start].append(first)
            end = nfa.add(pattern, first, reverse)
            ends[end] = ends.get(end, 0) | 1 << k
        self._classify(nfa)
        table, mask = self._determine(nfa, start, ends, search)
        self.table, self.mask = _minimal(table, mask)
        self.start, self.classes = 0, self.table.shape[1]
        self.flat = self.table.ravel()

    def _classify(self, nfa: Nondeterministic) -> None:
        """Bytes that every move treats alike share a class."""
        sets = sorted({tuple(sorted(s)) for moves in nfa.moves for s, _ in moves})
        member = np.zeros((256, max(1, len(sets))), dtype=bool)
        for i, found in enumerate(sets):
            member[list(found), i] = True
        _, first, classes = np.unique(member, axis=0, return_index=True, return_inverse=True)
        self.byte_class = classes.ravel().astype(np.int32)
        self._example = first

    def _determine(self, nfa, start, ends, search):
        first = nfa.closure(frozenset([start]))
        numbers, todo, table, mask = {first: 0}, [first], [], []
        while todo:
            states = todo.pop(0)
            mask.append(sum(set(ends.get(s, 0) for s in states)) if states else 0)
            row = []
            for byte in self._example:
                moved = {end for s in states for found, end in nfa.moves[s] if byte in found}
                nxt = nfa.closure(frozenset(moved))
                nxt = nxt | first if search else nxt
                if nxt not in numbers:
                    numbers[nxt] = len(numbers)
                    todo.append(nxt)
                row.append(numbers[nxt])
            table.append(row)
        return np.array(table, dtype=np.int32), np.array(mask, dtype=np.int64)


def _minimal(table: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart, by refining classes until they hold."""
    _, group = np.unique(mask, return_inverse=True)
    while True:
        seen = np.column_stack([group, group[table]])
        _, first, refined = np.unique(seen, axis=0, return_index=True, return_inverse=True)
        refined = refined.ravel()
        if len(first) == group.max() + 1:
            break
        group = refined
    order = np.argsort(first, kind="stable")  # the start, found first, becomes state 0
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    return rank[refined[table[first[order]]]].astype(np.int32), mask[first[order]]
