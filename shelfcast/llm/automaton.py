"""Regular expressions over bytes as one minimal deterministic automaton.

`compile_rules` reads a small regex dialect (literals, \\xHH and escaped
characters, classes, groups, |, ?, *, +, {m}, {m,}, {m,n}), joins the rules'
position automata under a loop over any byte, and applies subset construction
and partition refinement. The outcome is a transition array over byte classes
and, per state, a bit mask of the rules that end there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

#: Rows still running below which the array step gives way to a loop per row.
FEW = 48


class _Reader:
    """Recursive descent over a pattern; builds an automaton with empty moves in shared lists."""

    def __init__(self, pattern: str, any_case: bool, moves: list, empty: list):
        self.s, self.i, self.any_case, self.moves, self.empty = pattern, 0, any_case, moves, empty

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def peek(self) -> str:
        return self.s[self.i : self.i + 1]

    def alternatives(self) -> tuple[int, int]:
        begin, end = self.state(), self.state()
        while True:
            a, b = self.sequence()
            self.empty[begin].append(a)
            self.empty[b].append(end)
            if self.peek() != "|":
                return begin, end
            self.i += 1

    def sequence(self) -> tuple[int, int]:
        begin = end = self.state()
        while self.peek() not in ("", "|", ")"):
            a, b = self.repeated()
            self.empty[end].append(a)
            end = b
        return begin, end

    def repeated(self) -> tuple[int, int]:
        at = self.i
        part = self.atom()
        low, high = 1, 1
        if (c := self.peek()) in "?*+" and c:
            self.i += 1
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        elif m := re.match(r"\{(\d+)(,?)(\d*)\}", self.s[self.i :]):
            self.i += m.end()
            low, high = int(m[1]), int(m[3]) if m[3] else None if m[2] else int(m[1])
        if (low, high) == (1, 1):
            return part
        after = self.i

        def copy() -> tuple[int, int]:
            self.i = at
            made = self.atom()
            self.i = after
            return made

        begin = end = self.state()
        for _ in range(low):
            a, b = copy()
            self.empty[end].append(a)
            end = b
        if high is None:
            a, b = copy()
            self.empty[end].append(a)
            self.empty[b].append(a)
            last = self.state()
            self.empty[end].append(last)
            self.empty[b].append(last)
            return begin, last
        last = self.state()
        for _ in range(high - low):
            self.empty[end].append(last)
            a, b = copy()
            self.empty[end].append(a)
            end = b
        self.empty[end].append(last)
        return begin, last

    def atom(self) -> tuple[int, int]:
        if self.peek() == "(":
            self.i += 3 if self.s.startswith("(?:", self.i) else 1
            made = self.alternatives()
            self.i += 1
            return made
        inside = self.byte_class() if self.peek() == "[" else {self.character()}
        if self.any_case:
            inside |= {x ^ 32 for x in inside if chr(x).isascii() and chr(x).isalpha()}
        begin, end = self.state(), self.state()
        self.moves[begin].append((frozenset(inside), end))
        return begin, end

    def character(self) -> int:
        if self.s.startswith("\\x", self.i):
            self.i += 4
            return int(self.s[self.i - 2 : self.i], 16)
        self.i += 2 if self.peek() == "\\" else 1
        return ord(self.s[self.i - 1])

    def byte_class(self) -> set[int]:
        self.i += 1
        negated = self.peek() == "^"
        self.i += negated
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.character()
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.i += 1
                high = self.character()
            found |= {*range(low, high + 1)}
        self.i += 1
        return set(range(256)) - found if negated else found


@dataclass(frozen=True)
class Automaton:
    """step[state + byte_class[byte]] is the next state; states are multiples of the number of classes."""

    byte_class: np.ndarray
    step: np.ndarray
    ends: np.ndarray  # per state (undivided): bit mask of rules

    @property
    def n_classes(self) -> int:
        return int(self.byte_class.max()) + 1

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per row the bit mask of the rules that occur in it; every byte is read once, all rows side by side."""
        classes = self.byte_class[data]
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = offsets[:-1][order], lengths[order]
        ends = np.zeros(len(self.step), self.ends.dtype)
        ends[:: self.n_classes] = self.ends
        state = np.zeros(len(order), np.int32)
        found = np.zeros(len(order), self.ends.dtype)
        running = len(order) - np.searchsorted(lengths[::-1], np.arange(1, int(lengths.max(initial=0)) + 1))
        i = 0
        for n in running.tolist():
            if n < FEW:
                break
            state[:n] = self.step[state[:n] + classes[begin[:n] + i]]
            found[:n] |= ends[state[:n]]
            i += 1
        if i < len(running):
            step, stops = self.step.tolist(), ends.tolist()
            for k in range(running[i]):
                s, f = int(state[k]), int(found[k])
                for c in classes[begin[k] + i : begin[k] + lengths[k]].tolist():
                    s = step[s + c]
                    if stops[s]:
                        f |= stops[s]
                found[k] = f
        masks = np.zeros(len(order), self.ends.dtype)
        masks[order] = found
        return masks


def compile_rules(rules: list[tuple[str, bool]]) -> Automaton:
    """One automaton for (pattern, letters in either case) rules, found anywhere in a text."""
    moves: list[list] = []
    empty: list[list[int]] = []
    start = _Reader("", False, moves, empty).state()
    ends: dict[int, int] = {}
    for bit, (pattern, any_case) in enumerate(rules):
        reader = _Reader(pattern, any_case, moves, empty)
        a, b = reader.alternatives()
        if reader.i != len(pattern):
            raise ValueError(f"{pattern!r} is not understood at {reader.i}")
        empty[start].append(a)
        ends[b] = 1 << bit

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if moves[s] or s in ends)

    # Bytes that no class tells apart share a class.
    sets = sorted({inside for state in moves for inside, _ in state}, key=sorted)
    signature = [tuple(byte in inside for inside in sets) for byte in range(256)]
    number: dict[tuple, int] = {}
    byte_class = np.array([number.setdefault(x, len(number)) for x in signature], np.int32)
    sample = [int(np.flatnonzero(byte_class == c)[0]) for c in range(len(number))]

    targets = [closure([t]) for t in range(len(moves))]
    reach = [[[targets[t] for inside, t in state if byte in inside] for byte in sample] for state in moves]
    first = closure([start])
    subsets, rows, todo = {first: 0}, [], [first]
    while todo:
        grown = []
        for subset in todo:
            row = []
            for c in range(len(sample)):
                after = frozenset().union(first, *[x for s in subset for x in reach[s][c]])
                if after not in subsets:
                    subsets[after] = len(subsets)
                    grown.append(after)
                row.append(subsets[after])
            rows.append(row)
        todo = grown
    table = np.array(rows, np.int32)
    masks = np.array([sum({ends.get(s, 0) for s in subset}) for subset in subsets], np.int64)

    # States stay together while their outcomes and the parts they lead to are the same.
    part = np.unique(masks, return_inverse=True)[1].reshape(-1)
    while True:
        whole = np.concatenate([part[:, None], part[table]], axis=1)
        refined = np.unique(whole, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == part.max():
            break
        part = refined
    firsts = np.unique(part, return_index=True)[1]
    renumber = np.argsort(np.argsort(firsts))  # the start state stays state 0
    part, firsts = renumber[part], np.sort(firsts)
    step = part[table[firsts]].astype(np.int32) * len(sample)
    return Automaton(byte_class, step.reshape(-1), masks[firsts])
