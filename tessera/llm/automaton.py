"""Regular expressions as one deterministic automaton over bytes.

Rules are parsed by Python's own regex parser, turned into one nondeterministic automaton,
made deterministic by subset construction and minimised by partition refinement.  The
result is transition arrays: state x byte class -> state, and a bit set of the rules that
end in a state.

`scan` runs the automaton over a whole byte buffer in lockstep: the buffer is cut into
lanes which all step together, one numpy gather per step.  A lane first assumes that it
begins in the start state; where the lane before it ended otherwise, it is run again from
that state until both runs agree, so the states are those of a single sequential pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from re import _constants as C
from re import _parser

import numpy as np

_CATEGORIES = {
    "CATEGORY_DIGIT": set(range(48, 58)), "CATEGORY_SPACE": {32, *range(9, 14)},
    "CATEGORY_WORD": {95, *range(48, 58), *range(65, 91), *range(97, 123)},
}


class _Nfa:
    """States with byte-set moves and empty moves; `backwards`: of the reversed words."""

    def __init__(self, backwards: bool = False):
        self.backwards = backwards
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([]), self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree, at: int) -> int:
        """Appends a parsed sequence to state `at`; returns its last state."""
        for op, arg in reversed(list(tree)) if self.backwards else tree:
            at = self._one(op, arg, at)
        return at

    def _one(self, op, arg, at: int) -> int:
        if op is C.LITERAL or op is C.IN or op is C.ANY:
            to = self.state()
            self.moves[at].append((frozenset(self._bytes(op, arg)), to))
            return to
        if op is C.SUBPATTERN:
            return self.add(arg[3], at)
        if op is C.BRANCH:
            to = self.state()
            for tree in arg[1]:
                first = self.state()
                self.empty[at].append(first)
                self.empty[self.add(tree, first)].append(to)
            return to
        if op is C.MAX_REPEAT:
            least, most, tree = arg
            for _ in range(least):
                at = self.add(tree, at)
            if most is C.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(tree, loop)].append(loop)
                return loop
            to = self.state()
            self.empty[at].append(to)
            for _ in range(most - least):
                at = self.add(tree, at)
                self.empty[at].append(to)
            return to
        raise ValueError(f"not supported in a rule: {op}")

    @staticmethod
    def _bytes(op, arg) -> set[int]:
        if op is C.ANY:
            return set(range(256)) - {10}
        if op is C.LITERAL:
            if arg > 127:
                raise ValueError("rules match ASCII only")
            return {arg}
        out: set[int] = set()
        for kind, v in arg:
            if kind is C.LITERAL:
                out.add(v)
            elif kind is C.RANGE:
                out |= set(range(v[0], v[1] + 1))
            elif kind is C.CATEGORY and str(v) in _CATEGORIES:
                out |= _CATEGORIES[str(v)]
            else:
                raise ValueError(f"not supported in a rule: {kind} {v}")
        return out

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    classes: np.ndarray      # byte -> class
    moves: np.ndarray        # state x class -> state; state 0 is the start
    ends: np.ndarray         # state -> bit set of rules
    dead: int                # state from which nothing matches, -1 if there is none

    @cached_property
    def bytewise(self) -> tuple[list[list[int]], list[int]]:
        """(state -> byte -> state, state -> rules) as lists, for walks byte by byte."""
        return self.moves[:, self.classes].tolist(), self.ends.tolist()


def compile_rules(rules: list[str], search: bool, limit: int = 60_000, backwards: bool = False) -> Automaton:
    """One automaton for all rules; `search`: a match may begin at every byte, else only at the first; `backwards`: of reversed text."""
    nfa = _Nfa(backwards)
    start = nfa.state()
    final: dict[int, int] = {}
    for i, rule in enumerate(rules):
        first = nfa.state()
        nfa.empty[start].append(first)
        final[nfa.add(_parser.parse(rule), first)] = 1 << i
    # Bytes that no rule tells apart are one class.
    sets = sorted({m for moves in nfa.moves for m, _ in moves}, key=sorted)
    seen: dict[tuple, int] = {}
    classes = np.array([seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256)], np.uint8)
    some = [int(np.flatnonzero(classes == c)[0]) for c in range(len(seen))]
    again = nfa.closure([start]) if search else frozenset()
    names = {nfa.closure([start]): 0}
    todo, moves = [nfa.closure([start])], []
    for subset in todo:                                   # subset construction; grows while it runs
        row = []
        steps = [m for s in subset for m in nfa.moves[s]]
        for byte in some:
            to = nfa.closure([t for b, t in steps if byte in b]) | again
            if to not in names:
                if len(names) >= limit:
                    raise ValueError("the rules need too many states")
                names[to] = len(todo)
                todo.append(to)
            row.append(names[to])
        moves.append(row)
    ends = np.array([sum({final[s] for s in subset if s in final}) for subset in todo], np.int64)
    return _minimised(classes, np.array(moves, np.int64), ends)


def _minimised(classes: np.ndarray, moves: np.ndarray, ends: np.ndarray) -> Automaton:
    """Partition refinement: states stay together while their moves lead to the same parts."""
    part = np.unique(ends, return_inverse=True)[1]
    count = part.max() + 1
    while True:
        part = np.unique(np.column_stack((part, part[moves])), axis=0, return_inverse=True)[1].ravel()
        if part.max() + 1 == count:
            break
        count = part.max() + 1
    first = np.full(count, len(part))
    np.minimum.at(first, part, np.arange(len(part)))
    order = np.argsort(first)                             # the start's part comes first
    name = np.empty(count, np.int64)
    name[order] = np.arange(count)
    small = name[part[moves[first[order]]]].astype(np.uint16)
    out = ends[first[order]]
    stuck = [s for s in range(count) if not out[s] and (small[s] == s).all()]
    return Automaton(classes, small, out, stuck[0] if stuck and stuck[0] else -1)


def scan(a: Automaton, data: np.ndarray, lanes: int = 4096) -> np.ndarray:
    """State after every byte of the buffer, begun in the start state."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint16)
    width = -(-n // lanes)
    lanes = -(-n // width)
    k = a.moves.shape[1]
    table = a.moves.ravel()
    code = np.zeros(lanes * width, np.uint8)
    code[:n] = a.classes[data]
    code = np.ascontiguousarray(code.reshape(lanes, width).T)         # a row per step
    states = np.empty((width, lanes), np.uint16)
    now = np.zeros(lanes, np.uint16)
    for i in range(width):
        now = table[now.astype(np.intp) * k + code[i]]
        states[i] = now
    assumed = np.zeros(lanes, np.uint16)
    while True:
        begins = np.concatenate((np.zeros(1, np.uint16), states[-1, :-1]))
        wrong = np.flatnonzero(begins != assumed)
        if not len(wrong):
            break
        assumed[wrong] = begins[wrong]
        now = begins[wrong]
        for i in range(width):
            now = table[now.astype(np.intp) * k + code[i, wrong]]
            differ = now != states[i, wrong]
            if not differ.any():
                break
            wrong, now = wrong[differ], now[differ]                   # runs that agree stay so
            states[i, wrong] = now
    return np.ascontiguousarray(states.T).ravel()[:n]


def longest(a: Automaton, data: bytes, at: int) -> int:
    """End of the longest match that begins at `at`, or -1 (for an automaton that doesn't search)."""
    moves, ends = a.bytewise
    state, end, dead = 0, -1, a.dead
    for i in range(at, len(data)):
        state = moves[state][data[i]]
        if state == dead:
            break
        if ends[state]:
            end = i + 1
    return end


def begins(a: Automaton, data: bytes) -> list[int]:
    """Ascending places at which some match begins, by one pass from the end; `a` searches backwards."""
    moves, ends = a.bytewise
    state, out = 0, []
    for i in range(len(data) - 1, -1, -1):
        state = moves[state][data[i]]
        if ends[state]:
            out.append(i)
    return out[::-1]
