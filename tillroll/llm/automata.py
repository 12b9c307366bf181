"""Regular expressions as minimal byte automata, run over many texts at once.

A rule is an ASCII regex of literals, classes, groups, alternation and
repetition. All rules become one nondeterministic automaton, subset
construction makes it deterministic over classes of bytes that no rule tells
apart, and partition refinement makes it minimal. What is left is one
transition array and, per state, a bit mask of the rules that accept there.

``Scanner.states`` runs such an array over a buffer in one pass: the buffer is
cut into lanes that advance together, one byte per step. A lane starts in the
state that no match is open in; where its predecessor ends in another state,
the lane is run again from there until both runs agree, so that the states are
those of a single run from the first byte to the last.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C, _parser

import numpy as np

LANES = 8192
MIN_LANE = 256


class _Nfa:
    def __init__(self):
        self.edges: list[list[tuple[int, int]]] = []  # state -> (byte mask, target)
        self.free: list[list[int]] = []  # state -> targets reached without a byte

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.free[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


def _mask(op, value, ignore_case: bool) -> int:
    def letter(code: int) -> int:
        if code > 127:
            raise ValueError("rules are ASCII")
        both = {chr(code).lower(), chr(code).upper()} if ignore_case else {chr(code)}
        return sum(1 << ord(c) for c in both)

    if op is C.LITERAL:
        return letter(value)
    if op is C.IN:
        mask, negate = 0, False
        for kind, item in value:
            if kind is C.NEGATE:
                negate = True
            elif kind is C.RANGE:
                for code in range(item[0], item[1] + 1):
                    mask |= letter(code)
            else:
                mask |= _mask(kind, item, ignore_case)
        return ((1 << 128) - 1) & ~mask if negate else mask
    raise ValueError(f"unsupported part of a rule: {op}")


def _build(nfa: _Nfa, items, start: int, flip: bool, ignore_case: bool) -> int:
    """Add ``items`` after ``start`` and return the last state; ``flip`` builds the mirrored rule."""
    for op, value in reversed(list(items)) if flip else items:
        if op is C.SUBPATTERN:
            _, on, off, inner = value
            start = _build(nfa, inner, start, flip, ignore_case or bool(on & re.IGNORECASE))
        elif op is C.BRANCH:
            end = nfa.state()
            for branch in value[1]:
                nfa.free[_build(nfa, branch, start, flip, ignore_case)].append(end)
            start = end
        elif op is C.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                start = _build(nfa, inner, start, flip, ignore_case)
            if most is C.MAXREPEAT:
                loop = nfa.state()
                nfa.free[start].append(loop)
                nfa.free[_build(nfa, inner, loop, flip, ignore_case)].append(loop)
                start = loop
            else:
                end = nfa.state()
                nfa.free[start].append(end)
                for _ in range(most - least):
                    start = _build(nfa, inner, start, flip, ignore_case)
                    nfa.free[start].append(end)
                start = end
        else:
            target = nfa.state()
            nfa.edges[start].append((_mask(op, value, ignore_case), target))
            start = target
    return start


@dataclass
class Automaton:
    """``step[state, symbol of the byte]`` is the next state; ``accepts[state]`` the bit mask of rules that end there.

    The symbol ``breaks`` stands between texts and leads back to ``first``.
    """

    symbol: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    first: int
    breaks: int


def compile_rules(rules: list[str], search: bool = True, mirrored: bool = False) -> Automaton:
    """The minimal automaton of all ``rules``; ``search`` lets a match begin at any byte."""
    nfa = _Nfa()
    start = nfa.state()
    if search:
        nfa.edges[start].append(((1 << 256) - 1, start))
    ends = {}
    for number, rule in enumerate(rules):
        begin = nfa.state()
        nfa.free[start].append(begin)
        ends[_build(nfa, _parser.parse(rule), begin, mirrored, False)] = number
    masks = sorted({mask for edges in nfa.edges for mask, _ in edges})
    kinds: dict[tuple, int] = {}
    symbol = np.array([kinds.setdefault(tuple(m >> b & 1 for m in masks), len(kinds)) for b in range(256)], np.uint8)
    sample = [int(np.argmax(symbol == k)) for k in range(len(kinds))]

    first = nfa.closure([start])
    subsets, rows = {first: 0}, []
    todo = [first]
    for subset in todo:  # grows while it is read
        row = []
        for byte in sample:
            reached = nfa.closure({t for s in subset for mask, t in nfa.edges[s] if mask >> byte & 1})
            if reached not in subsets:
                subsets[reached] = len(subsets)
                todo.append(reached)
            row.append(subsets[reached])
        rows.append(row)
    step = np.array(rows, np.int64)
    accepts = np.array([sum(1 << ends[s] for s in subset if s in ends) for subset in todo], np.int64)

    # partition refinement: states stay together while their rules and the blocks of their successors are equal
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    member = np.unique(block, return_index=True)[1]
    step, accepts, start_block = block[step[member]], accepts[member], int(block[0])
    step = np.column_stack([step, np.full(len(step), start_block)])
    return Automaton(symbol, step, accepts, start_block, step.shape[1] - 1)


class Scanner:
    """One automaton over buffers of joined texts."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        width = automaton.step.shape[1]
        self.flat = (automaton.step * width).astype(np.int32).ravel()  # states premultiplied by the row width
        self.width = width
        self.first = np.int32(automaton.first * width)
        self.accepting = np.zeros(len(self.flat), bool)
        self.accepting[np.flatnonzero(automaton.accepts) * width] = True

    def states(self, symbols: np.ndarray) -> np.ndarray:
        """The (premultiplied) state after each symbol."""
        size = len(symbols)
        length = max(MIN_LANE, -(-size // LANES))
        lanes = max(1, -(-size // length))
        padded = np.full(lanes * length, self.automaton.breaks, np.int32)
        padded[:size] = symbols
        columns = np.ascontiguousarray(padded.reshape(lanes, length).T)
        out = np.empty((length, lanes), np.int32)
        state = np.full(lanes, self.first, np.int32)
        for i in range(length):
            state = self.flat.take(columns[i] + state)
            out[i] = state
        begun = np.full(lanes, self.first, np.int32)
        while True:
            due = np.concatenate([[self.first], out[-1, :-1]]).astype(np.int32)
            again = np.flatnonzero(due != begun)
            if not len(again):
                break
            begun = due
            state = due[again]
            for i in range(length):
                state = self.flat.take(columns[i, again] + state)
                changed = state != out[i, again]
                if not changed.all():
                    again, state = again[changed], state[changed]
                    if not len(again):
                        break
                out[i, again] = state
        return out.T.ravel()[:size]

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, offset of the byte, rules) of every byte at which a rule accepts."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths + 1) - 1  # where the breaks stand
        symbols = self.automaton.symbol[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        symbols[ends] = self.automaton.breaks
        states = self.states(symbols)
        at = np.flatnonzero(self.accepting[states])
        text = np.searchsorted(ends, at)
        return text, at - (ends - lengths)[text], self.automaton.accepts[states[at] // self.width]


def longest(automaton: Automaton, text: bytes, start: int) -> int:
    """The end of the longest match that begins at ``start``, or -1; ``automaton`` is anchored."""
    state, end = automaton.first, -1
    symbol, step, accepts = automaton.symbol, automaton.step, automaton.accepts
    dead = _dead(automaton)
    for at in range(start, len(text)):
        state = step[state, symbol[text[at]]]
        if state == dead:
            break
        if accepts[state]:
            end = at + 1
    return end


def _dead(automaton: Automaton) -> int:
    """The state that no match leaves, if there is one."""
    stuck = (automaton.step[:, :-1] == np.arange(len(automaton.step))[:, None]).all(axis=1) & (automaton.accepts == 0)
    found = np.flatnonzero(stuck)
    return int(found[0]) if len(found) else -1
