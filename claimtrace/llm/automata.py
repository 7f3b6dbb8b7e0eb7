"""Many regexes as one deterministic automaton over bytes, and its scan by numpy.

A rule's regex becomes a nondeterministic automaton, then by subset construction a deterministic one
whose states are lists of sets, one set for each place where a match may have begun, the leftmost
first. When a match can grow no more, the transition that shows it names the rule, and the rule's part
starts anew at that byte: leftmost, longest, not overlapping. The rules' automata run side by side
as one; the reachable combinations are minimised and kept as arrays.

A scan passes over the bytes once for all rules. Several texts, each with an end symbol, are cut into
equally long lanes that step together; a lane is then walked again from its true first state until
it meets what was recorded, mostly after a few bytes. The array of states tells where matches end; the
regex run backwards from there finds where one begins, no further than the end of the one before.

Rules are in the syntax of ``re``: ASCII literals and classes, groups, ``|``, ``?``, ``*``, ``+``, ``{m,n}`` and a
leading ``(?i)`` for ASCII letters in either case. A rule whose match could end, go on without matching
and match again is refused, as is one that matches nothing or whose later match can end while an
earlier one is still open: none of them could be decided in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_parser = re._parser  # the standard library's own regex parser
_OP = re._constants
LANES = 4096
_LETTERS = [(c, c ^ 0x20) for c in b"abcdefghijklmnopqrstuvwxyz"]


@dataclass(frozen=True)
class Rule:
    """What to find, and what a whole match must also be to count; other matches use up their bytes too.

    ``inside`` decides ``keep`` in the pass itself: for rules whose matches are frequent and mostly fail it.
    """

    kind: str
    find: str
    keep: str | None = None
    inside: bool = False


class _Nfa:
    """Thompson's construction; symbols are sets of bytes."""

    def __init__(self) -> None:
        self.silent: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.silent.append([])
        self.moves.append([])
        return len(self.silent) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        """The first and the last state of a regex."""
        tree = _parser.parse(pattern.encode("ascii"))
        self.any_case = bool(tree.state.flags & re.IGNORECASE)
        first = self.state()
        return first, self._row(tree, first)

    def _row(self, tree, at: int) -> int:
        for op, value in tree:
            at = self._one(op, value, at)
        return at

    def _one(self, op, value, at: int) -> int:
        if op is _OP.SUBPATTERN:
            return self._row(value[3], at)
        if op is _OP.BRANCH:
            end = self.state()
            for branch in value[1]:
                first = self.state()
                self.silent[at].append(first)
                self.silent[self._row(branch, first)].append(end)
            return end
        if op is _OP.MAX_REPEAT:
            least, most, tree = value
            for _ in range(least):
                at = self._row(tree, at)
            if most is _OP.MAXREPEAT:
                loop = self.state()
                self.silent[at].append(loop)
                self.silent[self._row(tree, loop)].append(loop)
                return loop
            end = self.state()
            for _ in range(most - least):
                self.silent[at].append(end)
                at = self._row(tree, at)
            self.silent[at].append(end)
            return end
        end = self.state()
        self.moves[at].append((self._bytes(op, value), end))
        return end

    def _bytes(self, op, value) -> frozenset[int]:
        if op is _OP.LITERAL:
            held = {value}
        elif op is _OP.IN:
            held = set()
            for kind, x in value:
                if kind is _OP.LITERAL:
                    held.add(x)
                elif kind is _OP.RANGE:
                    held.update(range(x[0], x[1] + 1))
                else:
                    raise ValueError(f"not supported in a class: {kind}")
        else:
            raise ValueError(f"not supported in a rule: {op}")
        if self.any_case:
            held |= {b for pair in _LETTERS if held & set(pair) for b in pair}
        if max(held) > 127:
            raise ValueError("rules are of ASCII characters")
        return frozenset(held)

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.silent[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    def step(self, states, byte: int | None) -> frozenset[int]:
        """``byte`` None is the end of a text: nothing goes on."""
        if byte is None:
            return frozenset()
        return self.closure({to for s in states for held, to in self.moves[s] if byte in held})

    def turned(self) -> _Nfa:
        """The automaton of the reversed words."""
        made = _Nfa()
        for _ in self.silent:
            made.state()
        for s, row in enumerate(self.silent):
            for to in row:
                made.silent[to].append(s)
        for s, moves in enumerate(self.moves):
            for held, to in moves:
                made.moves[to].append((held, s))
        return made


def _classes(nfas: list[_Nfa]) -> tuple[np.ndarray, list[int | None]]:
    """The class of each byte, bytes that no rule tells apart together, and a byte of each class.

    The last class is the end of a text.
    """
    sets = sorted({tuple(sorted(held)) for nfa in nfas for row in nfa.moves for held, _ in row})
    of: dict[tuple[bool, ...], int] = {}
    table, examples = np.zeros(256, np.uint8), []
    members = [set(s) for s in sets]
    for byte in range(256):
        key = tuple(byte in m for m in members)
        if key not in of:
            of[key] = len(of)
            examples.append(byte)
        table[byte] = of[key]
    return table, [*examples, None]


class Whole:
    """A deterministic automaton that reads a word from its start, for one regex."""

    def __init__(self, nfa: _Nfa, first: int, last: int, examples: list[int | None]):
        start = nfa.closure([first])
        number = {start: 0}
        rows, accepts = [], []
        todo = [start]
        for states in todo:  # grows
            accepts.append(last in states)
            row = []
            for byte in examples:
                to = nfa.step(states, byte)
                if to and to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to] if to else -1)
            rows.append(row)
        self.rows, self.accepts = rows, accepts

    def matches(self, symbols) -> bool:
        state = 0
        for c in symbols:
            state = self.rows[state][c]
            if state < 0:
                return False
        return self.accepts[state]


def _part(rule: Rule, nfa: _Nfa, find: tuple[int, int], keep: tuple[int, int] | None, of_find: int, examples: list):
    """One rule's states: where each class leads, and whether a match ends there (1), one that counts (2).

    ``of_find``: the NFA's states below this number belong to ``find``.
    """
    first, last = find
    fresh = nfa.closure([first] if keep is None else [first, keep[0]])
    if last in fresh:
        raise ValueError(f"{rule.kind}: matches nothing at all")
    number: dict[tuple[frozenset[int], ...], int] = {(): 0}
    todo: list[tuple[frozenset[int], ...]] = [()]
    nexts, ends = [], []
    for held in todo:  # grows
        done = bool(held) and last in held[0]
        counts = done and (keep is None or keep[1] in held[0])
        row, marks = [], []
        for byte in examples:
            out: list[frozenset[int]] = []
            seen: set[int] = set()
            for states in held[:1] if done else (*held, fresh):
                to = nfa.step(states, byte) - seen
                if any(s < of_find for s in to):
                    out.append(frozenset(to))
                    seen |= to
            mark = 0
            if done and not out:
                mark = 2 if counts else 1
                out = [to] if (to := nfa.step(fresh, byte)) else []
            elif done and last not in out[0]:
                raise ValueError(f"{rule.kind}: a match may go on without matching")
            if out and last in out[0]:
                out = out[:1]
            elif any(last in states for states in out):
                raise ValueError(f"{rule.kind}: a match may end within an open one")
            key = tuple(out)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            row.append(number[key])
            marks.append(mark)
        nexts.append(row)
        ends.append(marks)
    return np.array(nexts, np.int64), np.array(ends, np.int64)


def _product(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rules' automata side by side: successors, and bits of the rules whose match ends or counts."""
    sizes = [len(n) for n, _ in parts]
    radix = np.concatenate([[1], np.cumprod(sizes[:-1])]).astype(np.int64)
    known = fresh = np.zeros(1, np.int64)

    def leads(codes: np.ndarray) -> np.ndarray:
        return sum(n[codes // r % s] * r for (n, _), r, s in zip(parts, radix, sizes))

    while len(fresh):
        fresh = np.setdiff1d(np.unique(leads(fresh)), known, assume_unique=True)
        known = np.union1d(known, fresh)
    nexts = np.searchsorted(known, leads(known))
    ended, counted = np.zeros_like(nexts), np.zeros_like(nexts)
    for i, ((_, e), r, s) in enumerate(zip(parts, radix, sizes)):
        marks = e[known // r % s]
        ended |= (marks > 0).astype(np.int64) << i
        counted |= (marks == 2).astype(np.int64) << i
    return nexts, ended, counted


def _minimal(nexts: np.ndarray, ended: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States that no sequence of bytes tells apart become one; the first state stays 0."""
    block = np.unique(np.hstack([ended, counted]), axis=0, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[nexts]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    order = np.unique(block, return_index=True)[1]
    swap = np.arange(len(order))
    swap[block[0]], swap[0] = 0, block[0]
    back = np.argsort(swap)
    one = order[back]
    return swap[block[nexts[one]]], ended[one], counted[one]


class Automaton:
    """All rules compiled; ``found`` scans several texts at once."""

    def __init__(self, rules: list[Rule]):
        if not 0 < len(rules) < 63:
            raise ValueError("between 1 and 62 rules")
        self.kinds = [r.kind for r in rules]
        built = []
        for rule in rules:
            nfa = _Nfa()
            find = nfa.add(rule.find)
            size = len(nfa.silent)
            keep = nfa.add(rule.keep) if rule.keep is not None else None
            built.append((rule, nfa, find, size, keep))
        self.classes, examples = _classes([nfa for _, nfa, *_ in built])
        parts = []
        self._begins, self._keeps = [], []
        for rule, nfa, find, size, keep in built:
            parts.append(_part(rule, nfa, find, keep if rule.inside else None, size, examples))
            self._begins.append(Whole(nfa.turned(), find[1], find[0], examples))
            self._keeps.append(None if keep is None or rule.inside else Whole(nfa, *keep, examples))
        nexts, ended, counted = _minimal(*_product(parts))
        self.states, self.symbols = nexts.shape
        # States are kept times the number of symbols, so a state plus a symbol is a place in the arrays.
        self._next = np.ascontiguousarray(nexts * self.symbols).reshape(-1)
        narrow = np.min_scalar_type((1 << len(rules)) - 1)
        self._ended, self._counted = ended.astype(narrow).reshape(-1), counted.astype(narrow).reshape(-1)

    def _pass(self, symbols: np.ndarray) -> np.ndarray:
        """The place of each transition, in the order of the bytes."""
        end = self.symbols - 1
        lanes = max(1, min(LANES, len(symbols) // 64))
        steps = -(-len(symbols) // lanes)
        full = np.full(lanes * steps, end, np.uint8)
        full[: len(symbols)] = symbols
        across = np.ascontiguousarray(full.reshape(lanes, steps).T)
        places = np.empty((steps, lanes), np.int32)
        state = np.zeros(lanes, np.int64)
        for t in range(steps):
            place = state + across[t]
            places[t] = place
            state = self._next.take(place)
        places = np.ascontiguousarray(places.T)
        follow, rows = self._next.tolist(), full.reshape(lanes, steps)
        for lane in range(1, lanes):
            true, row, at = follow[places[lane - 1, -1]], places[lane], 0
            while at < steps:
                place = true + int(rows[lane, at])
                if row[at] == place:
                    break
                row[at] = place
                true = follow[place]
                at += 1
        return places.reshape(-1)[: len(symbols)]

    def _begin(self, rule: int, symbols: np.ndarray, places: np.ndarray, end: int) -> int:
        """Where the match that ends before ``end`` begins."""
        back, state, at, best = self._begins[rule], 0, end, end
        while at > 0:
            state = back.rows[state][symbols[at - 1]]
            if state < 0:
                break
            at -= 1
            if back.accepts[state]:
                best = at
            if int(self._ended[places[at]]) >> rule & 1:  # the match before ends here
                break
        return best

    def found(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, rule, first byte, byte after the last), by where they end; ``ends``: of each text in ``data``."""
        symbols = np.insert(self.classes[data], ends, self.symbols - 1)
        if not len(symbols):
            return
        places = self._pass(symbols)
        starts = np.concatenate([[0], ends[:-1]]) + np.arange(len(ends))  # with the end symbols before
        counted = self._counted[places]
        for end in np.flatnonzero(counted).tolist():
            text = int(np.searchsorted(starts, end, "right")) - 1
            rules = int(counted[end])
            while rules:
                rule = (rules & -rules).bit_length() - 1
                rules &= rules - 1
                begin = self._begin(rule, symbols, places, end)
                keep = self._keeps[rule]
                if keep is None or keep.matches(symbols[begin:end]):
                    yield text, rule, begin - int(starts[text]), end - int(starts[text])
