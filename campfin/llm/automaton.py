"""Rule expressions to one minimal deterministic automaton over bytes.

Understood: literals, ``\\x20`` and escaped punctuation, classes of characters
and ranges, groups, ``|``, and ``? * + {n} {n,} {m,n}``.  All characters are
ASCII.  The steps are the textbook ones: a nondeterministic automaton from the
syntax, subsets of its states, and refinement of the states' partition until
no two states of a block differ.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEAD = -1


class _Syntax:
    """Recursive descent over one expression; yields nested tuples."""

    def __init__(self, pattern: str, fold: bool):
        self.p, self.i, self.fold = pattern, 0, fold

    def parse(self):
        tree = self.choice()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} in {self.p!r}")
        return tree

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            options.append(self.sequence())
        return ("or", options) if len(options) > 1 else options[0]

    def sequence(self):
        items = []
        while self.i < len(self.p) and self.peek() not in "|)":
            items.append(self.repeat())
        return ("seq", items)

    def repeat(self):
        item = self.atom()
        while self.i < len(self.p) and self.peek() in "?*+{":
            c = self.take()
            lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (0, 0))
            if c == "{":
                j = self.p.index("}", self.i)
                a, comma, b = self.p[self.i:j].partition(",")
                lo, hi = int(a), int(a) if not comma else int(b) if b else None
                self.i = j + 1
            item = ("rep", item, lo, hi)
        return item

    def atom(self):
        c = self.take()
        if c == "(":
            tree = self.choice()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            return tree
        if c == "[":
            chars = set()
            while self.peek() != "]":
                a = self.single()
                if self.peek() == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    chars.update(range(a, self.single() + 1))
                else:
                    chars.add(a)
            self.i += 1
            return ("set", self.folded(chars))
        self.i -= 1
        return ("set", self.folded({self.single()}))

    def single(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return ord(c)

    def folded(self, chars):
        if self.fold:
            chars = chars | {ord(f) for c in chars for f in (chr(c).lower(), chr(c).upper())}
        return frozenset(chars)

    def peek(self):
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self):
        c = self.p[self.i]
        self.i += 1
        return c


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, tree, start: int) -> int:
        """Hang ``tree`` on ``start``; returns the state after it."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            mid = self.state()
            self.empty[start].append(mid)
            self.step[mid] = (tree[1], end)
            return end
        if kind == "seq":
            for t in tree[1]:
                start = self.add(t, start)
            return start
        if kind == "or":
            end = self.state()
            for t in tree[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(t, first)].append(end)
            return end
        _, item, lo, hi = tree
        for _ in range(lo):
            start = self.add(item, start)
        if hi is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(item, loop)].append(loop)
            return loop
        end = self.state()
        for _ in range(hi - lo):
            self.empty[start].append(end)
            start = self.add(item, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Automaton:
    """``step[state, klass[byte]]`` is the next state (or DEAD), ``accepts``
    the bit set of expressions that end in a state; state 0 is the start."""

    step: np.ndarray
    klass: np.ndarray
    accepts: list[int]

    def longest(self, data: bytes, at: int, end: int) -> int:
        """End of the longest match that starts at ``at``; -1 if none."""
        s, found = 0, -1
        rows, klass = self.rows, self.klass_bytes
        for i in range(at, end):
            s = rows[s][klass[data[i]]]
            if s == DEAD:
                break
            if self.accepts[s]:
                found = i + 1
        return found

    def __post_init__(self):
        self.rows = self.step.tolist()
        self.klass_bytes = self.klass.astype(np.uint8).tobytes()


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool) -> Automaton:
    """One automaton for all (expression, either case) pairs.  ``anywhere``
    looks for matches that start at any byte, else they start at state 0."""
    nfa = _Nfa()
    start = nfa.state()
    ends = {}
    sets = set()
    for k, (pattern, fold) in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        ends[nfa.add(_Syntax(pattern, fold).parse(), first)] = 1 << k
    sets = sorted({s[0] for s in nfa.step if s}, key=sorted)
    signature = {b: tuple(b in s for s in sets) for b in range(256)}
    order = {sig: i for i, sig in enumerate(sorted(set(signature.values())))}
    klass = np.array([order[signature[b]] for b in range(256)])
    sample = {order[signature[b]]: b for b in range(256)}

    begin = nfa.closure([start])
    ids, todo, step = {begin: 0}, [begin], []
    while todo:
        now = todo.pop(0)
        moves = [nfa.step[s] for s in now if nfa.step[s]]
        row = []
        for c in range(len(order)):
            nxt = {t for chars, t in moves if sample[c] in chars}
            if anywhere:
                nxt |= {start}
            nxt = nfa.closure(nxt)
            if not nxt:
                row.append(DEAD)
                continue
            if nxt not in ids:
                ids[nxt] = len(ids)
                todo.append(nxt)
            row.append(ids[nxt])
        step.append(row)
    accepts = [0] * len(ids)
    for states, k in ids.items():
        for s in states:
            accepts[k] |= ends.get(s, 0)
    return _minimal(np.array(step), klass, accepts)


def _minimal(step: np.ndarray, klass: np.ndarray, accepts: list[int]) -> Automaton:
    """Split blocks of states by the blocks that they lead to until stable."""
    _, block = np.unique(np.array(accepts), return_inverse=True)
    while True:
        ahead = np.where(step == DEAD, DEAD, block[step])
        _, finer = np.unique(np.column_stack([block, ahead]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number the blocks by their first state, so that the start stays 0.
    firsts = {}
    for state, b in enumerate(block.tolist()):
        firsts.setdefault(b, state)
    number = {b: i for i, b in enumerate(sorted(firsts, key=firsts.get))}
    keep = [firsts[b] for b in sorted(firsts, key=firsts.get)]
    small = np.array([[DEAD if t == DEAD else number[block[t]] for t in step[s]] for s in keep])
    return Automaton(small, klass, [accepts[s] for s in keep])
