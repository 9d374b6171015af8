"""Stochastic grammar inference: prefix-tree states merged where their statistics agree.

The learner is the state-merging scheme of Carrasco and Oncina (1994): the
prefix tree of the examples is folded breadth first, a state joining an
accepted one when neither the share of ends nor that of any symbol differs by
more than a Hoeffding bound, here or in the states that follow.
"""

from __future__ import annotations

import math

SYMBOLS = 96  # printable characters: the uniform distribution that smooths every state
SMOOTHING = 0.5


class Automaton:
    """A deterministic probabilistic automaton: visits, ends, and counted transitions of each state."""

    def __init__(self):
        self.visits: list[int] = []
        self.ends: list[int] = []
        self.moves: list[dict[str, list[int]]] = []  # symbol -> [state, count]

    def add_state(self) -> int:
        self.visits.append(0)
        self.ends.append(0)
        self.moves.append({})
        return len(self.visits) - 1

    @classmethod
    def prefix_tree(cls, examples: list[str]) -> "Automaton":
        tree = cls()
        tree.add_state()
        for text in examples:
            state = 0
            tree.visits[0] += 1
            for symbol in text:
                move = tree.moves[state].get(symbol)
                if move is None:
                    move = tree.moves[state][symbol] = [tree.add_state(), 0]
                move[1] += 1
                state = move[0]
                tree.visits[state] += 1
            tree.ends[state] += 1
        return tree

    # ---- learning

    @classmethod
    def learn(cls, examples: list[str], confidence: float = 0.05) -> "Automaton":
        self = cls.prefix_tree(sorted(examples))
        bound = math.sqrt(0.5 * math.log(2 / confidence))
        accepted, waiting = [0], []
        known = {0}

        def frontier():
            found = []
            for state in accepted:
                for symbol in sorted(self.moves[state]):
                    target = self.moves[state][symbol][0]
                    if target not in known:
                        found.append((state, symbol, target))
            return found

        waiting = frontier()
        while waiting:
            state, symbol, new = waiting[0]
            for old in accepted:
                if self._agree(old, new, bound):
                    self.moves[state][symbol][0] = old
                    self._fold(old, new)
                    break
            else:
                accepted.append(new)
                known.add(new)
            waiting = frontier()
        return self._only(accepted)

    def _agree(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if most >= 1:
                continue  # too few visits to differ, here and further on
            if abs(self.ends[a] / n - self.ends[b] / m) > most:
                return False
            for symbol in self.moves[a].keys() | self.moves[b].keys():
                x, y = self.moves[a].get(symbol), self.moves[b].get(symbol)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > most:
                    return False
                if x and y and x[0] != y[0]:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """The subtree at ``b`` is added to the states reached from ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, (target, count) in self.moves[b].items():
                move = self.moves[a].get(symbol)
                if move is None:
                    self.moves[a][symbol] = [target, count]
                else:
                    move[1] += count
                    if move[0] != target:
                        stack.append((move[0], target))

    def _only(self, accepted: list[int]) -> "Automaton":
        number = {state: i for i, state in enumerate(accepted)}
        out = Automaton()
        for state in accepted:
            i = out.add_state()
            out.visits[i], out.ends[i] = self.visits[state], self.ends[state]
            out.moves[i] = {s: [number[t], c] for s, (t, c) in sorted(self.moves[state].items())}
        return out

    # ---- scoring

    def log2(self, text: str) -> float:
        """Log2 probability of the text; a symbol that a state has not seen leads back to the start."""
        total, state = 0.0, 0
        for symbol in text:
            n = self.visits[state] + SMOOTHING
            move = self.moves[state].get(symbol)
            total += math.log2(((move[1] if move else 0) + SMOOTHING / SYMBOLS) / n)
            state = move[0] if move else 0
        return total + math.log2((self.ends[state] + SMOOTHING / SYMBOLS) / (self.visits[state] + SMOOTHING))
