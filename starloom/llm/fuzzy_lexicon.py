"""A lexicon that also finds misspelled terms: Levenshtein automata intersected
with a trie of the terms.

The automaton of a term has a position (characters matched, edits made); all
terms together share the trie's nodes as positions.  A set of such positions is
one state of the intersection, and states and their transitions are made when a
word first needs them.  Reading a word is then one dictionary look-up a
character, and most words reach the dead state after a few.

Edits are insertion, deletion, substitution and the swap of two neighbours.
"""

from __future__ import annotations

from collections.abc import Mapping

#: (least length of a term, edits it allows).
BUDGETS = ((9, 2), (5, 1), (0, 0))
#: States that are kept before the table starts anew.
MAX_STATES = 20_000


def edit_budget(term: str, budgets: tuple = BUDGETS) -> int:
    return next(edits for least, edits in budgets if len(term) >= least)


class FuzzyLexicon:
    """Finds the nearest term of a word.  ``terms`` gives each term's weight;
    among terms of as few edits the heavier is found, then the first by name."""

    def __init__(self, terms: Mapping[str, float], budgets: tuple = BUDGETS, max_states: int = MAX_STATES):
        self.terms = dict(terms)
        self._max_states = max_states
        self._children: list[dict[str, int]] = [{}]
        self._term: list[str | None] = [None]
        self._budget: list[int] = [-1]  # most edits that a term below a node allows
        self._own: dict[str, int] = {}
        for t in sorted(t for t in self.terms if t):
            allowed, node = edit_budget(t, budgets), 0
            self._own[t] = allowed
            self._budget[0] = max(self._budget[0], allowed)
            for ch in t:
                if ch not in self._children[node]:
                    self._children[node][ch] = len(self._children)
                    self._children.append({})
                    self._term.append(None)
                    self._budget.append(-1)
                node = self._children[node][ch]
                self._budget[node] = max(self._budget[node], allowed)
            self._term[node] = t
        self._reset()

    def __reduce__(self):
        return FuzzyLexicon, (self.terms,)

    def _reset(self) -> None:
        self._number: dict[frozenset, int] = {frozenset(): 0}
        self._state: list[frozenset] = [frozenset()]
        self._next: list[dict[str, int]] = [{}]
        self._found: list[tuple[str, int] | None] = [None]
        self._start = self._intern(self._close({(0, None): 0}))

    def _close(self, positions: dict) -> frozenset:
        """``positions`` ((node, awaited letter) -> edits) and what they reach
        by leaving out letters of a term."""
        todo = [(n, e) for (n, awaited), e in positions.items() if awaited is None]
        while todo:
            node, e = todo.pop()
            for child in self._children[node].values():
                if e < self._budget[child] and e + 1 < positions.get((child, None), 99):
                    positions[child, None] = e + 1
                    todo.append((child, e + 1))
        return frozenset((n, a, e) for (n, a), e in positions.items() if e <= self._budget[n])

    def _intern(self, state: frozenset) -> int:
        if state not in self._number:
            self._number[state] = len(self._state)
            self._state.append(state)
            self._next.append({})
            best = min(((e, -self.terms[t], t) for n, awaited, e in state
                        if awaited is None and (t := self._term[n]) is not None and e <= self._own[t]), default=None)
            self._found.append(best and (best[2], best[0]))
        return self._number[state]

    def _step(self, state: int, ch: str) -> int:
        out: dict = {}

        def reach(node: int, awaited: str | None, e: int) -> None:
            if e <= self._budget[node] and e < out.get((node, awaited), 99):
                out[node, awaited] = e

        for node, awaited, e in self._state[state]:
            if awaited is not None:
                if ch == awaited:  # the second of two swapped letters
                    reach(node, None, e)
                continue
            reach(node, None, e + 1)  # a letter too many
            for letter, child in self._children[node].items():
                reach(child, None, e if letter == ch else e + 1)
                if letter != ch and ch in self._children[child]:
                    reach(self._children[child][ch], letter, e + 1)
        return self._intern(self._close(out))

    def find(self, word: str) -> tuple[str, int] | None:
        """(nearest term, edits), or None if no term is near enough."""
        if len(self._state) > self._max_states:
            self._reset()
        at = self._start
        for ch in word:
            to = self._next[at].get(ch)
            if to is None:
                to = self._next[at][ch] = self._step(at, ch)
            if not to:
                return None
            at = to
        return self._found[at]
