"""A generalised suffix automaton over word sequences."""

from __future__ import annotations

from collections.abc import Iterator


class SuffixAutomaton:
    """All runs of words of some items.

    State 0 is the empty run. ``words[s]`` leads on from state ``s``, ``link[s]`` is the state
    of its longest proper suffix that other places have too, ``length[s]`` its longest run.
    """

    def __init__(self, items: list[list[bytes]], window: int) -> None:
        self.words: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for item in items:
            self._add(item)
        self._mark(items, window)

    def _state(self, length: int, link: int, words: dict[bytes, int]) -> int:
        self.words.append(words)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, word: bytes, to: int) -> int:
        """Part the runs of ``to`` that end here from its longer ones."""
        part = self._state(self.length[at] + 1, self.link[to], dict(self.words[to]))
        self.link[to] = part
        while at >= 0 and self.words[at].get(word) == to:
            self.words[at][word] = part
            at = self.link[at]
        return part

    def _add(self, item: list[bytes]) -> None:
        last = 0
        for word in item:
            known = self.words[last].get(word)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
                continue
            state, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.words[at]:
                self.words[at][word] = state
                at = self.link[at]
            if at >= 0:
                to = self.words[at][word]
                self.link[state] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
            last = state

    def _mark(self, items: list[list[bytes]], window: int) -> None:
        """Which items have the run of ``window`` words a state stands for, and which are a whole short item.

        ``ends[s]``: the length and the items of every window that ends where state ``s`` ends.
        """
        owners: dict[int, set[int]] = {}
        for k, item in enumerate(items):
            state = 0
            for i, word in enumerate(item):
                state, at = self.words[state][word], 0
                if i + 1 >= window:
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                elif len(item) < window and i + 1 == len(item):
                    at = state
                    while self.length[self.link[at]] >= len(item):
                        at = self.link[at]
                if at:
                    owners.setdefault(at, set()).add(k)
        self.ends: list[tuple[tuple[int, tuple[int, ...]], ...]] = [()] * len(self.length)
        sizes = [min(len(item), window) for item in items]
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            own = [(size, tuple(k for k in owners[state] if sizes[k] == size)) for size in sorted({sizes[k] for k in owners[state]})] if state in owners else []
            self.ends[state] = (*self.ends[self.link[state]], *own)

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Stream words: for each that ends a match, its index, the state and the longest match there."""
        step, link, length = self.words, self.link, self.length
        state = size = 0
        for i, word in enumerate(words):
            to = step[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = step[state].get(word)
                if to is None:
                    size = 0
                    continue
                size = length[state]
            state = to
            size += 1
            yield i, state, size
