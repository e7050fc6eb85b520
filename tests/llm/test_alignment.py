"""Sequences of any length are aligned by the same rule."""

import random
from difflib import SequenceMatcher

from canvass.llm.wrappers import _matches


def by_longest_runs(a, b):
    n = min(len(a), len(b))
    head = next((k for k in range(n) if a[k] != b[k]), n)
    tail = next((k for k in range(n - head) if a[-1 - k] != b[-1 - k]), n - head)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    blocks = SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
    between = [(head + m.a + k, head + m.b + k) for m in blocks for k in range(m.size)]
    return [(k, k) for k in range(head)] + between + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def test_matches_of_any_length():
    rng = random.Random(3)
    for names, sizes in (("ab", (1, 9)), ("abcdef", (1, 40)), ("abcdefgh", (600, 900))):
        for _ in range(4 if sizes[0] > 1 else 300):
            a, b = ([rng.choice(names) for _ in range(rng.randint(*sizes))] for _ in range(2))
            if rng.random() < 0.5:
                b = [x for x in a if rng.random() < 0.9]
            assert _matches(a, b) == by_longest_runs(a, b)


def test_a_far_match_in_long_sequences():
    """Parts that have moved by more than a few places, in sequences of a hundred and of thousands."""
    for n in (100, 3000):
        a = [f"x{k}" for k in range(n)]
        b = [f"y{k}" for k in range(n)] + a[10 : n - 10] + ["z"]
        assert _matches(a, b) == [(k, n + k - 10) for k in range(10, n - 10)]
