"""Scores stay finite where a decision has been seen so often that its chance is next to one."""

import numpy as np

from canvass.llm.context_tree import Model, Tree, _entries


def test_sure_decisions():
    key = np.array([ord("a"), ord("b"), 0xFE], np.uint64)
    levels = [(key, np.array([9e8, 9e8, 1.0]))]
    for first in (ord("a"), ord("e")):
        deep = key[:2] | np.uint64(first << 8)
        levels = [levels[0], (deep, np.array([4e8, 4e8]))]
        tree = Tree(levels)
        assert all((0 <= s).all() and (s <= 1).all() for s in tree.stop)
        tables, _, _ = tree.mixed(np.zeros(len(tree.levels[0][0])), np.ones(len(tree.levels[0][0])))
        score = Model(tables, *_entries(tables, levels, 0)).score(np.arange(255, dtype=np.uint64) | np.uint64(first << 8))
        assert np.isfinite(score).all() and (score <= 0).all()
        assert abs((10**score).sum() - 1) < 1e-3
