"""Top-k search where cover trees can't prune: many dimensions, no clusters, crowds of equal scores."""

import numpy as np
import pytest

from ampliscope.llm import cover_tree


def nodes(node):
    return 1 + sum(map(nodes, node.children))


def test_scattered_points_stay_together():
    """Uniform directions in 64 dimensions: before, nearly every point was a node of its own."""
    v = np.random.default_rng(1).normal(0, 1, (3000, 64))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None])
    assert nodes(cover_tree.CoverTree(v).root) < 100
    # clusters are still told apart, and no point is lost
    centres = v[:20].repeat(100, 0)
    tree = cover_tree.CoverTree(np.concatenate((np.floor(centres + np.random.default_rng(2).normal(0, 2, centres.shape)), v[20:])))
    assert 20 <= len(tree.root.children) and nodes(tree.root) < 400
    assert sorted(np.concatenate([c.points for c in tree.root.children])) == list(range(len(tree.vectors)))


@pytest.mark.parametrize("scale", [1, 2**14, 2**24])
def test_search_over_scattered_points_is_exact(monkeypatch, scale):
    """In floats, doubles and 64-bit integers; with clusters, equal vectors, repeated ids and queries in several blocks."""
    monkeypatch.setattr(cover_tree, "ABREAST", 7)
    monkeypatch.setattr(cover_tree, "TOGETHER", 3)
    rng = np.random.default_rng(scale)
    v = rng.normal(0, 40, (900, 40))
    v[100:300] = v[100] + rng.normal(0, 1, (200, 40))
    v[300:500], v[600:640] = v[300], 0
    v = np.floor(v * scale)
    v[500:600:2] += 1
    ids = rng.permutation(900)
    ids[:20] = ids[20:40]
    q = np.concatenate((np.arange(0, 900, 17), [301, 302, 610]))
    found = cover_tree.Search(cover_tree.CoverTree(v[q]), ids[q], cover_tree.CoverTree(v), ids, 5)
    assert found.left.dtype == {1: np.float32, 2**14: np.float64, 2**24: np.int64}[scale]
    whole = v.astype(np.int64)
    for k, i in enumerate(q):
        s = whole @ whole[i]
        want = sorted((-int(s[j]), int(ids[j])) for j in range(900) if ids[j] != ids[i])[:5]
        assert [(-a, b) for a, b in zip(found.best_score[k], found.best_id[k])] == want
