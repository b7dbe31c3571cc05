"""Bounds of sorted lists: results by depth, and how much of the lists is read."""

import numpy as np

from rollbook.llm.exact_topk import SortedLists


def want(ids, vectors, query_id, query, k):
    scores = vectors @ query
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query_id][:k]
    return ids[order].tolist(), scores[order].tolist()


def test_lists_give_the_best_and_stop_early_where_outsiders_cannot_qualify():
    rng = np.random.default_rng(1)
    near = rng.integers(400, 1000, (40, 12)) * rng.choice([-1, 1], 12)  # one bright cluster among dim vectors
    vectors = np.concatenate([near, rng.integers(-60, 60, (2000, 12))])
    ids = rng.permutation(len(vectors)).astype(np.int64)
    queries = np.concatenate([near[:30], rng.integers(-60, 60, (5, 12)), np.zeros((1, 12), np.int64)])
    query_ids = np.concatenate([ids[:30], [-1, -2, -3, -4, -5, -6]])
    lists = SortedLists(ids, vectors)
    for i, (found, scores) in enumerate(lists.top(query_ids, queries, 10)):
        assert (found.tolist(), scores.tolist()) == want(ids, vectors, query_ids[i], queries[i], 10)
    whole = queries.size * len(vectors)
    assert lists.read < 0.5 * whole  # the cluster's queries stop at a quarter of the lists
    alone = SortedLists(ids, vectors)
    alone.top(query_ids[30:], queries[30:], 10)
    assert alone.read > lists.read / 6  # dim queries read further


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(4)
    vectors, queries = rng.integers(-50, 50, (300, 7)), rng.integers(-50, 50, (20, 7)).astype(float)
    lists, exact = SortedLists(np.arange(300), vectors), queries @ vectors.T
    for depth in (1, 10, 150, 299, 300):
        low, high = lists._bounds(queries, depth)
        assert (low <= exact + 1e-6).all() and (exact <= high + 1e-6).all()


def test_few_candidates_and_ties():
    vectors = np.array([[1, 0], [1, 0], [1, 0], [0, 1]])
    lists = SortedLists(np.array([5, 3, 9, 1]), vectors)
    (ids, scores), = lists.top(np.array([3]), np.array([[2, 0]]), 2)
    assert ids.tolist() == [5, 9] and scores.tolist() == [2, 2]
    (ids, _), = lists.top(np.array([77]), np.array([[2, 0]]), 10)
    assert ids.tolist() == [3, 5, 9, 1]
