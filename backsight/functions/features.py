"""Polynomial features of a numeric state and an action, as array expressions and as the same arrays in numpy.

State features are all products of two entries of [1, state]; pair features are state features times
[1, one-hot action without the last].
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _outer(left: Column, right: Column) -> Column:
    return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: x * y)))


def state_features(state: Column) -> Column:
    base = F.concat(F.array(F.lit(1.0)), state)
    return _outer(base, base)


def pair_features(state: Column, action: Column, actions: Sequence[int]) -> Column:
    marks = F.array(F.lit(1.0), *[(action == a).cast("double") for a in list(actions)[:-1]])
    return _outer(state_features(state), marks)


def state_size(width: int) -> int:
    return (width + 1) ** 2


def pair_size(width: int, actions: Sequence[int]) -> int:
    return state_size(width) * len(actions)


def literal(weights: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(w)) for w in weights])


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda a, b: a + b)


# the same in numpy, for batches of rows ---------------------------------------------------------------------------
#
# With b = [1, state] the state features are the outer product of b with itself. It is never built: a linear score is
# the quadratic form b'Wb, and a sum of features over rows is B' diag(f) B.

def base_matrix(states: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(states), 1)), states])


def state_matrix(states: np.ndarray) -> np.ndarray:
    """The features themselves, for callers that return them row by row."""
    base = base_matrix(states)
    return (base[:, :, None] * base[:, None, :]).reshape(len(states), -1)


def action_marks(actions: Sequence[int]) -> np.ndarray:
    """Row per action: [1, one-hot without the last]."""
    marks = np.eye(len(actions))[:, :-1]
    return np.hstack([np.ones((len(actions), 1)), marks])


def action_index(values: np.ndarray, actions: Sequence[int]) -> np.ndarray:
    """Position of each value in the action list; an action that is not in it is an error."""
    order = np.argsort(actions)
    known = np.asarray(actions)[order]
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    if (known[place] != values).any():
        raise ValueError(f"an action that is not one of {list(actions)}")
    return order[place]


def values(base: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """weights . state features for every row."""
    width = base.shape[1]
    return ((base @ weights.reshape(width, width)) * base).sum(axis=1)


def score_matrix(base: np.ndarray, weights: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """weights . pair features for every row and action."""
    width = base.shape[1]
    parts = weights.reshape(width, width, -1)
    return np.stack([((base @ parts[:, :, k]) * base).sum(axis=1) for k in range(parts.shape[2])], axis=1) @ marks.T


def state_sums(base: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Sum over rows of factor * state features."""
    return (base.T @ (factor[:, None] * base)).ravel()


def pair_sums(base: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Sum over rows of state features times the row's factors, one for each mark."""
    return np.stack([base.T @ (factors[:, k : k + 1] * base) for k in range(factors.shape[1])], axis=-1).ravel()


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)
