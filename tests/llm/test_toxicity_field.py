"""Weights of features that the rows of the field do not have."""

import numpy as np

from riskframe.llm import toxicity


def test_features_without_field_data_keep_their_log_odds():
    docs = [(9, [1, 4], [1, 1], [1, 1]), (7, [2], [1], [1]), (8, [3], [1], [0]), (12, [], [], [])]
    start = np.array([0.0, 2.0, 1.8, 2.5, 3.5, 5.0])
    _, emission = toxicity.fit_field(docs, len(start), start)
    assert np.allclose(emission[2:], start[2:])
    assert abs(emission[1] - start[1]) > 1e-3
    _, fewer = toxicity.fit_field(docs, 2, start[:2])
    assert np.allclose(emission[:2], fewer)
