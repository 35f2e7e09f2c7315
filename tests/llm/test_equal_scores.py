"""A text's score does not depend on the texts that are scored with it."""

import numpy as np

from siltstone.llm import quality


def test_score_of_a_row_in_any_batch():
    rng = np.random.default_rng(0)
    x = rng.random((256, quality.FEATURES)).astype(np.float32)
    scorer = quality.Scorer.standardised(x)
    scorer.w = rng.normal(0, 0.3, scorer.inputs(x).shape[1])
    row, seen = x[7].copy(), set()
    for n in range(1, 257):
        for at in (0, n // 2, n - 1):
            batch = x[:n].copy()
            batch[at] = row
            seen.add(float(scorer.score(batch)[at]))
    assert len(seen) == 1
