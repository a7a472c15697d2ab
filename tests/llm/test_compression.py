"""The compression classifier against plain zstandard and a plain loss."""

import numpy as np
import pytest
import zstandard

from vitrine.llm import compression_quality as cq


@pytest.mark.parametrize("kind", ["mixed", "separable", "one_value"])
def test_calibration_is_the_least_loss(kind):
    rng = np.random.default_rng(6)
    features = rng.normal(0, 1, (400, 2)) * [0.01, 3] + 2
    good = (rng.uniform(size=400) < 1 / (1 + np.exp(-(features[:, 1] - 2)))).astype(int)
    if kind == "separable":
        good = (features[:, 1] > 2).astype(int)
    if kind == "one_value":
        features[:] = 0.25
    mean, scale, weights = cq.calibrate(features, good)
    x = cq.expanded(np.clip((features - mean) / scale, -8, 8))
    penalty = np.r_[np.ones(x.shape[1] - 1), 1e-6]
    least = cq.penalised_loss(x, good, weights, penalty)
    for k in range(len(weights)):  # a convex loss: no step along an axis lowers it
        for move in (1e-3, -1e-3):
            assert cq.penalised_loss(x, good, weights + move * np.eye(len(weights))[k], penalty) >= least - 1e-9


def test_features_are_the_size_difference_alone():
    good, bad = b"the quick brown fox jumps over the lazy dog " * 30, b"qqq zzz 000 ### " * 60
    texts = [b"", b"the lazy dog jumps over the quick brown fox", b"### qqq zzz", b"x" * 3_000_000]
    sizes = cq.Sizes(good, bad)
    for text in texts:
        size = []
        for data in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            packer = zstandard.ZstdCompressor(level=cq.LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False)
            size.append(len(packer.compress(text)))
        difference = size[1] - size[0]
        assert sizes.features(text) == pytest.approx([difference / (len(text) + 1), difference / sum(size)], abs=2 / (len(text) + 1))
    assert sizes.features(texts[1])[0] > 0 > sizes.features(texts[2])[0]
