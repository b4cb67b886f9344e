"""What the driver holds for the order of shingles."""

import tracemalloc
import zlib

import numpy as np

from ratelens.llm import jaccard


def pieces(count):
    return {k: zlib.compress(c.tobytes(), 1) for k, c in enumerate(np.split(count, jaccard.PARTS))}


def test_levels_are_those_of_all_counts_at_once():
    count = np.random.default_rng(1).poisson(3, jaccard.CELLS).astype(np.int64)
    count[[0, 70_000, jaccard.CELLS - 1]] = 1_000, 40, 2**20
    mean = count.mean()
    usual = mean + 6 * np.sqrt(mean) + 8
    plain = np.where(count <= usual, 0, 1 + np.log2(np.maximum(count / usual, 1))).astype(np.uint8)
    assert np.array_equal(jaccard.levels_of(pieces(count)), plain) and plain.max() > plain[70_000] > 0
    assert not jaccard.levels_of({}).any() and len(jaccard.levels_of({})) == jaccard.CELLS


def test_driver_holds_one_piece_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([("a b c d e f",), (None,), ("a b c d",)], "text string")
    jaccard.frequencies(docs)
    tracemalloc.start()
    levels = jaccard.frequencies(docs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not levels.any() and most < 4 * jaccard.CELLS
