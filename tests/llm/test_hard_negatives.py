import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import deckspark.llm.hard_negatives as H

from .oracle import assert_equals_sql

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, g int, dim string"


def brute(rows, positives=5, negatives=5, every=10):
    usable = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i in {r[0] for r in usable if r[0] % every == 0}:
        _, lab, a = min((r for r in usable if r[0] == i), key=lambda r: (r[1], r[2]))
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, lab == m) for j, m, v in usable if j != i and len(v) == len(a))
        for s, j, _ in [x for x in scored if x[2]][:positives]:
            inside = [x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, j, k, x[1], -s, -x[0]) for k, x in enumerate(inside[:negatives], 1)]
    return sorted(out)


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == brute(rows)
    return found


def vectors(rnd, ids, dim, labels=3):
    return [(i, rnd.randrange(labels), [rnd.uniform(-1, 1) for _ in range(dim)]) for i in ids]


def test_blocks_meet_blocks(spark, monkeypatch):
    """Small blocks on both sides: every pair of them is scanned."""
    monkeypatch.setattr(H, "BLOCK_BYTES", 8 * 20 * 25)
    assert len(check(spark, vectors(random.Random(1), range(200), 20))) > 50


def test_edge_cases(spark):
    rnd = random.Random(2)
    rows = vectors(rnd, range(120), 9) + [(1000 + i, 1, [0.5] * 9) for i in range(60)]  # one very common vector
    rows += rows[:40]  # repeated rows
    rows += [(10, 2, [0.1] * 9), (10, 0, [0.2] * 9), (11, 1, [0.3] * 9)]  # ids with several rows
    rows += [(300, None, [1.0] * 9), (310, 1, None), (320, 1, [None] + [1.0] * 8), (330, 1, [math.nan] * 9), (340, 1, [math.inf] * 9), (None, 1, [1.0] * 9)]
    rows += [(400, 1, []), (401, 1, []), (402, 2, [])] + vectors(rnd, range(500, 540), 2)
    assert any(r[0] == 400 for r in check(spark, rows))


def test_wide_and_large_components(spark):
    rnd = random.Random(3)
    rows = vectors(rnd, range(30), 40) + [(i, i % 3, [rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(0, 22.4) for _ in range(4)]) for i in range(100, 160)]
    assert all(abs(r[4]) < 2**63 for r in brute(rows))
    check(spark, rows)
    huge = spark.createDataFrame([(i, i % 2, [1e300, -1e300], "x", 1, "y") for i in range(0, 40, 10)], SCHEMA)
    assert {r.negative_score for r in H.hard_negatives(huge, F.lit(True)).collect()} <= {H.LONG}


def test_empty_and_lonely(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    assert check(spark, [(10, 1, [1.0])]) == [] and check(spark, [(10, 1, [1.0]), (11, 2, [1.0])]) == []
    assert check(spark, [(10, 1, [-1.0]), (11, 1, [1.0]), (12, 2, [1.0])]) == []  # a negative positive score


def test_bounds_rule_rows_out_without_loss():
    """The bitmap shrinks before all columns are read, and scores are exact."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    v = np.floor(rng.normal(size=(3000, 64)) * np.linspace(100, 1, 64)).astype(np.int64)
    table = pa.table({"vec_id": np.arange(3000), "label": np.zeros(3000, np.int64), "v": pa.array(list(v))})
    block, seen = H.Block(table, 64), []

    def keep(low, high):
        seen.append(len(low))
        return high >= H.at_least(low, 5)

    at, score = block.scan(v[7], np.ones(3000, bool), keep)
    exact = v @ v[7]
    assert (score == exact[at]).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(at)
    assert seen[0] == 3000 and seen[-1] < 300
    best, top = H.best_of(block, v[7], np.ones(3000, bool), 5)
    assert best.tolist() == np.argsort(-exact, kind="stable")[:5].tolist() and top.tolist() == exact[best].tolist()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_equals_sql(spark, "op13_hard_negatives", f"/root/testdata/{sf}", ["embeddings"])
