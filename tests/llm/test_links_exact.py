"""Links of vectors with few intrinsic dimensions: none is missed."""

import numpy as np
import pytest

from quirestone.llm import product_quantisation as PQ


@pytest.mark.parametrize(("d", "inner", "n"), [(64, 3, 900), (256, 3, 700), (256, 8, 700), (16, 16, 900)])
def test_no_link_is_missed(spark, d, inner, n):
    rng = np.random.default_rng(d + inner)
    x = (rng.normal(size=(n, inner)) @ rng.normal(size=(inner, d)) + 0.02 * rng.normal(size=(n, d))).astype(np.float32)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    want = (u @ u.T >= 0.95).sum(1) - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    got = {r["vec_id"]: r["n_links"] for r in PQ.linked(rows, lists=24).collect()}
    assert [got[i] for i in range(n)] == want.tolist()
    assert want.sum() > 0 or inner == 16
