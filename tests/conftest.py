import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from embedflow.session import get_spark

    s = get_spark(cores=4, shuffle_partitions=8)
    yield s
    s.stop()


def make_records(spark, n=50, dim=32, seed=0, prefix="v", namespace=None, unit=True):
    """Seeded Gaussian records (unit length by default) as a canonical DataFrame."""
    rng = np.random.default_rng(seed)
    vecs = rng.standard_normal((n, dim)).astype(np.float32)
    if unit:
        vecs /= np.linalg.norm(vecs, axis=1, keepdims=True) + 1e-9
    rows = [(f"{prefix}{i:04d}", [float(x) for x in vecs[i]], {"n": str(i)}, namespace) for i in range(n)]
    from embedflow.schema import CANONICAL

    return spark.createDataFrame(rows, CANONICAL), vecs


@pytest.fixture
def records(spark):
    return make_records(spark, 200, 64, 42, prefix="vec_")
