"""Block kernels against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from skyloom.operators import kernels


@pytest.mark.parametrize(("width", "height", "block"), [(20, 14, 8), (7, 9, 16), (16, 16, 4)])
def test_fourier_is_numpys(spark, width, height, block):
    rng = np.random.default_rng(1)
    images = rng.normal(size=(2, height, width))
    images[1, 3, 2] = 0.0
    rows = [(f, x, y, float(images[f, y, x])) for f in range(2) for y in range(height) for x in range(width) if not (f == 1 and (y, x) == (3, 2))] + [(1, 2, 3, None), (1, width, 0, 5.0)]
    got = kernels.fourier(spark.createDataFrame(rows, "f int, x int, y int, value double").repartition(3), ["f"], width, height, block).collect()
    assert len(got) == 2 * width * height
    want = np.fft.fft2(images)
    assert all(r.re == pytest.approx(want[r.f, r.v, r.u].real, abs=1e-9) and r.im == pytest.approx(want[r.f, r.v, r.u].imag, abs=1e-9) for r in got)


def test_sparse_products_are_numpys(spark):
    rng = np.random.default_rng(2)
    a = np.where(rng.random((30, 50)) < 0.2, rng.normal(size=(30, 50)), 0.0)
    v = rng.normal(size=50)
    entries = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a), strict=True)] + [(3, 77, 4.0)]
    vector = [(j, float(x)) for j, x in enumerate(v) if j != 9] + [(9, None), (4, float(v[4]) - 1)]
    v[9] = 0
    got = {r.row: r.value for r in kernels.sparse_product(spark.createDataFrame(entries, "row long, col long, value double").repartition(3), spark.createDataFrame(vector, "i long, value double"), block=8).collect()}
    assert all(got[i] == pytest.approx((a @ v)[i], abs=1e-12) for i in got) and set(got) == {i for i, _, _ in entries}
