"""Warps of every order against splines solved as dense systems of equations in NumPy."""

import math

import numpy as np
import pytest

from stratiform.operators import warp


def spline_value(x: np.ndarray, order: int, at: float) -> np.ndarray:
    """Rows of x at one place: edges repeated far out, the spline's coefficients from its equations at all cells."""
    far = 40
    wide = np.pad(x, ((0, 0), (far, far)), mode="edge")
    n = wide.shape[1]

    def bump(t):  # by the recursion of splines in their order
        def b(k, u):
            if k == 0:
                return 1.0 if -0.5 <= u < 0.5 else 0.0
            return ((k + 1) / 2 + u) / k * b(k - 1, u + 0.5) + ((k + 1) / 2 - u) / k * b(k - 1, u - 0.5)

        return b(order, t)

    band = {d: bump(float(d)) for d in range(-3, 4)}
    system = np.array([[band.get(i - j, 0.0) for j in range(n)] for i in range(n)])
    c = np.linalg.solve(system, wide.T).T
    return sum(c[:, j] * bump(at + far - j) for j in range(n) if abs(at + far - j) < 4)


@pytest.mark.parametrize("order", [2, 3, 4, 5])
def test_splines(spark, order):
    rng = np.random.default_rng(order)
    h, w = 9, 70  # more columns than a tile has
    x = rng.normal(size=(2, h, w))
    moves = [(s, int(r), int(c), float(dr), float(dc)) for s in range(2) for r, c, dr, dc in zip(rng.integers(0, h, 40), rng.permutation(w)[:40], rng.normal(0, 3, 40), rng.normal(0, 20, 40), strict=True)]
    moves += [(0, 0, 69, -500.0, 900.0), (1, 8, 0, None, float("nan"))]
    moves = list({m[:3]: m for m in moves}.values())
    grid = spark.createDataFrame([(s, r, c, float(x[s, r, c])) for s in range(2) for r in range(h) for c in range(w)], "scene int, r int, c int, v double").repartition(3)
    got = {(r.scene, r.r, r.c): r.v for r in warp.warped(grid, spark.createDataFrame(moves, "scene int, r int, c int, dr double, dc double"), ["scene"], h, w, order).collect()}
    assert len(got) == len(moves)
    for s, r, c, dr, dc in moves:
        y, z = (a + (d if d is not None and math.isfinite(d) else 0.0) for a, d in ((r, dr), (c, dc)))
        y, z = min(max(y, -24.0), h + 23.0), min(max(z, -24.0), w + 23.0)
        want = spline_value(spline_value(x[s], order, z)[None], order, y)[0]
        assert abs(got[s, r, c] - want) < 1e-6, (s, r, c)
    assert abs(got[1, 8, 0] - x[1, 8, 0]) < 1e-9


def test_low_orders_and_whole_numbers(spark):
    grid = spark.createDataFrame([(0, r, c, 10.0 * r - 7 * c) for r in range(4) for c in range(5)], "scene int, r int, c int, v double")
    moves = spark.createDataFrame([(0, 1, 1, 0.4, 0.6), (0, 2, 2, 5.0, -9.0), (0, 3, 3, float("nan"), None)], "scene int, r int, c int, dr double, dc double")
    run = lambda order, cast=False: {(r.r, r.c): r.v for r in warp.warped(grid, moves, ["scene"], 4, 5, order, cast).collect()}
    assert run(0) == {(1, 1): -4.0, (2, 2): 30.0, (3, 3): 9.0}
    assert {k: round(v, 9) for k, v in run(1).items()} == {(1, 1): 2.8, (2, 2): 30.0, (3, 3): 9.0}
    assert run(1, True)[1, 1] == 2.0
    with pytest.raises(ValueError):
        run(6)
    empty = grid.limit(0)
    assert warp.warped(empty, moves.limit(0), ["scene"], 4, 5, 3).count() == 0
