"""Windows with context against the rule in NumPy, trailing windows and several channels included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import inference


def by_rule(x: np.ndarray, window: int, overlap: int, context: int, predict, skip: np.ndarray | None = None) -> dict:
    """(channels, H, W) raster: pad each window's slice by itself, predict, add up, divide."""
    _, h, w = x.shape
    stride, side = window - overlap, window + 2 * context
    total, n = {}, {}
    for i in range(-(-h // stride)):
        for j in range(-(-w // stride)):
            if skip is not None and not skip[i * stride : i * stride + window, j * stride : j * stride + window].any():
                continue
            top, left = i * stride - context, j * stride - context
            part = x[:, max(top, 0) : top + side, max(left, 0) : left + side]
            lack = [(max(-top, 0), max(top + side - h, 0)), (max(-left, 0), max(left + side - w, 0))]
            fits = all(part.shape[k + 1] > max(lack[k]) for k in (0, 1))
            out = predict(np.pad(part, [(0, 0), *lack], mode="reflect" if fits else "edge")[None])[0]
            for r in range(i * stride, min(i * stride + window, h)):
                for c in range(j * stride, min(j * stride + window, w)):
                    total[r, c] = total.get((r, c), 0) + out[:, r - top, c - left]
                    n[r, c] = n.get((r, c), 0) + 1
    return {k: total[k] / n[k] for k in total}


#: A lambda travels to workers by value; they cannot import this module.
blur = lambda x: sum(np.roll(x, (i, j), (-2, -1)) for i in (-1, 0, 1) for j in (-1, 0, 1)) / 9


@pytest.mark.parametrize("shape, window, overlap, context", [((5, 5), 4, 2, 1), ((7, 6), 3, 0, 2), ((5, 9), 4, 3, 0), ((4, 4), 8, 4, 2), ((11, 3), 5, 2, 3)])
def test_every_cell_is_as_the_rule_has_it(spark, shape, window, overlap, context):
    x = np.random.default_rng(1).normal(size=(1, *shape))
    grid = spark.createDataFrame([("s", r, c, float(x[0, r, c])) for r in range(shape[0]) for c in range(shape[1])], "scene string, r int, c int, v double")
    got = {(r.r, r.c): r.v for r in inference.windowed(grid, ["scene"], *shape, window, overlap, blur, context, batch=3).collect()}
    want = by_rule(x, window, overlap, context, blur)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k][0]) < 1e-9 for k in want)


def test_channels_two_scenes_and_windows_left_out(spark):
    rng = np.random.default_rng(2)
    x, skip = rng.normal(size=(2, 3, 9, 8)), np.zeros((9, 8), bool)
    skip[1, 6] = skip[8, 0] = True
    rows = [(s, r, c, x[s, :, r, c].tolist(), bool(skip[r, c])) for s in range(2) for r in range(9) for c in range(8)]
    grid = spark.createDataFrame(rows, "scene int, r int, c int, v array<double>, cloudy boolean").repartition(5)
    mix = lambda v: np.stack([v.sum(1), v[:, 0] * 2], 1)
    got = inference.windowed(grid, ["scene"], 9, 8, 4, 1, mix, 1, only_where="cloudy").collect()
    for s in range(2):
        want = by_rule(x[s], 4, 1, 1, mix, skip)
        mine = {(r.r, r.c): r.v for r in got if r.scene == s}
        assert mine.keys() == want.keys() and len(mine) < 72 and all(np.allclose(mine[k], want[k]) for k in want)


def test_mask_and_height_models_over_tiles(spark):
    """Probabilities by softmax over the channels, as a segmentation model gives them, then the share of the cloud classes; and a
    model of heights that counts nothing outside the mask."""
    x = np.random.default_rng(3).normal(size=(4, 6, 6))
    grid = spark.createDataFrame([(0, r, c, x[:, r, c].tolist()) for r in range(6) for c in range(6)], "scene int, r int, c int, v array<double>")
    softmax = lambda v: np.exp(v) / np.exp(v).sum(1, keepdims=True)
    got = inference.windowed(grid, ["scene"], 6, 6, 4, 2, softmax).withColumn("cloud", F.get("v", F.lit(1)) + F.get("v", F.lit(2)))
    want = softmax(x[None])[0]
    assert all(abs(r.cloud - want[1:3, r.r, r.c].sum()) < 1e-9 for r in got.collect())
    with pytest.raises(ValueError, match="less than the window"):
        inference.windowed(grid, ["scene"], 6, 6, 4, 4, softmax)


def test_attention_over_bags_against_loops(spark):
    """Pixel by pixel and head by head, without a matrix product over a bag."""
    from stratiform.plans import queries as plans

    w, heads = plans.bag_weights(), 4
    lin = lambda n, x: np.array([sum(x[i] * w[f"{n}.w"][i, j] for i in range(len(x))) + w[f"{n}.b"][j] for j in range(w[f"{n}.w"].shape[1])])
    norm = lambda n, x: (x - x.mean()) / np.sqrt(x.var() + 1e-5) * w[f"{n}.scale"] + w[f"{n}.shift"]
    act = lambda x: np.maximum(x, 0) + 0.01 * np.minimum(x, 0)
    step = lambda n, x: norm(n, act(lin(n, x)))
    bag = np.random.default_rng(6).normal(size=(5, 3))
    xs = [step("enc1", step("enc0", p)) for p in bag]
    for k in range(2):
        q, keys, v = ([lin(f"att{k}.{part}", x) for x in xs] for part in "qkv")
        out = []
        for i in range(5):
            mixed = np.zeros(16)
            for h in range(heads):
                at = slice(4 * h, 4 * h + 4)
                e = np.exp([q[i][at] @ keys[j][at] / 2 for j in range(5)])
                mixed[at] = sum(e[j] / e.sum() * v[j][at] for j in range(5))
            out.append(norm(f"att{k}.norm", xs[i] + lin(f"att{k}.o", mixed)))
        xs = [norm(f"ffn{k}.norm", x + lin(f"ffn{k}.1", act(lin(f"ffn{k}.0", x)))) for x in out]
    shading = [lin("shade1", step("shade0", x))[0] for x in xs]
    whole = np.tanh(lin("glob1", step("glob0", step("pool", np.mean(xs, 0)))))
    df = spark.createDataFrame([(1, bag.tolist()), (2, bag[:2].tolist()), (3, []), (4, bag[::-1].tolist())], "id int, pixels array<array<double>>")
    got = {r.id: r for r in inference.inverted_bags(df, ["id"], inference.attention_over_bags(w, heads, 2)).collect()}
    assert np.allclose(got[1].shading, shading) and np.allclose(got[1].properties, whole) and np.allclose(got[4].shading, shading[::-1])
    assert len(got[2].shading) == 2 and got[3].shading is None


def test_predictions_of_cells_that_the_grid_has(spark):
    rows = [(1, r, c, float(r * 6 + c)) for r in range(6) for c in range(6) if r < 3]
    grid = spark.createDataFrame(rows, "scene int, r int, c int, v double")
    twice = lambda x: x * 2
    got = inference.windowed(grid, ["scene"], 6, 6, 4, 2, twice, context=1, known_only=True).collect()
    assert sorted((r.scene, r.r, r.c, r.v / 2) for r in got) == rows
    assert inference.windowed(grid, ["scene"], 6, 6, 4, 2, twice, context=1).count() > len(rows)
