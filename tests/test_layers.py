"""Finite-difference checks of every layer gradient and of a whole net."""

import numpy as np
import pytest

from tessera.functions import layers as L
from tessera.plans.models import LRN, Conv, Dense, NetSpec, Output, Pool, Rules, backward, forward, init_params


def _num_grad(f, x, eps=1e-6):
    g = np.zeros_like(x)
    it = np.nditer(x, flags=["multi_index"])
    for _ in it:
        i = it.multi_index
        old = x[i]
        x[i] = old + eps
        a = f()
        x[i] = old - eps
        b = f()
        x[i] = old
        g[i] = (a - b) / (2 * eps)
    return g


def test_conv_gradients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2, 2, 7, 6))
    w = rng.normal(size=(3, 2, 3, 2))
    b = rng.normal(size=3)
    dy = rng.normal(size=L.conv2d_forward(x, w, b, (2, 1), (1, 0))[0].shape)

    def loss():
        return float((L.conv2d_forward(x, w, b, (2, 1), (1, 0))[0] * dy).sum())

    _, cache = L.conv2d_forward(x, w, b, (2, 1), (1, 0))
    dx, dw, db = L.conv2d_backward(dy, cache)
    assert np.allclose(dx, _num_grad(loss, x), atol=1e-5)
    assert np.allclose(dw, _num_grad(loss, w), atol=1e-5)
    assert np.allclose(db, _num_grad(loss, b), atol=1e-5)


def test_conv_matches_direct_sum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1, 1, 5, 5))
    w = rng.normal(size=(1, 1, 3, 3))
    y = L.conv2d_forward(x, w, np.zeros(1), (1, 1), (0, 0))[0]
    assert np.isclose(y[0, 0, 1, 2], (x[0, 0, 1:4, 2:5] * w[0, 0]).sum())


def test_pool_gradients():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2, 3, 7, 7))
    dy = rng.normal(size=L.maxpool_forward(x, (3, 3), (2, 2))[0].shape)
    _, cache = L.maxpool_forward(x, (3, 3), (2, 2))

    def loss():
        return float((L.maxpool_forward(x, (3, 3), (2, 2))[0] * dy).sum())

    assert np.allclose(L.maxpool_backward(dy, cache), _num_grad(loss, x), atol=1e-5)


def test_lrn_gradients():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2, 7, 2, 2)) * 30  # large enough that the scale matters
    dy = rng.normal(size=x.shape)
    _, cache = L.lrn_forward(x)

    def loss():
        return float((L.lrn_forward(x)[0] * dy).sum())

    assert np.allclose(L.lrn_backward(dy, cache), _num_grad(loss, x), atol=1e-5)


def test_lrn_window_sum():
    x = np.arange(1, 8, dtype=float).reshape(1, 7, 1, 1)
    s = L._channel_window_sum(x * x, 5)[0, :, 0, 0]
    sq = (np.arange(1, 8) ** 2).astype(float)
    assert np.allclose(s, [sq[max(0, c - 2):c + 3].sum() for c in range(7)])


@pytest.mark.parametrize("mini_batch", [True, False])
def test_whole_net_gradients(mini_batch):
    spec = NetSpec("tiny", (1, 8, 8), (
        Conv("c1", 2, (3, 3), (1, 1), (1, 1), 0.1),
        Pool("p1", (2, 2)),
        LRN("n1"),
        Dense("d1", 5, 0.1),
        Output("out", 3),
    ), Rules(init="xavier", mini_batch=mini_batch), seed=7)
    params = init_params(spec)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4, 1, 8, 8))
    y = np.array([0, 2, 1, 2])
    p, caches = forward(spec, params, x)
    grads = backward(spec, params, caches, p, y)
    scale = len(y) if not mini_batch else 1.0
    for name in ["c1.W", "c1.b", "d1.W", "out.W", "out.b"]:
        def loss():
            return L.nll_loss(forward(spec, params, x)[0], y) * scale
        assert np.allclose(grads[name], _num_grad(loss, params[name]), atol=1e-5), name


def test_softmax_rows_sum_to_one():
    z = np.array([[1000.0, 1000.0, -5.0], [0.0, 1.0, 2.0]])
    p = L.softmax(z)
    assert np.allclose(p.sum(axis=1), 1.0)
    assert p[0].argmax() == 0  # first maximum wins


def test_counter_draws_are_uniform_and_repeatable():
    from tessera.functions.layers import Draws
    a, b = Draws(42, 0, 3, 1, 7), Draws(42, 0, 3, 1, 7)
    first = a.random((18, 64))
    assert np.array_equal(first, b.random((18, 64)))
    second = a.random((18, 64))  # the next call draws anew
    other = Draws(42, 0, 3, 1, 8).random((18, 64))
    for x, y in ((first, second), (first, other)):
        assert abs(np.corrcoef(x.ravel(), y.ravel())[0, 1]) < 0.1
    many = np.concatenate([Draws(1, e, r, w, 0).random(500) for e in range(4) for r in range(5) for w in range(5)])
    assert 0 <= many.min() and many.max() < 1 and sum((n - len(many) / 20) ** 2 / (len(many) / 20) for n in np.histogram(many, 20, (0, 1))[0]) < 45
    assert abs(np.corrcoef(many[:-1], many[1:])[0, 1]) < 0.02


def test_dropout_layer_gradient():
    from dataclasses import replace

    from tessera.functions.layers import Draws, nll_loss
    from tessera.plans.models import Dense, Dropout, NetSpec, Output, Rules, backward, forward, init_params
    spec = NetSpec("d", (6,), (Dropout("drop", 0.4), Dense("h", 5), Dropout("drop2", 0.3), Output("out", 3)), Rules(init="xavier"))
    params = init_params(spec)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(7, 6)), rng.integers(0, 3, 7)

    def loss(p):
        return nll_loss(forward(spec, p, x, train=True, rng=Draws(1, 2))[0], y)

    out, caches = forward(spec, params, x, train=True, rng=Draws(1, 2))
    grads = backward(spec, params, caches, out, y)
    for k, g in grads.items():
        for at in list(np.ndindex(g.shape))[:6]:
            up, down = ({**params, k: params[k].copy()} for _ in range(2))
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - g[at]) < 1e-6
    assert (forward(spec, params, x)[0] != out).any()  # off in scoring
    plain = replace(spec, layers=tuple(ly for ly in spec.layers if not isinstance(ly, Dropout)))
    assert np.allclose(forward(spec, params, x)[0], forward(plain, params, x)[0])
