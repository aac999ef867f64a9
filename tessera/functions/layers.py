"""Layer maths on whole Arrow batches, run inside executor closures.

Tensors are NCHW float arrays; convolution is cross-correlation with weights
``[out, in, kh, kw]``; dense weights are ``[out, in]``. Each forward returns
the output and a cache for its backward.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def out_side(n: int, k: int, s: int, p: int) -> int:
    """Output side of a conv / pool: floor((n + 2p - k) / s) + 1."""
    return (n + 2 * p - k) // s + 1


def _windows(x, kh, kw, sh, sw):
    v = sliding_window_view(x, (kh, kw), axis=(2, 3))  # N,C,H-kh+1,W-kw+1,kh,kw
    return v[:, :, ::sh, ::sw]


# ---- convolution -----------------------------------------------------------

def conv2d_forward(x, w, b, stride=(1, 1), pad=(0, 0)):
    n, c, h, wd = x.shape
    o, ci, kh, kw = w.shape
    if ci != c:
        raise ValueError(f"conv expects {ci} input channels, got {c}")
    sh, sw = stride
    ph, pw = pad
    oh, ow = out_side(h, kh, sh, ph), out_side(wd, kw, sw, pw)
    xp = np.pad(x, ((0, 0), (0, 0), (ph, ph), (pw, pw))) if ph or pw else x
    win = _windows(xp, kh, kw, sh, sw)[:, :, :oh, :ow]
    cols = win.transpose(0, 2, 3, 1, 4, 5).reshape(n * oh * ow, c * kh * kw)
    out = cols @ w.reshape(o, -1).T + b
    y = out.reshape(n, oh, ow, o).transpose(0, 3, 1, 2)
    return np.ascontiguousarray(y), (xp.shape, cols, w, stride, pad, (oh, ow))


def conv2d_backward(dy, cache):
    xp_shape, cols, w, (sh, sw), (ph, pw), (oh, ow) = cache
    n = dy.shape[0]
    o, c, kh, kw = w.shape
    d = dy.transpose(0, 2, 3, 1).reshape(n * oh * ow, o)
    dw = (d.T @ cols).reshape(w.shape)
    db = d.sum(axis=0)
    dcols = (d @ w.reshape(o, -1)).reshape(n, oh, ow, c, kh, kw)
    dxp = np.zeros(xp_shape, dtype=dy.dtype)
    for i in range(kh):
        for j in range(kw):
            dxp[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw] += dcols[:, :, :, :, i, j].transpose(0, 3, 1, 2)
    h, wd = xp_shape[2] - 2 * ph, xp_shape[3] - 2 * pw
    return dxp[:, :, ph:ph + h, pw:pw + wd], dw, db


# ---- max pooling -----------------------------------------------------------

def maxpool_forward(x, kernel=(2, 2), stride=(2, 2)):
    kh, kw = kernel
    sh, sw = stride
    oh, ow = out_side(x.shape[2], kh, sh, 0), out_side(x.shape[3], kw, sw, 0)
    y = _windows(x, kh, kw, sh, sw)[:, :, :oh, :ow].max(axis=(4, 5))
    return y, (x, y, kernel, stride)


def maxpool_backward(dy, cache):
    x, y, (kh, kw), (sh, sw) = cache
    oh, ow = y.shape[2], y.shape[3]
    dx = np.zeros_like(x)
    taken = np.zeros(y.shape, dtype=bool)  # the first maximum of a window gets the gradient
    for i in range(kh):
        for j in range(kw):
            xs = x[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw]
            hit = (xs == y) & ~taken
            dx[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw] += np.where(hit, dy, 0)
            taken |= hit
    return dx


# ---- local response normalisation (across channels) ------------------------

# Library defaults assumed for LRN.
LRN_K, LRN_N, LRN_ALPHA, LRN_BETA = 2.0, 5, 1e-4, 0.75


def _channel_window_sum(a, n):
    half = n // 2
    c = a.shape[1]
    cs = np.cumsum(np.pad(a, ((0, 0), (half + 1, half), (0, 0), (0, 0))), axis=1)
    return cs[:, n:n + c] - cs[:, 0:c]


def lrn_forward(x, k=LRN_K, n=LRN_N, alpha=LRN_ALPHA, beta=LRN_BETA):
    scale = k + alpha * _channel_window_sum(x * x, n)
    y = x * scale ** (-beta)
    return y, (x, scale, k, n, alpha, beta)


def lrn_backward(dy, cache):
    x, scale, k, n, alpha, beta = cache
    inner = _channel_window_sum(dy * x * scale ** (-beta - 1), n)
    return dy * scale ** (-beta) - 2 * alpha * beta * x * inner


# ---- dense, activations, output --------------------------------------------

def dense_forward(x, w, b):
    return x @ w.T + b, x


def dense_backward(dy, x, w):
    return dy @ w, dy.T @ x, dy.sum(axis=0)


def relu_forward(x):
    return np.maximum(x, 0)


def relu_backward(dy, y):
    return dy * (y > 0)


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def nll_loss(p, y, eps=1e-15):
    """Mean negative log-likelihood of the true classes ``y``."""
    return float(-np.log(np.maximum(p[np.arange(len(y)), y], eps)).mean())


def softmax_nll_backward(p, y, mean=True):
    d = p.copy()
    d[np.arange(len(y)), y] -= 1.0
    return d / len(y) if mean else d


# Fixed values of the counter-based draws: a prime modulus and two multipliers.
DRAW_MODULUS, DRAW_STEP, DRAW_MIX = 2 ** 31 - 1, 48271, 69621


class Draws:
    """Uniform numbers in [0, 1) that are a pure function of counters, such as (seed, epoch,
    round, worker, batch), of how often ``random`` was called, and of the place in its result.
    Plain integer arithmetic, so that SQL can draw the same numbers. Stands in for a NumPy
    generator."""

    def __init__(self, *counters: int):
        self.key, self.calls = 0, 0
        for c in counters:
            self.key = (self.key * DRAW_STEP + int(c) + 1) % DRAW_MODULUS

    def random(self, shape) -> np.ndarray:
        key = (self.key * DRAW_STEP + self.calls + 1) % DRAW_MODULUS
        self.calls += 1
        at = np.arange(int(np.prod(shape)), dtype=np.int64)
        x = (key * DRAW_STEP + at + 1) % DRAW_MODULUS
        x = x * x % DRAW_MODULUS
        x = (x * DRAW_MIX + at + 1) % DRAW_MODULUS
        return (x * x % DRAW_MODULUS / DRAW_MODULUS).reshape(shape)


def dropout_mask(shape, keep, rng, dtype=np.float64):
    """Inverted dropout: kept units are scaled by 1/keep (in the activations' type)."""
    dt = np.dtype(dtype)
    return (rng.random(shape) < keep).astype(dt) / dt.type(keep)
