"""Formula weights: fixed, closed-form parameters that make every forward
pass over the given tables writable in plain SQL (the oracle side).

Fixed values (our own choice, used identically by the Spark queries and
their SQL oracles):
  dense weight  w[k][i] = ((k*7 + i*3) % 11 - 5) / 10
  dense bias    b[k]    = ((k*5) % 7 - 3) / 10
  conv kernel   w[o][dy][dx] = ((o*5 + dy*3 + dx) % 7 - 3) / 10, one input channel
  conv bias     b[o]    = o / 10
  learning rate of the closed-form training checks: 0.5
"""

from __future__ import annotations

import numpy as np

TRAIN_LR = 0.5
N_CLASSES = 10
SIDE = 8  # embeddings are read as 8x8x1


def dense_weights(n_out: int = N_CLASSES, n_in: int = SIDE * SIDE):
    k = np.arange(n_out)[:, None]
    i = np.arange(n_in)[None, :]
    w = ((k * 7 + i * 3) % 11 - 5) / 10.0
    b = ((np.arange(n_out) * 5) % 7 - 3) / 10.0
    return w.astype(np.float64), b.astype(np.float64)


def conv_kernel(n_out: int = 2, kh: int = 3, kw: int = 3):
    o = np.arange(n_out)[:, None, None]
    dy = np.arange(kh)[None, :, None]
    dx = np.arange(kw)[None, None, :]
    w = ((o * 5 + dy * 3 + dx) % 7 - 3) / 10.0
    return w[:, None, :, :].astype(np.float64), (np.arange(n_out) / 10.0)
