"""Network specifications: layer lists, training rules, shape inference,
parameter initialisation and the forward / backward pass of a whole net.

A spec is plain data, made on the driver and shipped inside closures; the
parameters are a ``dict[str, np.ndarray]`` shipped as a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np

from tessera.functions import layers as L


@dataclass(frozen=True)
class Conv:
    name: str
    out: int
    kernel: tuple = (3, 3)
    stride: tuple = (1, 1)
    pad: tuple = (0, 0)
    bias: float = 0.0
    std: float | None = None  # None: the net's default initialisation


@dataclass(frozen=True)
class Pool:
    name: str
    kernel: tuple = (2, 2)
    stride: tuple = (2, 2)


@dataclass(frozen=True)
class LRN:
    name: str
    k: float = L.LRN_K
    n: int = L.LRN_N
    alpha: float = L.LRN_ALPHA
    beta: float = L.LRN_BETA


@dataclass(frozen=True)
class Dense:
    name: str
    out: int
    bias: float = 0.0
    dropout: float = 0.0  # probability of dropping a unit in training
    std: float | None = None


@dataclass(frozen=True)
class Dropout:
    name: str
    rate: float = 0.5  # probability of dropping an input in training


@dataclass(frozen=True)
class Output:
    name: str
    out: int
    bias: float = 0.0
    std: float | None = None


@dataclass(frozen=True)
class Rules:
    updater: str = "sgd"           # sgd | rmsprop | nesterovs
    lr: float = 0.1
    bias_lr: float | None = None
    momentum: float = 0.0
    rms_decay: float = 0.95
    l2: float = 0.0                # applied to weights only
    regularization: bool = True    # False: l2 is configured but not applied
    grad_norm: str | None = None   # None | 'l2_per_layer'
    mini_batch: bool = True        # False: gradient is the batch sum, not the mean
    lr_decay: float | None = None  # step policy: lr * decay ** (step // steps)
    lr_steps: int | None = None
    iterations: int = 1
    init: str = "normal"           # normal | xavier
    init_std: float = 0.01


@dataclass(frozen=True)
class NetSpec:
    name: str
    input_shape: tuple             # (channels, height, width)
    layers: tuple
    rules: Rules = field(default_factory=Rules)
    seed: int = 42
    input_scale: float = 1.0       # applied to inputs in the closures (1/255 for 8-bit pixels)
    dtype: str = "float64"         # compute type in the closures; "float32" halves memory and BLAS time
    packed: str = "float32"        # type of inputs that come as bytes: "float32" or "uint8"

    def with_input(self, channels, height, width):
        return replace(self, input_shape=(channels, height, width))

    def with_scale(self, scale: float, packed: str = "uint8"):
        """Scaled inputs; byte inputs are 8-bit pixels unless ``packed`` says otherwise."""
        return replace(self, input_scale=scale, packed=packed)

    def with_dtype(self, dtype: str):
        return replace(self, dtype=dtype)


def batch_input(spec: NetSpec, values) -> np.ndarray:
    """Stack a column of examples into ``[N, *input_shape]`` doubles times
    ``input_scale``. Examples are float arrays or packed bytes of the type
    ``spec.packed``: 8-bit pixels (the compact form for images) or float32
    (see ``pack_float32``). Bytes of any other length are an error."""
    vals = list(values)
    if not vals:
        return np.zeros((0, *spec.input_shape))
    if isinstance(vals[0], (bytes, bytearray, memoryview)):
        size = int(np.prod(spec.input_shape)) * np.dtype(spec.packed).itemsize
        for v in vals:
            if len(v) != size:
                raise ValueError(f"a packed example of {len(v)} bytes is no {spec.packed} of shape {spec.input_shape}")
        x = np.frombuffer(b"".join(bytes(v) for v in vals), dtype=spec.packed).astype(np.float64)
    else:
        x = np.stack(vals).astype(np.float64)
    x = x.reshape(len(vals), *spec.input_shape).astype(spec.dtype, copy=False)
    return x * x.dtype.type(spec.input_scale) if spec.input_scale != 1.0 else x


def rule_warnings(spec: NetSpec) -> list[str]:
    """Settings that are configured but have no effect."""
    r = spec.rules
    out = []
    if r.updater != "nesterovs" and r.momentum:
        out.append(f"momentum {r.momentum} is set but only the nesterovs updater applies it")
    if r.l2 and not r.regularization:
        out.append(f"l2 {r.l2} is set but regularization is off")
    return out


def effective_l2(spec: NetSpec) -> float:
    return spec.rules.l2 if spec.rules.regularization else 0.0


# ---- shapes ----------------------------------------------------------------

def layer_shapes(spec: NetSpec):
    """Walk the layers: per layer (layer, input shape, output shape, param
    shapes). Spatial sides use floor division; a side below 1 is an error."""
    shape = tuple(spec.input_shape)
    rows = []
    for ly in spec.layers:
        c, h, w = shape if len(shape) == 3 else (None, None, None)
        if isinstance(ly, Conv):
            _need_spatial(ly, shape)
            oh = L.out_side(h, ly.kernel[0], ly.stride[0], ly.pad[0])
            ow = L.out_side(w, ly.kernel[1], ly.stride[1], ly.pad[1])
            out = (ly.out, oh, ow)
            params = {"W": (ly.out, c, *ly.kernel), "b": (ly.out,)}
        elif isinstance(ly, Pool):
            _need_spatial(ly, shape)
            out = (c, L.out_side(h, ly.kernel[0], ly.stride[0], 0), L.out_side(w, ly.kernel[1], ly.stride[1], 0))
            params = {}
        elif isinstance(ly, LRN):
            _need_spatial(ly, shape)
            out, params = shape, {}
        elif isinstance(ly, Dropout):
            out, params = shape, {}
        elif isinstance(ly, (Dense, Output)):
            n_in = int(np.prod(shape))
            out = (ly.out,)
            params = {"W": (ly.out, n_in), "b": (ly.out,)}
        else:
            raise TypeError(f"unknown layer {ly!r}")
        if min(out) < 1:
            raise ValueError(f"input {spec.input_shape} too small: layer {ly.name} gives {out}")
        rows.append((ly, shape, out, params))
        shape = out
    return rows


def _need_spatial(ly, shape):
    if len(shape) != 3:
        raise ValueError(f"layer {ly.name} needs a spatial input, got {shape}")


def n_params(spec: NetSpec) -> int:
    return sum(int(np.prod(s)) for _, _, _, ps in layer_shapes(spec) for s in ps.values())


def smallest_side(spec: NetSpec) -> int:
    """Smallest square input side the net accepts: from a last side of 1 back
    through every convolution and pooling layer."""
    need = [1, 1]
    for ly in reversed(spec.layers):
        if isinstance(ly, (Conv, Pool)):
            pad = ly.pad if isinstance(ly, Conv) else (0, 0)
            need = [max(1, (n - 1) * s + k - 2 * p) for n, k, s, p in zip(need, ly.kernel, ly.stride, pad)]
    return max(need)


# ---- parameters ------------------------------------------------------------

def init_params(spec: NetSpec) -> dict:
    """Seeded per (seed, layer index); biases constant."""
    params = {}
    r = spec.rules
    for idx, (ly, _, _, shapes) in enumerate(layer_shapes(spec)):
        if not shapes:
            continue
        rng = np.random.default_rng([spec.seed, idx])
        wshape = shapes["W"]
        if ly.std is not None:
            std = ly.std
        elif r.init == "xavier":
            fan_in = int(np.prod(wshape[1:]))
            fan_out = wshape[0] * (int(np.prod(wshape[2:])) if len(wshape) == 4 else 1)
            std = float(np.sqrt(2.0 / (fan_in + fan_out)))
        else:
            std = r.init_std
        params[f"{ly.name}.W"] = rng.normal(0.0, std, size=wshape).astype(spec.dtype)
        params[f"{ly.name}.b"] = np.full(shapes["b"], float(ly.bias), dtype=spec.dtype)
    return params


# ---- forward / backward ----------------------------------------------------

def forward(spec: NetSpec, params: dict, x: np.ndarray, train: bool = False, rng=None):
    """Class probabilities of a batch ``x`` shaped ``[N, C, H, W]`` (or
    ``[N, features]`` for dense-only nets), with the caches for backward."""
    a = x
    caches = []
    for ly in spec.layers:
        if isinstance(ly, Conv):
            z, cache = L.conv2d_forward(a, params[f"{ly.name}.W"], params[f"{ly.name}.b"], ly.stride, ly.pad)
            a = L.relu_forward(z)
            caches.append(("conv", cache, a))
        elif isinstance(ly, Pool):
            a, cache = L.maxpool_forward(a, ly.kernel, ly.stride)
            caches.append(("pool", cache, None))
        elif isinstance(ly, LRN):
            a, cache = L.lrn_forward(a, ly.k, ly.n, ly.alpha, ly.beta)
            caches.append(("lrn", cache, None))
        elif isinstance(ly, Dropout):
            mask = L.dropout_mask(a.shape, 1.0 - ly.rate, rng, a.dtype) if train and ly.rate > 0 else None
            a = a if mask is None else a * mask
            caches.append(("drop", mask, None))
        elif isinstance(ly, Dense):
            shape_in = a.shape
            z, xin = L.dense_forward(a.reshape(len(a), -1), params[f"{ly.name}.W"], params[f"{ly.name}.b"])
            a = L.relu_forward(z)
            mask = None
            if train and ly.dropout > 0:
                mask = L.dropout_mask(a.shape, 1.0 - ly.dropout, rng, a.dtype)
                a = a * mask
            caches.append(("dense", (xin, shape_in, mask), a))
        elif isinstance(ly, Output):
            shape_in = a.shape
            z, xin = L.dense_forward(a.reshape(len(a), -1), params[f"{ly.name}.W"], params[f"{ly.name}.b"])
            a = L.softmax(z)
            caches.append(("out", (xin, shape_in), a))
    return a, caches


SLICE_ROWS = 64  # rows per forward pass in scoring: bounds im2col memory for wide images


def predict(spec: NetSpec, params: dict, x: np.ndarray, rows: int = SLICE_ROWS) -> np.ndarray:
    """Class probabilities of any number of rows, ``rows`` at a time."""
    if len(x) <= rows:
        return forward(spec, params, x)[0]
    return np.concatenate([forward(spec, params, x[i:i + rows])[0] for i in range(0, len(x), rows)])


def backward(spec: NetSpec, params: dict, caches, p: np.ndarray, y: np.ndarray) -> dict:
    """Gradients of the NLL (mean over the batch, or sum when
    ``mini_batch`` is False) for every parameter."""
    grads = {}
    d = None
    for ly, (kind, cache, act) in zip(reversed(spec.layers), reversed(caches)):
        if kind == "out":
            xin, shape_in = cache
            dz = L.softmax_nll_backward(p, y, mean=spec.rules.mini_batch)
            d, grads[f"{ly.name}.W"], grads[f"{ly.name}.b"] = L.dense_backward(dz, xin, params[f"{ly.name}.W"])
            d = d.reshape(shape_in)
        elif kind == "dense":
            xin, shape_in, mask = cache
            d = d.reshape(act.shape)
            if mask is not None:
                d = d * mask
            dz = L.relu_backward(d, act)
            d, grads[f"{ly.name}.W"], grads[f"{ly.name}.b"] = L.dense_backward(dz, xin, params[f"{ly.name}.W"])
            d = d.reshape(shape_in)
        elif kind == "conv":
            dz = L.relu_backward(d, act)
            d, grads[f"{ly.name}.W"], grads[f"{ly.name}.b"] = L.conv2d_backward(dz, cache)
        elif kind == "pool":
            d = L.maxpool_backward(d, cache)
        elif kind == "lrn":
            d = L.lrn_backward(d, cache)
        elif kind == "drop" and cache is not None:
            d = d * cache
    return grads


# ---- the three presets -----------------------------------------------------
# The layer lists, initialisation, updaters and rates of the
# three presets below must equal the original job's configurations, in
# layer order as written there. They compute in float32, as the original did. Quirks kept: LeNet's second conv takes
# {5,5} as its stride; the second pool is named "maxool2"; VGGNet's conv
# inputs are inferred by shape.

def lenet(channels=3, height=100, width=100, num_labels=3, seed=42) -> NetSpec:
    layers = (
        Conv("cnn1", 50, (5, 5), (1, 1), (0, 0), 0.0),
        Pool("maxpool1", (2, 2)),
        # The {5,5} given to this layer is its stride, as in the original job.
        Conv("cnn2", 100, (5, 5), (5, 5), (1, 1), 0.0),
        Pool("maxool2", (2, 2)),
        Dense("dense", 500),
        Output("output", num_labels),
    )
    # l2 is set but regularisation is off, so it is not applied; momentum is
    # set but unused with RMSProp -- both as in the original configuration.
    rules = Rules(updater="rmsprop", lr=1e-4, momentum=0.9, rms_decay=0.95, l2=0.005, regularization=False,
                  init="xavier")
    return NetSpec("LeNet", (channels, height, width), layers, rules, seed, dtype="float32")


def alexnet(channels=3, height=100, width=100, num_labels=3, seed=42) -> NetSpec:
    layers = (
        Conv("cnn1", 96, (11, 11), (4, 4), (3, 3), 0.0),
        LRN("lrn1"),
        Pool("maxpool1", (3, 3)),
        Conv("cnn2", 256, (5, 5), (1, 1), (2, 2), 1.0),
        LRN("lrn2"),
        Pool("maxpool2", (3, 3)),
        Conv("cnn3", 384, (3, 3), (1, 1), (1, 1), 0.0),
        Conv("cnn4", 384, (3, 3), (1, 1), (1, 1), 1.0),
        Conv("cnn5", 256, (3, 3), (1, 1), (1, 1), 1.0),
        Pool("maxpool3", (3, 3)),
        Dense("ffn1", 4096, 1.0, 0.5, 0.005),
        Dense("ffn2", 4096, 1.0, 0.5, 0.005),
        Output("output", num_labels),
    )
    rules = Rules(updater="nesterovs", lr=1e-2, bias_lr=2e-2, momentum=0.9, l2=5e-4,
                  grad_norm="l2_per_layer", mini_batch=False, lr_decay=0.1, lr_steps=100000,
                  init="normal", init_std=0.01)
    return NetSpec("AlexNet", (channels, height, width), layers, rules, seed, dtype="float32")


def vggnet(channels=3, height=100, width=100, num_labels=3, seed=42) -> NetSpec:
    def c(name, out):
        return Conv(name, out, (3, 3), (1, 1), (1, 1), 0.0)
    layers = (
        c("cnn1", 64), Pool("maxpool1"),
        c("cnn2", 128), Pool("maxpool2"),
        c("cnn3", 256), c("cnn4", 256), Pool("maxpool3"),
        c("cnn5", 512), c("cnn6", 512), Pool("maxpool4"),
        c("cnn7", 512), c("cnn8", 512), Pool("maxpool5"),
        Dense("ffn1", 4096, 1.0, 0.5, 0.005),
        Dense("ffn2", 4096, 1.0, 0.5, 0.005),
        Output("output", num_labels),
    )
    # Score-based decay is named but no score policy is chosen: the rate stays constant.
    rules = Rules(updater="nesterovs", lr=1e-1, momentum=0.9, l2=5e-4, grad_norm="l2_per_layer",
                  init="normal", init_std=0.01)
    return NetSpec("VGGNet", (channels, height, width), layers, rules, seed, dtype="float32")


PRESETS = {"LeNet": lenet, "AlexNet": alexnet, "VGGNet": vggnet}


def preset(name: str, **kw) -> NetSpec:
    """Model choice by name; an unknown name fails before any job starts."""
    try:
        return PRESETS[name](**kw)
    except KeyError:
        raise ValueError(f"no preset named {name!r}; there are {sorted(PRESETS)}") from None


def model_summary_rows(spec: NetSpec):
    """Rows ``(model, layer, name, kind, out_c, out_h, out_w, params)``."""
    out = []
    for i, (ly, _, shape, ps) in enumerate(layer_shapes(spec)):
        c, h, w = shape if len(shape) == 3 else (shape[0], 1, 1)
        out.append((spec.name, i, ly.name, type(ly).__name__.lower(), c, h, w,
                    sum(int(np.prod(s)) for s in ps.values())))
    return out


def small_dense_net(n_in: int, n_out: int, hidden: int = 0, lr: float = 0.1,
                    updater: str = "sgd", seed: int = 42) -> NetSpec:
    """A dense net for tensors without spatial layout (and for tests)."""
    layers = ((Dense("hidden", hidden),) if hidden else ()) + (Output("output", n_out),)
    return NetSpec("Dense", (n_in,), layers, Rules(updater=updater, lr=lr, init="xavier"), seed)


# ---- spec as data (saved next to a model) ------------------------------------

LAYER_KINDS = {cls.__name__: cls for cls in (Conv, Pool, LRN, Dense, Dropout, Output)}


def spec_to_json(spec: NetSpec) -> str:
    """The spec as JSON: layer kind names plus their fields."""
    import json
    from dataclasses import asdict
    body = {k: v for k, v in asdict(spec).items() if k != "layers"}
    body["layers"] = [{"kind": type(ly).__name__, **asdict(ly)} for ly in spec.layers]
    return json.dumps(body)


def spec_from_json(text: str) -> NetSpec:
    import json

    def tup(v):
        return tuple(v) if isinstance(v, list) else v

    body = json.loads(text)
    layers = tuple(LAYER_KINDS[d.pop("kind")](**{k: tup(v) for k, v in d.items()}) for d in body.pop("layers"))
    rules = Rules(**body.pop("rules"))
    return NetSpec(body.pop("name"), tuple(body.pop("input_shape")), layers, rules, **body)
