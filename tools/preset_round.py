"""One averaging round of a preset at its smallest input (16 random 8-bit
images, 2 workers, batch 4, averaging every 2 batches), timed.

usage: python tools/preset_round.py [AlexNet|LeNet|VGGNet] [float32|float64]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402

from tessera.operators.batching import batch_assign  # noqa: E402
from tessera.plans.models import n_params, preset, smallest_side  # noqa: E402
from tessera.plans.training import new_model, run_round  # noqa: E402
from tessera.session import build_session  # noqa: E402

spark = build_session("local[4]")
name = sys.argv[1] if len(sys.argv) > 1 else "AlexNet"
side = smallest_side(preset(name))
spec = preset(name, channels=3, height=side, width=side, num_labels=3).with_scale(1/255)
if len(sys.argv) > 2:  # default: the preset's own compute type (float32)
    spec = spec.with_dtype(sys.argv[2])
dtype = spec.dtype
print(name, "input", side, dtype)
print("params", n_params(spec))
rng = np.random.default_rng(0)
rows = [(i, int(i % 3), rng.integers(0, 256, side * side * 3, dtype=np.uint8).tobytes()) for i in range(16)]
df = spark.createDataFrame(rows, "rn long, label_idx int, features binary")
df = batch_assign(df.withColumn("rn", df.rn + 1), "rn", 4, workers=2, averaging_frequency=2)
m0 = new_model(spec)
t = time.time()
m1, metrics = run_round(spec, m0, df, with_metrics=True)
print("round seconds", round(time.time() - t, 1), "step", m1.step, "metrics", len(metrics))
print("changed", {k: bool(np.abs(m1.params[k] - m0.params[k]).max() > 0) for k in ["cnn1.W", "output.W", "output.b"]})
print("state keys", len(m1.state), "finite", all(np.isfinite(v).all() for v in m1.params.values()))
