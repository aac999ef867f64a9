"""DuckDB SQL of whole distributed training runs: softmax regression from zero
weights on the train split of ``embeddings``, in batches of 18, averaged over
workers every 5 batches without weights, as a recursive query whose steps are
the batches. One row of ``st`` is one parameter of one worker before step ``t``;
``i`` = 64 is the bias.
"""

from __future__ import annotations

KEY = "md5('42:' || CAST(vec_id AS VARCHAR))"

# Fixed values shared with ``tessera.plans.queries``: the epochs, rates and rules of each run.
UPDATES = {  # updater -> (new parameter, new updater state); g includes the L2 term
    "sgd": ("th - lr * g", "m"),
    "nesterovs": ("th - 0.9 * m + 1.9 * (0.9 * m - lr * g)", "0.9 * m - lr * g"),
    "rmsprop": ("th - lr * g / sqrt(0.95 * m + 0.05 * g * g + 1e-8)", "0.95 * m + 0.05 * g * g"),
}

# Train rows with their place: worker count by the row count, batch, worker, round, place in the round.
PLACED = f"""k0 AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY {KEY}, vec_id) AS rn, count(*) OVER () AS n FROM embeddings),
k1 AS (SELECT *, CAST(round(0.8 * n) AS BIGINT) AS nt FROM k0),
cfg AS (
  SELECT nt, nb, least(100000, greatest(2, CAST(ceil(nb / 100.0) AS BIGINT))) AS workers
  FROM (SELECT max(nt) AS nt, CAST(ceil(max(nt) / 18.0) AS BIGINT) AS nb FROM k1)),
bt AS (
  SELECT vec_id, label, embedding, b, pos, b % workers AS worker, b // (workers * 5) AS round, (b % (workers * 5)) // workers AS j
  FROM (SELECT *, (rn - 1) // 18 AS b, (rn - 1) % 18 AS pos FROM k1 WHERE rn <= nt), cfg)"""


def _masked(drop: float) -> str:
    """CTE ``xm``: each worker's inputs of a step, those dropped zero and the others scaled. The
    draws are those of ``layers.Draws`` with the counters (42, epoch, round, worker, batch)."""
    if not drop:
        return """xm AS (
      SELECT c.w, bt.vec_id, bt.label, xs.i, xs.v FROM (SELECT DISTINCT w, r, j FROM cur) c
      JOIN bt ON bt.round = c.r AND bt.j = c.j AND bt.worker = c.w JOIN xs USING (vec_id))"""
    m, keep = 2147483647, 1 - drop
    key = "CAST(43 AS BIGINT)"  # of the seed 42
    for c in ("t // (5 * rounds)", "c.r", "c.w", "bt.b", "0"):  # and the first call
        key = f"(({key} * 48271 + {c} + 1) % {m})"
    return f"""xk AS (
      SELECT c.w, bt.vec_id, bt.label, xs.i, xs.v, pos * 64 + xs.i AS place, {key} AS k
      FROM (SELECT DISTINCT t, w, r, j, rounds FROM cur) c
      JOIN bt ON bt.round = c.r AND bt.j = c.j AND bt.worker = c.w JOIN xs USING (vec_id)),
    x1 AS (SELECT *, (k * 48271 + place + 1) % {m} AS x FROM xk),
    x2 AS (SELECT * REPLACE ((x * x % {m} * 69621 + place + 1) % {m} AS x) FROM x1),
    xm AS (
      SELECT w, vec_id, label, i,
             CASE WHEN i = 64 THEN v WHEN CAST(x * x % {m} AS DOUBLE) / {m} < {keep} THEN v / {keep} ELSE 0 END AS v FROM x2)"""


def training(updater: str, lr: float, epochs: int, l2: float = 0.0, decay: float = 1.0, decay_steps: int = 1,
             bias_lr: float | None = None, normalised: bool = False, mean: bool = True, drop: float = 0.0, start: str = "0") -> str:
    """CTEs up to ``st`` (parameters before every step) and ``fin`` (after the last). ``normalised``: gradients
    of the layer have length 1; not ``mean``: gradients are the batch's sum; ``start``: the first parameters."""
    th, m = UPDATES[updater]
    rate = f"{lr}" if bias_lr is None else f"CASE WHEN i = 64 THEN {bias_lr} ELSE {lr} END"
    g = "sum(d * v) / max(size)" if mean else "sum(d * v)"
    if normalised:
        g = f"{g} / sqrt(sum(pow({g}, 2)) OVER (PARTITION BY w))"
    return f"""RECURSIVE {PLACED},
xs AS (
  SELECT vec_id, CAST(unnest(list_append(embedding, 1.0)) AS DOUBLE) AS v, unnest(range(65)) AS i FROM embeddings),
len AS (SELECT nb, workers, CAST(ceil(nb / (workers * 5.0)) AS BIGINT) AS rounds FROM cfg),
st AS (
  SELECT CAST(0 AS BIGINT) AS t, w.range AS w, k.range AS k, i.range AS i, CAST({start} AS DOUBLE) AS th, CAST(0 AS DOUBLE) AS m,
         CAST(0 AS BIGINT) AS n
  FROM len, range(10) k, range(65) i, range(100000) w WHERE w.range < len.workers
  UNION ALL
  SELECT t, w, k, i, th, m, n FROM (
    WITH cur AS (
      SELECT st.*, (t // 5) % rounds AS r, t % 5 AS j, nb, workers, rounds FROM st, len WHERE t < {epochs} * rounds * 5),
    {_masked(drop)},
    z AS (
      SELECT c.w, xm.vec_id, xm.label, c.k, sum(c.th * xm.v) AS z FROM cur c JOIN xm ON xm.w = c.w AND xm.i = c.i GROUP BY ALL),
    e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
    d AS (
      SELECT w, vec_id, k, e / sum(e) OVER (PARTITION BY vec_id) - CASE WHEN k = label THEN 1 ELSE 0 END AS d,
             count(*) OVER (PARTITION BY w, k) AS size FROM e),
    g AS (SELECT w, k, i, {g} AS g FROM d JOIN xm USING (w, vec_id) GROUP BY w, k, i),
    a AS (
      SELECT cur.*, g.g IS NOT NULL AS has, coalesce(g.g, 0) + CASE WHEN i < 64 THEN {l2} * th ELSE 0 END AS g,
             ({rate}) * pow({decay}, n // {decay_steps}) AS lr FROM cur LEFT JOIN g USING (w, k, i)),
    u AS (
      SELECT t, w, k, i, r, j, workers, nb, CASE WHEN has THEN {th} ELSE th END AS th, CASE WHEN has THEN {m} ELSE m END AS m,
             CASE WHEN has THEN n + 1 ELSE n END AS n, r * workers * 5 + w < nb AS active FROM a)
    SELECT t + 1 AS t, w, k, i,
           CASE WHEN j = 4 THEN avg(th) FILTER (active) OVER p ELSE th END AS th,
           CASE WHEN j = 4 THEN avg(m) FILTER (active) OVER p ELSE m END AS m,
           CASE WHEN j = 4 THEN max(n) FILTER (active) OVER p ELSE n END AS n
    FROM u WINDOW p AS (PARTITION BY k, i))),
fin AS (SELECT k, i, th FROM st, len WHERE t = {epochs} * rounds * 5 AND w = 0)"""


WEIGHTS = "SELECT CAST(k AS INTEGER) AS k, CAST(i AS INTEGER) AS i, round(th, 6) AS value FROM fin"

# Scores of every batch before its update, with the L2 term.
METRICS = """,
zz AS (
  SELECT st.t, st.w, bt.b, bt.vec_id, bt.label, st.k, sum(st.th * xs.v) AS z, any_value(n) AS n
  FROM st JOIN len ON t < {epochs} * rounds * 5
  JOIN bt ON bt.round = (t // 5) % rounds AND bt.j = t % 5 AND bt.worker = st.w
  JOIN xs ON xs.vec_id = bt.vec_id AND xs.i = st.i GROUP BY ALL),
ll AS (
  SELECT t, w, b, vec_id, max(n) AS n, ln(sum(exp(z))) - max(CASE WHEN k = label THEN z END) AS nll
  FROM zz GROUP BY t, w, b, vec_id),
pen AS (SELECT t, w, 0.5 * {l2} * sum(th * th) AS pen FROM st WHERE i < 64 GROUP BY t, w)
SELECT CAST(ll.t // (5 * rounds) AS INTEGER) AS epoch, CAST((ll.t // 5) % rounds AS BIGINT) AS round,
       CAST(ll.w AS INTEGER) AS worker, CAST(b AS BIGINT) AS batch, count(*) AS examples,
       round(avg(nll) + any_value(pen), 6) AS score, CAST(max(ll.n) + 1 AS BIGINT) AS step
FROM ll JOIN pen ON pen.t = ll.t AND pen.w = ll.w, len GROUP BY ll.t, ll.w, b, rounds"""

# The test side scored by the final weights.
SCORED = """,
tz AS (
  SELECT k1.vec_id, k1.label, fin.k, sum(fin.th * xs.v) AS z
  FROM k1 JOIN xs USING (vec_id) JOIN fin USING (i) WHERE rn > nt GROUP BY ALL),
tp AS (
  SELECT vec_id, label, arg_max(k, (z, -k)) AS predicted, ln(sum(exp(z))) - max(CASE WHEN k = label THEN z END) AS nll
  FROM tz GROUP BY vec_id, label),
cl AS (SELECT DISTINCT label AS c FROM embeddings),
role AS (
  SELECT c, count(*) FILTER (label = c AND predicted = c) AS tp, count(*) FILTER (label <> c AND predicted = c) AS fp,
         count(*) FILTER (label = c AND predicted <> c) AS fn FROM tp, cl GROUP BY c),
pr AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS r FROM role),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END AS f1 FROM pr)
SELECT 'run_report' AS run_id, 'SoftmaxRegression' AS model, CAST({epochs} AS VARCHAR) AS epochs,
       CAST((SELECT workers FROM cfg) AS VARCHAR) AS workers, CAST(count(*) AS VARCHAR) AS num_labels,
       CAST(0 AS BIGINT) AS n_invalid, CAST(0 AS BIGINT) AS n_unlabelled, (SELECT count(*) FROM tp) AS n_test,
       round(sum(tp) / (SELECT count(*) FROM tp), 6) AS accuracy, round(avg(p), 6) AS macro_precision,
       round(avg(r), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1, (SELECT round(avg(nll), 6) FROM tp) AS test_score
FROM f"""

# The formula weights and biases (``formula.dense_weights``).
FORMULA = ("CASE WHEN i.range = 64 THEN ((k.range * 5) % 7 - 3) / 10.0::DOUBLE "
           "ELSE ((k.range * 7 + i.range * 3) % 11 - 5) / 10.0::DOUBLE END")


def image_report(examples: str) -> str:
    """The report of a job on examples made by CTEs that end in one named ``embeddings``."""
    run = training("sgd", 0.5, 2).replace("RECURSIVE ", f"RECURSIVE {examples},\n", 1)
    return f"WITH {run}{SCORED.format(epochs=2)}".replace("'run_report'", "'image_train'")


TRAINING_ORACLES = {
    "train_fit": f"WITH {training('sgd', 0.5, 2, decay=0.5, decay_steps=7)}\n{WEIGHTS}",
    "training_metrics": f"WITH {training('nesterovs', 0.1, 2, l2=0.01)}{METRICS.format(epochs=2, l2=0.01)}",
    "model_roundtrip": f"WITH {training('rmsprop', 0.05, 1)}\n{WEIGHTS}",
    "train_rules": f"WITH {training('sgd', 0.1, 1, bias_lr=0.2, normalised=True, mean=False, drop=0.25, start=FORMULA)}\n{WEIGHTS}",
    "run_report": f"WITH {training('sgd', 2.0, 3)}{SCORED.format(epochs=3)}",
}
