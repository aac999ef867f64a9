"""ANSI SQL (DuckDB dialect) oracles for the registered queries.

Each string runs on the given tables as views and must return the same
columns, types and (rounded) values as the Spark query of the same key.
"""

from __future__ import annotations

from tessera.plans.training_oracles import PLACED, TRAINING_ORACLES, image_report

KEY = "md5('42:' || CAST(vec_id AS VARCHAR))"

# embeddings unnested: one row per element, 0-based index
X = """x AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
         CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i
  FROM embeddings)"""

KS = "ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(10))"

# formula dense 64->10: logits z per (vec_id, k)
Z = f"""{X},
{KS},
z AS (
  SELECT x.vec_id, ks.k,
         sum(x.v * (CAST((ks.k * 7 + x.i * 3) % 11 - 5 AS DOUBLE) / 10))
           + CAST((ks.k * 5) % 7 - 3 AS DOUBLE) / 10 AS z
  FROM x, ks GROUP BY x.vec_id, ks.k)"""

# softmax probabilities and the first arg-max
PRED = f"""{Z},
m AS (SELECT vec_id, max(z) AS zm FROM z GROUP BY vec_id),
e AS (SELECT z.vec_id, z.k, exp(z.z - m.zm) AS e FROM z JOIN m USING (vec_id)),
s AS (SELECT vec_id, sum(e) AS s FROM e GROUP BY vec_id),
p AS (SELECT e.vec_id, e.k, e.e / s.s AS p FROM e JOIN s USING (vec_id)),
best AS (
  SELECT vec_id, k AS predicted, p AS p_max FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k) AS r FROM p) WHERE r = 1),
pred AS (
  SELECT em.vec_id, em.label AS actual, CAST(best.predicted AS INTEGER) AS predicted, best.p_max,
         -ln(greatest(pt.p, 1e-15)) AS nll
  FROM embeddings em JOIN best USING (vec_id)
  JOIN p pt ON pt.vec_id = em.vec_id AND pt.k = em.label)"""

SPLIT = f"""k0 AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY {KEY}, vec_id) AS rn, count(*) OVER () AS n
  FROM embeddings),
t0 AS (SELECT *, CAST(round(0.8 * n) AS BIGINT) AS nt FROM k0),
sp AS (
  SELECT vec_id, label, rn,
         CASE WHEN rn <= nt THEN 'train' ELSE 'test' END AS split,
         CASE WHEN rn <= nt THEN rn ELSE rn - nt END AS split_rn,
         CASE WHEN rn <= nt THEN nt ELSE n - nt END AS n_split
  FROM t0)"""

PAGE_LABELS = """pl AS (
  SELECT page_id, string_split(regexp_replace(url, '[/]*([?#].*)?$', ''), '/')[-2] AS label
  FROM pages)"""


def _metrics(cm: str, classes: str) -> str:
    return f"""{cm},
cls AS ({classes}),
per AS (
  SELECT c.label_idx,
    CAST(coalesce((SELECT sum(n) FROM cm WHERE actual = c.label_idx AND predicted = c.label_idx), 0) AS BIGINT) AS tp,
    CAST(coalesce((SELECT sum(n) FROM cm WHERE predicted = c.label_idx AND actual <> c.label_idx), 0) AS BIGINT) AS fp,
    CAST(coalesce((SELECT sum(n) FROM cm WHERE actual = c.label_idx AND predicted <> c.label_idx), 0) AS BIGINT) AS fn
  FROM cls c),
pm AS (
  SELECT label_idx, tp, fp, fn, tp + fn AS support,
         CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall
  FROM per),
mm AS (
  SELECT *, CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) END AS f1
  FROM pm)"""


def _summary(body: str) -> str:
    return f"""WITH {body}
SELECT CAST(count(*) AS BIGINT) AS n_classes, CAST(sum(support) AS BIGINT) AS n,
       round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1), 6) AS macro_f1
FROM mm"""


CM_EMB = f"""{PRED},
cm AS (SELECT actual, predicted, count(*) AS n FROM pred GROUP BY actual, predicted)"""
CLS_EMB = "SELECT DISTINCT label AS label_idx FROM embeddings"
CM_BIN = """cm AS (SELECT quality AS actual, toxic AS predicted, count(*) AS n FROM labels GROUP BY quality, toxic)"""
CLS_BIN = "SELECT quality AS label_idx FROM labels UNION SELECT toxic FROM labels"

CLOSED_FORM = f"""WITH {X},
{KS},
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM embeddings),
w AS (
  SELECT ks.k, x.i,
         0.5 * (sum(CASE WHEN x.label = ks.k THEN x.v ELSE 0 END) / nn.n - sum(x.v) / nn.n / 10) AS value
  FROM x, ks, nn GROUP BY ks.k, x.i, nn.n),
b AS (
  SELECT ks.k, 64 AS i, 0.5 * (count(*) FILTER (WHERE em.label = ks.k) / nn.n - 0.1) AS value
  FROM embeddings em, ks, nn GROUP BY ks.k, nn.n)
SELECT k, CAST(i AS INTEGER) AS i, round(value, 6) AS value FROM w
UNION ALL
SELECT k, CAST(i AS INTEGER) AS i, round(value, 6) AS value FROM b"""


PIXELS = f"""{X},
px AS (SELECT vec_id, label, i, least(greatest(floor((v + 1) * 127.5 + 0.5), 0), 255) AS p FROM x)"""

# Grey level of the derived colour images: blue, green, red by the BT.601 luma weights.
GREY = "(0.114::DOUBLE * ((7 * p + px.i) % 256) + 0.587::DOUBLE * (255 - p) + 0.299::DOUBLE * p)"


def axis_weights(name: str, n_in: int, n_out: int) -> str:
    """CTE ``name(o, i, w)``: bilinear weights with half-pixel centres along one axis."""
    pos = f"greatest(0, least({n_in - 1}, (range + 0.5)::DOUBLE * ({n_in}::DOUBLE / {n_out}) - 0.5))"
    return f"""{name} AS (
  SELECT o, i, sum(w) AS w FROM (
    SELECT range AS o, unnest([floor({pos}), least(floor({pos}) + 1, {n_in - 1})]) AS i,
           unnest([1 - ({pos} - floor({pos})), {pos} - floor({pos})]) AS w FROM range({n_out})) GROUP BY o, i)"""


ORACLES = {
    "tensor_scan": """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_values,
       round(list_sum(list_transform(embedding, lambda e: CAST(e AS DOUBLE))), 6) AS elem_sum
FROM embeddings""",

    "label_from_path": f"WITH {PAGE_LABELS} SELECT page_id, label FROM pl",

    "label_vocab": f"""WITH {PAGE_LABELS},
d AS (SELECT label, count(*) AS n_examples FROM pl WHERE label IS NOT NULL GROUP BY label)
SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx, label,
       CAST(n_examples AS BIGINT) AS n_examples
FROM d""",

    "seeded_shuffle": f"""
SELECT vec_id, label, {KEY} AS order_key,
       CAST(row_number() OVER (ORDER BY {KEY}, vec_id) AS BIGINT) AS rn
FROM embeddings""",

    "sample_cap": f"SELECT vec_id, label FROM embeddings ORDER BY {KEY}, vec_id LIMIT 300",

    "split_exact": f"""WITH {SPLIT}
SELECT vec_id, label, CAST(rn AS BIGINT) AS rn, split, CAST(split_rn AS BIGINT) AS split_rn,
       CAST(n_split AS BIGINT) AS n_split
FROM sp""",

    "split_hash": f"""
SELECT vec_id, label,
       CASE WHEN substr({KEY}, 1, 8) < 'cccccccd' THEN 'train' ELSE 'test' END AS split
FROM embeddings""",

    "batch_assign": f"""WITH {PLACED}
SELECT vec_id, CAST(rn AS BIGINT) AS split_rn, CAST(b AS BIGINT) AS batch_id, CAST((rn - 1) % 18 AS INTEGER) AS pos,
       CAST(worker AS INTEGER) AS worker, CAST(round AS BIGINT) AS round
FROM bt JOIN k1 USING (vec_id)""",

    "epoch_repeat": f"""WITH {SPLIT},
tr AS (SELECT vec_id, CAST((split_rn - 1) // 18 AS BIGINT) AS batch_id,
              CAST(ceil(n_split / 18.0) AS BIGINT) AS nb
       FROM sp WHERE split = 'train')
SELECT vec_id, CAST(ep.range AS INTEGER) AS epoch, batch_id, CAST(ep.range * nb + batch_id AS BIGINT) AS step
FROM tr, range(3) ep""",

    "scale_range": f"""WITH {X}
SELECT vec_id, i, round((v - (-1.0)) * 0.5, 6) AS value FROM x""",

    "one_hot": f"""WITH {KS}
SELECT vec_id, ks.k, CASE WHEN ks.k = label THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM embeddings, ks""",

    "dense_forward": f"""WITH {Z}
SELECT vec_id, k, round(greatest(z, 0.0), 6) AS value FROM z""",

    "softmax_predict": f"""WITH {PRED}
SELECT vec_id, actual, predicted, round(p_max, 6) AS p_max, round(nll, 6) AS nll FROM pred""",

    "score_batch": f"""WITH {PRED}
SELECT vec_id, actual, predicted, round(p_max, 6) AS p_max, round(nll, 6) AS nll FROM pred""",

    "conv2d_forward": f"""WITH {X},
kern AS (
  SELECT o.range AS c, dy.range AS dy, dx.range AS dx,
         CAST((o.range * 5 + dy.range * 3 + dx.range) % 7 - 3 AS DOUBLE) / 10 AS w
  FROM range(2) o, range(3) dy, range(3) dx),
contrib AS (
  SELECT x.vec_id, kern.c, x.i // 8 - kern.dy + 1 AS y, x.i % 8 - kern.dx + 1 AS xx, x.v * kern.w AS t
  FROM x, kern)
SELECT vec_id, CAST(c AS INTEGER) AS c, CAST(y AS INTEGER) AS y, CAST(xx AS INTEGER) AS x,
       round(sum(t) + CAST(c AS DOUBLE) / 10, 6) AS value
FROM contrib WHERE y BETWEEN 0 AND 7 AND xx BETWEEN 0 AND 7
GROUP BY vec_id, c, y, xx""",

    "maxpool_forward": f"""WITH {X}
SELECT vec_id, CAST(i // 8 // 2 AS INTEGER) AS y, CAST(i % 8 // 2 AS INTEGER) AS x, round(max(v), 6) AS value
FROM x GROUP BY vec_id, i // 8 // 2, i % 8 // 2""",

    "lrn_forward": f"""WITH {X}
SELECT vec_id, i AS c,
       round(v / power(2.0 + 0.0001 * sum(v * v) OVER (PARTITION BY vec_id ORDER BY i
                                                      ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 0.75), 6) AS value
FROM x""",

    "confusion_matrix": f"""WITH {CM_EMB}
SELECT actual, predicted, CAST(n AS BIGINT) AS n FROM cm""",

    "class_metrics": f"""WITH {_metrics(CM_EMB, CLS_EMB)}
SELECT label_idx, tp, fp, fn, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1
FROM mm""",

    "eval_summary": _summary(_metrics(CM_EMB, CLS_EMB)),

    "nll_score": f"""WITH {PRED}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(nll), 6) AS score FROM pred""",

    "confusion_binary": f"""WITH {CM_BIN}
SELECT actual, predicted, CAST(n AS BIGINT) AS n FROM cm""",

    "eval_summary_binary": _summary(_metrics(CM_BIN, CLS_BIN)),

    "param_average": f"""WITH {X}
SELECT label AS chunk, i, round(avg(v), 6) AS value FROM x GROUP BY label, i""",

    "image_scan": f"""WITH {PIXELS}
SELECT vec_id, label, CAST(8 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width,
       CAST(1 AS INTEGER) AS n_channels, CAST(sum(p) AS BIGINT) AS pixel_sum
FROM px GROUP BY vec_id, label""",

    "image_resize": f"""WITH {PIXELS}
SELECT vec_id, CAST(i // 8 // 2 AS INTEGER) AS y, CAST(i % 8 // 2 AS INTEGER) AS x, round(avg(p) / 255, 6) AS value
FROM px GROUP BY vec_id, i // 8 // 2, i % 8 // 2""",

    "image_resize_up": f"""WITH {PIXELS}, {axis_weights('wy', 8, 11)}, {axis_weights('wx', 8, 5)}
SELECT vec_id, CAST(c.range AS INTEGER) AS c, CAST(wy.o AS INTEGER) AS y, CAST(wx.o AS INTEGER) AS x,
       round(sum(wy.w * wx.w * p) / 255, 6) AS value
FROM px JOIN wy ON wy.i = px.i // 8 JOIN wx ON wx.i = px.i % 8, range(3) c GROUP BY ALL""",

    "image_grey": f"""WITH {PIXELS}, {axis_weights('wy', 8, 3)}, {axis_weights('wx', 8, 13)}
SELECT vec_id, CAST(wy.o AS INTEGER) AS y, CAST(wx.o AS INTEGER) AS x, round(sum(wy.w * wx.w * {GREY}) / 255, 6) AS value
FROM px JOIN wy ON wy.i = px.i // 8 JOIN wx ON wx.i = px.i % 8 GROUP BY ALL""",

    "image_train": image_report(f"""{PIXELS.replace('embeddings', 'main.embeddings')}, {axis_weights('wy', 8, 4)}, {axis_weights('wx', 8, 16)},
embeddings AS (
  SELECT vec_id, label, list(v ORDER BY j) AS embedding FROM (
    SELECT vec_id, label, wy.o * 16 + wx.o AS j, sum(wy.w * wx.w * {GREY}) / 255 AS v
    FROM px JOIN wy ON wy.i = px.i // 8 JOIN wx ON wx.i = px.i % 8 GROUP BY ALL) GROUP BY vec_id, label)"""),

    "train_step": CLOSED_FORM,

    "train_round": CLOSED_FORM,

    "predict_named": f"""WITH {PRED},
{SPLIT},
first_test AS (SELECT vec_id FROM sp WHERE split = 'test' ORDER BY split_rn LIMIT 1),
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx, label
  FROM (SELECT DISTINCT CAST(label AS VARCHAR) AS label FROM embeddings))
SELECT f.vec_id, ve.label AS expected, vp.label AS predicted_name
FROM first_test f JOIN pred USING (vec_id)
LEFT JOIN vocab ve ON ve.label_idx = pred.actual
LEFT JOIN vocab vp ON vp.label_idx = pred.predicted""",

    "duration_text": """
SELECT event_id, event_id * 997 AS ms,
       CAST((event_id * 997) // 60000 AS VARCHAR) || ' min, ' ||
       CAST(((event_id * 997) // 1000) % 60 AS VARCHAR) || ' sec, ' ||
       CAST((event_id * 997) % 1000 AS VARCHAR) || ' ms' AS text
FROM events""",
    **TRAINING_ORACLES,
}
