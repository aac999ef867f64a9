"""op9 on the given tables: held-out accuracy, many scores, exact neighbours."""

import zlib

import numpy as np

from tessera.llm import toxicity
from tessera.llm.queries import learnable, op9_toxicity


def test_query_scores_every_text_by_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    out = op9_toxicity(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")["toxic"]
    assert sorted(out["doc_id"]) == sorted(docs.index)
    assert (out["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in out["doc_id"]]).all()
    assert ((out["score"] >= 0.5) == (out["predicted"] == 1)).all() and out["score"].between(0, 1).all()
    assert out["score"].round(9).nunique() > 200  # no constant for texts without a telling word
    assert (out["neighbours"].str.len() > 0).mean() > 0.95
    held = out[out["held_out"] & out["doc_id"].isin(labels.index)]
    truth = labels[held["doc_id"]].to_numpy()
    assert held["predicted"].to_numpy()[truth == 1].mean() >= 0.6 and held["predicted"].to_numpy()[truth == 0].mean() <= 0.05
    # The neighbours are the nearest of a dense search over the same vectors.
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"),
                         learnable(spark.read.parquet(f"{sf}/labels.parquet"), "toxic", 5, 0))
    dense = np.zeros((len(model.labels), len(model.terms)))
    term = np.repeat(np.arange(len(model.terms)), np.diff(model.block_at[model.first_block]))
    dense[model.examples, term] = model.values_
    for _, r in out.iloc[::50].iterrows():
        t, w = model.vector(docs.loc[r["doc_id"], "text"] or "")
        cosines = dense[:, t] @ w
        assert np.allclose(r["cosines"], np.sort(cosines)[::-1][:model.k][:len(r["cosines"])])
        assert not {i for i in r["neighbours"] if zlib.crc32(str(i).encode()) % 5 == 0}  # none of the held-out
