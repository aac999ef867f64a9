"""op8: rows that share an id, or have none, draw apart; targets are met; reruns agree."""

import collections
import hashlib

import duckdb
import pytest

from tessera.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, _u double, rate double"


def rows():
    out = []
    for i in range(6000):
        doc = None if i % 3 == 0 else 7 if i % 30 == 1 else i
        text = "one two three" if i % 5 == 0 else " ".join(f"w{i}" for _ in range(i % 9))
        out.append((doc, text, "en", f"s{i % 4}", 0, 1, 0.5, 9.0))
    return out


@pytest.mark.parametrize("hot_least", [1, mixing.HOT_LEAST])
def test_targets_are_met_where_ids_are_null_or_repeat(spark, monkeypatch, hot_least):
    monkeypatch.setattr(mixing, "HOT_LEAST", hot_least)
    data = rows()
    plans = []
    for parts in (3, 7):
        out = mixing.mix_plan(spark.createDataFrame(data, SCHEMA).repartition(parts)).collect()
        assert len(out) == len(data)
        got, want, spread = collections.Counter(), {}, collections.Counter()
        for r in out:
            got[r.source] += r.taken
            want[r.source] = r.target
            part = r.target / r.source_size % 1
            spread[r.source] += r.size ** 2 * part * (1 - part)  # variance of independent draws
            assert r.taken in (r.size * k for k in range(4))
        assert all(abs(got[s] - t) <= 3 * spread[s] ** 0.5 + 1 for s, t in want.items()), (got, want, spread)
        plans.append(collections.Counter((r.doc_id, r.size, r.source, r.taken) for r in out))
    assert plans[0] == plans[1]  # however the rows are dealt out


def test_a_third_without_an_id_stays_within_two_percent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    some = docs.selectExpr("CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END AS doc_id", "text", "'s' || source AS source")
    three = some.selectExpr("doc_id", "text", "'s' || (length(source) % 2) AS source")  # two large sources
    total = collections.Counter()
    for r in mixing.mix_plan(three).collect():
        total[r.source, r.target] += r.taken
    assert len(total) == 2 and all(abs(n - target) <= 0.05 * target for (_, target), n in total.items()), total


def test_unique_ids_draw_by_id_alone(spark):
    data = [r for r in rows() if r[0] is not None and r[0] != 7]
    out = mixing.mix_plan(spark.createDataFrame(data, SCHEMA)).collect()
    rate = {r.source: min(3.0, r.target / r.source_size) for r in out}
    for r in out:
        u = int(hashlib.md5(f"42:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert r.copies == int(rate[r.source]) + (u < rate[r.source] - int(rate[r.source]))


def test_mix_emits_what_the_plan_says(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    want = collections.Counter()
    for r in mixing.mix_plan(df).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = collections.Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.mix(df).collect())
    assert got == +want and mixing.mix(df).columns == df.columns


def test_query_equals_its_sql(spark):
    from tessera.llm.queries import ORACLES, op8_mixing
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rel = con.sql(ORACLES["op8_mixing"])
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in op8_mixing(spark, sf).collect()) == want
