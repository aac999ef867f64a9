"""The corpus pipeline stage by stage against plain Python, with odd rows."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import brute_fingerprint, lower
from tokenizers import Tokenizer

import corpus_pipeline as P
from tessera.llm import mixing, toxicity
from tessera.llm.queries import learnable

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _row string, rate double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    sf, root = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("_row", F.lit("x")).withColumn("rate", F.lit(1.0))
    odd = [(None, None, None, None, None, None, None), (10_001, "", "en", None, 0, "x", 2.0), (10_002, None, "en", "src1", 0, "x", 2.0),
           (2 ** 53 + 1, "word " * 6000, "en", "src2", 0, None, None), (10_003, "A single copy", "en", "src3", 0, "x", 1.0),
           (10_004, "a SINGLE copy", None, "src4", 0, "x", 1.0), (10_004, "a SINGLE copy", None, "src4", 0, "x", 1.0)]
    docs.unionByName(spark.createDataFrame(odd, COLUMNS)).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def chain(spark, folder):
    """Rows before and after every stage."""
    from tessera.llm.common import written
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    out.append(docs)
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, folder), "test-stage")
        out.append(docs)
    return [(d.columns, d.collect()) for d in out]


def as_set(rows):
    return collections.Counter(map(tuple, rows))


def test_stages_and_columns(chain):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    assert all(cols == chain[0][0] for cols, _ in chain[:-1])
    for (_, before), (_, after) in zip(chain[:3], chain[1:4]):
        assert after and not as_set(after) - as_set(before)  # the first three only drop rows


def test_toxic_documents_go_and_no_others(spark, folder, chain):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, learnable(labels, "toxic", 5, 0))
    assert as_set(chain[1][1]) == as_set(r for r in chain[0][1] if model.score(r.text or "") < P.TOXIC_FROM)
    assert len(chain[1][1]) < len(chain[0][1])


def test_one_row_of_each_text_stays(chain):
    largest = {}
    for r in chain[1][1]:
        key = lower(r.text)
        largest[key] = max(largest.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    kept = chain[2][1]
    assert sorted((lower(r.text), -1 if r.doc_id is None else r.doc_id) for r in kept) == sorted(largest.items())


def test_one_document_of_each_near_group_stays(chain):
    prints = np.array([brute_fingerprint(r.text) for r in chain[2][1]], np.uint64)
    root = np.arange(len(prints))
    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3)
        root[np.isin(root, root[near])] = root[near].min()
    group = {int(f): int(g) for f, g in zip(prints, root)}
    stays = [group[brute_fingerprint(r.text)] for r in chain[3][1]]
    assert len(stays) == len(set(stays)) == len(set(root.tolist()))


def test_mixed_copies_follow_the_rates(spark, chain):
    before, after = chain[3][1], as_set(chain[4][1])
    assert not set(after) - set(map(tuple, before))
    df = spark.createDataFrame([(r.source, len((r.text or "").split())) for r in before], "source string, size long")
    rate = {r.source: r.rate for r in mixing.source_targets(mixing.source_sizes(df)).collect()}
    ids = collections.Counter(r.doc_id for r in before)
    for r in before:
        assert ids[r.doc_id] == 1
        u = int(hashlib.md5(f"42:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        whole = int(rate[r.source])
        assert after[tuple(r)] == whole + (u < rate[r.source] - whole)


def test_every_mixed_document_is_packed(spark, folder, chain):
    t, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), collections.Counter()
    for r in chain[4][1]:
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 2048)):
            want[r.doc_id, p, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in chain[5][1]) == want
    whole = P.run(spark, folder).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == want
    filled = collections.Counter()
    for r in whole:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
