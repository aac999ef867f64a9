"""Retrieval packing: ids against the tokenizers library, BM25 against a dense computation."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import retrieval_packing as R

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, tag int, key string, ids string, shard long, length int"
BIG = 2 ** 53


def rows():
    texts = [None, "", " ", "one two", "One TWO, three.", " ".join(f"word{i % 700} é{i}" for i in range(3000)),
             "same text", "same text", " ".join(["a"] * 2047), " ".join(["a"] * 2048), " ".join(["b"] * 2046)]
    ids = [1, 2, 3, 4, 5, 6, 7, 7, BIG + 1, None, BIG + 3]
    return [(i, t, "en", 1, "k", "x", 5, 0) for i, t in zip(ids, texts)] + [(None, "same text", None, 1, "k", "x", 5, 0)] * 40


def check(out, docs, capacity=R.CAPACITY):
    """Every id in one piece, gapless offsets, no padding but at powers of two; returns windows."""
    t = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for d, text, *_ in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, R.END_ID]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    windows = collections.defaultdict(list)
    by_doc = collections.defaultdict(list)
    for r in out:
        windows[r.sequence_id].append(r)
        part = np.frombuffer(r.ids, "<u2").astype("<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        by_doc[r.doc_id, r.doc_tokens].append((r.start, part))
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and (at & (at - 1) == 0 or at == capacity)
    got = collections.Counter()
    for (d, n), parts in by_doc.items():
        # Rows with one id and size: deal pieces out by their start.
        copies = collections.defaultdict(list)
        for s, p in parts:
            copies[s].append(p)
        chains = []
        for s in sorted(copies):
            for p in sorted(copies[s], key=lambda p: p.tobytes()):
                c = next((c for c in chains if sum(map(len, c)) == s), None) if s else None
                chains.append([p]) if c is None else c.append(p)
        for c in chains:
            got[d, n, zlib.crc32(np.concatenate(c).tobytes())] += 1
    assert got == want
    return windows


@pytest.mark.parametrize("shard_docs", [R.SHARD_DOCS, 4])
def test_every_id_once_and_no_padding(spark, shard_docs):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    check(R.pack(df, PATH, shard_docs=shard_docs, with_ids=True).collect(), rows())


def test_scores_equal_dense_bm25():
    rng = np.random.default_rng(0)
    tails = [rng.integers(0, 60, rng.integers(1, 80)).astype("<u2") for _ in range(50)] + [np.zeros(0, "<u2")]
    idf = np.maximum(0, rng.normal(1, 1, 60)).astype(np.float32)
    mean = 33.0
    index = R.ShardIndex(tails, idf, mean)
    used = np.ones(len(tails), bool)
    for _ in range(2):
        for seed in range(len(tails)):
            got = index.scores(seed)
            for d, t in enumerate(tails):
                tf = collections.Counter(t.tolist()) if used[d] else {}
                want = sum(idf[q] * tf[q] * 2.2 / (tf[q] + 1.2 * (0.25 + 0.75 * len(t) / mean))
                           for q in set(tails[seed].tolist()) if tf.get(q))
                assert math.isclose(got[d], want, rel_tol=1e-5, abs_tol=1e-6)
        used[::3] = False
        index.keep(used)


def test_windows_are_filled_by_the_best_unused_neighbours():
    rng = random.Random(1)
    tails = [np.array([100 * (i % 4) + rng.randrange(100) for _ in range(rng.randrange(20, 120))], "<u2") for i in range(400)]
    windows = R.fill_windows(tails, np.ones(400, np.float32), 70.0, 256)
    assert all(sum(b - a for _, a, b in w) == 256 for w in windows[:-1])
    spans = collections.defaultdict(list)
    for w in windows:
        for i, a, b in w:
            spans[i].append((a, b))
    assert all(sorted(s)[0][0] == 0 and sorted(s)[-1][1] == len(tails[i]) and all(x[1] == y[0] for x, y in zip(sorted(s), sorted(s)[1:]))
               for i, s in spans.items()) and len(spans) == 400
    alike = [len({i % 4 for i, _, _ in w}) for w in windows]
    assert sum(a == 1 for a in alike) > 0.9 * len(windows)  # a random packing has almost none
    # The second piece of a window is the best scored tail that was unused (or the best that fits).
    index = R.ShardIndex(tails, np.ones(400, np.float32), 70.0)
    w = windows[0]
    ranking = sorted((i for i in range(400) if i != w[0][0]), key=lambda i: (-index.scores(w[0][0])[i], i))
    assert w[1][0] == ranking[0]


def test_power_of_two_pieces():
    assert R.powers_of_two([(0, 3, 8), (1, 0, 8)]) == [[(0, 3, 8), (1, 0, 3)], [(1, 3, 7)], [(1, 7, 8)]]


def test_hot_key_spreads_over_shards(spark):
    docs = [(None, "copy of one text", "en", 1, "k", "x", 5, 0)] * 3000 + [
        (i, f"t{i} " * (i % 50), "en", 1, "k", "x", 5, 0) for i in range(1500)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    from tessera.llm.common import written
    pieces = written(R.token_pieces(df, PATH), "t")
    sizes = [r["count"] for r in R.shards(pieces, shard_docs=100).groupBy("shard").count().collect()]
    assert max(sizes) < 200 and sum(sizes) == 4500
    check(R.pack(df, PATH, shard_docs=100, with_ids=True).collect(), docs)


def test_frequencies_count_every_document(spark):
    docs = [(i, f"common word{i}" if i % 2 else "common", "en", 1, "k", "x", 5, 0) for i in range(40)]
    from tessera.llm.common import written
    pieces = written(R.token_pieces(spark.createDataFrame(docs, SCHEMA).repartition(3), PATH), "t")
    t = Tokenizer.from_file(PATH)
    df = collections.Counter(i for _, x, *_ in docs for i in set(t.encode(x, add_special_tokens=False).ids))
    idf = R.term_weights(pieces, t.get_vocab_size())
    for i in range(t.get_vocab_size()):
        assert math.isclose(idf[i], max(0, math.log((40 - df[i] + 0.5) / (df[i] + 0.5))), rel_tol=1e-5, abs_tol=1e-6)


def test_sequences_and_empty_table(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = R.pack(df, PATH, with_ids=True)
    whole = {r.sequence_id: len(r.ids) // 2 for r in R.sequences(out).collect()}
    size = collections.Counter()
    for r in out.collect():
        size[r.sequence_id] += r.length
    assert sum(whole.values()) == sum(size.values())
    empty = R.pack(spark.createDataFrame([], SCHEMA), PATH)
    assert empty.collect() == [] and empty.columns == [c.split()[0] for c in R.PACKED.split(", ")]


def test_query_on_given_table(spark):
    from tessera.llm.queries import op11_retrieval_packing
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = op11_retrieval_packing(spark, sf).collect()
    t = Tokenizer.from_file(PATH)
    ids = {d: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for d, x in docs}
    seen, size = collections.Counter(), collections.Counter()
    for r in out:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(part.tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
        size[r.sequence_id] += r.length
    assert seen == {d: len(i) for d, i in ids.items()}
    assert all(s & (s - 1) == 0 for s in size.values())
