"""op5: pieces against the tokenizers library, exact ids beside NULLs, equal rows."""

import collections
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, tag string, length string, rank string"


def expected(docs, capacity=packing.CAPACITY):
    t, want = Tokenizer.from_file(PATH), collections.Counter()
    for d, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[d, p, s, len(part), zlib.crc32(part.tobytes())] += 1
    return want


def check(out, docs, capacity=packing.CAPACITY):
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected(docs, capacity)
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_ids_beyond_doubles_beside_nulls_and_equal_rows(spark):
    big = 2 ** 53
    docs = [(big + 1, "one two"), (None, "one two"), (big + 3, None), (big + 5, "word " * 5000)]
    docs += [(None, "an equal row")] * 900 + [(big + 7, "an equal row")] * 900
    df = spark.createDataFrame([(d, t, "en", "x", "y", "z") for d, t in docs], SCHEMA).repartition(3)
    n = check(packing.pack(df, PATH).collect(), docs)
    assert n == -(-sum(k[3] * c for k, c in expected(docs).items()) // packing.CAPACITY)


def test_equal_rows_spread_over_rank_buckets(spark):
    from pyspark.sql import functions as F

    from tessera.llm.common import written
    df = spark.createDataFrame([(None, "an equal row", "en", "x", "y", "z")] * 5000, SCHEMA).repartition(4)
    pieces = written(packing.tokenize_pieces(df, PATH), "t")
    sizes = [r["count"] for r in pieces.groupBy(F.pmod(F.xxhash64("tag"), F.lit(packing.RANK_BUCKETS))).count().collect()]
    assert len(sizes) == packing.RANK_BUCKETS and max(sizes) < 200


def test_query_on_given_table(spark):
    from tessera.llm.queries import op5_packing
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n = check(op5_packing(spark, sf).collect(), docs)
    assert n <= 1.02 * -(-sum(k[3] * c for k, c in expected(docs).items()) // packing.CAPACITY) + 1
