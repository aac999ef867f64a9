"""The filter audit against plain Python, and its matrix against word counts."""

import collections
import itertools
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import filter_audit as A
from tessera.llm.common import written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, word string, mask string"
LABELS = "doc_id long, quality int, toxic int, n string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "one two", "\tone  two\n", "x " * 120, "X " * 120, "UPPER CASE TEXT", "a|b", "é ü\x85ü ü \x1cx", "a b a b a",
         " ".join(f"w{i}" for i in range(130)), " ".join(f"W{i}é" for i in range(130)), "same $ text", "same $ text", "same $ text",
         " ".join(f"long{i % 900}" for i in range(40_000))]


def rows():
    out = [(i, t, [None, "", "en", "de"][i % 4], "s", 0, 1, "x", "m") for i, t in enumerate(TEXTS)]
    return out + [(None, "same $ text", "en", None, None, 1, None, None), (None, "only here", "en", None, None, 1, None, None),
                  (13, "same $ text", "de", "s", 0, 1, "x", "m"), (3, "one two", "fr", "s", 0, 1, "x", "m"),
                  (2 ** 53 + 1, "one two", "en", "s", 0, 1, "x", "m")]


LABEL_ROWS = [(3, 1, 0, "x"), (3, 0, 1, "x"), (13, 1, 1, "x"), (None, 1, 1, "x"), (5, None, 1, "x"), (99, 1, 1, "x"), (10, 1, None, "x")]


def brute(docs, labels):
    good = {d for d, q, _, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, _ in labels if t == 1 and d is not None}
    first = {}
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    out = []
    for d, t, lang, *_ in docs:
        t = t or ""
        w = WORDS.findall(t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), t in first and (d is None or first[t] < d))) if f}
        out.append((lang or "", fails, d in good, d in toxic))
    table = {}
    for part in {r[0] for r in out}:
        mine = [r[1:] for r in out if r[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                table[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[0] for r in mine) - len(gone), sum(r[0] == {f} for r in mine),
                    sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                table[part, "".join(order), step].append(shapley[f])
    return table


def result(out):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in out.collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABEL_ROWS, LABELS)


@pytest.mark.parametrize("shard_bytes", [A.SHARD_BYTES, 50])
def test_audit_equals_plain_python(docs, labels, shard_bytes):
    assert result(A.audit(docs, labels, shard_bytes=shard_bytes)) == brute(rows(), LABEL_ROWS)


def test_matrix_holds_the_word_counts_over_one_dictionary(docs):
    local = written(A.local_shards(docs, shard_bytes=200), "test-shards")
    blocks = A.word_blocks(local, 300)
    number = {r.word: r.word_id for r in A.dictionary(blocks).collect()}
    assert set(number) == {w for r in rows() for w in WORDS.findall(r[1] or "")} and len(set(number.values())) == len(number)
    want = collections.Counter()
    for d, t, lang, *_ in rows():
        counts = collections.Counter(number[w] for w in WORDS.findall(t or ""))
        want[d, lang or "", tuple(sorted(counts.items()))] += 1
    got = collections.Counter()
    for s in A.csr_shards(local, blocks).collect():
        ptr, at, n = np.frombuffer(s.indptr, "<i8"), np.frombuffer(s.indices, "<i8"), np.frombuffer(s.counts, "<i4")
        for i, r in enumerate(s.docs):
            got[r.doc_id, r.part, tuple(sorted(zip(at[ptr[i]:ptr[i + 1]].tolist(), n[ptr[i]:ptr[i + 1]].tolist())))] += 1
    assert got == want


def test_csr_of_odd_texts():
    words, ptr, at, n = A.csr(pa.array(["", " ", " b a b ", "", "a\x0bb\x0c\x1c"]))
    cells = [sorted((words[int(j)].as_py(), int(c)) for j, c in zip(at[a:b], n[a:b])) for a, b in zip(ptr, ptr[1:])]
    assert cells == [[], [], [("a", 1), ("b", 2)], [], [("\x1c", 1), ("a", 1), ("b", 1)]]
    assert A.csr(pa.array(["", " "]))[1].tolist() == [0, 0, 0]
    sliced = pa.array(["zz Z$", "É A#|", "q"]).slice(1)
    assert [c.tolist() for c in A.character_counts(sliced)] == [[5, 1], [1, 0], [2, 0]]


def test_empty_tables(spark, docs):
    none, nolabel = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert A.audit(none, nolabel).collect() == []
    assert result(A.audit(docs, nolabel)) == brute(rows(), [])


def test_hot_text_id_and_part(spark):
    many = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "hot text #" if i % 2 else f"t{i} A", "en", "s", 0, 1, "x", "m") for i in range(3000)]
    df = spark.createDataFrame(many, SCHEMA).repartition(4)
    lab = [(7, 1, 1, "x")]
    assert result(A.audit(df, spark.createDataFrame(lab, LABELS))) == brute(many, lab)


def test_query_equals_its_sql(spark):
    from tessera.llm.queries import ORACLES, op13_filter_audit
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.sql(ORACLES["op13_filter_audit"])
    want = {tuple(dict(zip(rel.columns, r))[c] for c in ("part", "filter_order", "step")):
            [dict(zip(rel.columns, r))[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
            for r in rel.fetchall()}
    assert result(op13_filter_audit(spark, sf)) == want and want
