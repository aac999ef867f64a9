"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Every text is scanned once for candidates: assignments, access keys, hex runs (the base
kinds) and long tokens that mix letters and digits. Candidate values are hashed and
counted over the whole corpus by distinct repositories and distinct owners. A value that
several owners have is a copied example; a value that few owners have and that looks random
is live-looking. Live-looking long tokens that base spans don't wholly cover are added as kind ``owned``;
base spans always stay, and are marked live or example.

At scale: the scan is narrow; what it finds (lengths and hashes, no text) is written once.
Counting is partial/final by (value, owner, repository) and then by value, so a value that a
third of the documents carry is reduced before the shuffle. Verdicts return to the spans with
widely copied values joined by broadcast (``common.attach_by_key``). Positions are running
sums over one document's matches.

Defined cases: NULL text counts as empty (no spans); a NULL owner or repository is one of its
own; rows that share a doc_id keep their own spans; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import attach_by_key, count_rows, text_of, written

# Fixed patterns; ASCII letters in either case where the kind says so.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# Longest runs: asking for the least length at once finds the same ones, and leaves the
# many short runs of any text unmatched.
ACCESS = r"(AKIA[A-Z0-9]{14,})"
HEX = r"([0-9a-f]{16,})"
LONG = r"([A-Za-z0-9+/_=-]{20,})"
# kind, pattern, group of the secret value, least length of that group
KINDS = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 1, 18), ("hex", HEX, 1, 16), ("owned", LONG, 1, 20))
BASE = ("assign", "access", "hex")
FEW_OWNERS = 2
LEAST_VARIETY = 10


def _variety(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, "")))


def _found(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """All matches of a kind in order: the gap before, the length, whether the
    match counts, hash and looks of its value."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def one(z: Column, i: Column) -> Column:
        value = z["value"]
        mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        looks = mixed & (_variety(value) >= LEAST_VARIETY)
        ok = (F.length(value) >= least) & (F.lit(kind in BASE) | looks)
        return F.struct(F.lit(order).alias("kind"), i.alias("pos"), F.length(z["gap"]).alias("gap"),
                        F.length(z["all"]).alias("len"), ok.alias("ok"),
                        F.when(ok, F.xxhash64(value)).alias("hash"), F.coalesce(looks, F.lit(False)).alias("random"))
    # The last gap has no match after it.
    return F.transform(F.filter(zipped, lambda z: z["all"].isNotNull()), one)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "lang") -> DataFrame:
    """One row per input row (a written table without text): rid, doc_id, owner,
    repo and the found matches. A repository is a (owner, repo) pair."""
    text = text_of(docs[text_col])
    kinds = [_found(F.col("_t"), i, *k) for i, k in enumerate(KINDS)]
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                      F.col(repo_col).cast("string").alias("repo"), text.alias("_t"))
    return written(own.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "owner", "repo",
                              F.concat(*kinds).alias("found")), "secret-scan")


def spans(scanned: DataFrame) -> DataFrame:
    """rid, owner, repo, kind, start, end (code points, end exclusive), hash, random."""
    m = scanned.select("rid", "owner", "repo", F.explode("found").alias("m")).select("rid", "owner", "repo", "m.*")
    w = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (m.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(w))
            .withColumn("start", F.col("end") - F.col("len")).filter("ok")
            .select("rid", "owner", "repo", "kind", "start", "end", "hash", "random"))


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: n spans, distinct owners and distinct repositories."""
    per_repo = found.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("hash").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("owners"),
                                         F.sum("repos").alias("repos"))


def judged_spans(scanned: DataFrame, few_owners: int = FEW_OWNERS) -> DataFrame:
    """Base spans and added ones, with owners, repos and ``live``."""
    found = written(spans(scanned), "secret-spans")
    freq = written(ownership(found), "ownership")
    all_ = attach_by_key(found, freq, ["hash"], count_rows(found))
    all_ = all_.withColumn("live", (F.col("owners") <= few_owners) & F.col("random"))
    # An added span is not wholly covered by base spans. Base spans that overlap or touch
    # form an island; the last island to begin at or before a span is the one to cover it.
    base = F.col("kind") < len(BASE)
    in_order = Window.partitionBy("rid").orderBy("start", "kind")
    reach = F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    all_ = all_.withColumn("_new", (base & F.coalesce(F.col("start") > reach, F.lit(True))).cast("int"))
    all_ = all_.withColumn("_island", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    to = F.max(F.when(base, F.col("end"))).over(Window.partitionBy("rid", "_island"))
    free = F.coalesce(to < F.col("end"), F.lit(True))
    return (all_.withColumn("_free", free).filter(base | (F.col("live") & F.col("_free")))
            .select("rid", "kind", "start", "end", "hash", "owners", "repos", "live"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "lang", few_owners: int = FEW_OWNERS) -> DataFrame:
    """Per input row: doc_id, n_assign, n_access, n_hex, n_owned, n_live, n_example,
    base_spans and all_spans (arrays of struct<start, kind, end>, sorted)."""
    scanned = scan(docs, id_col, text_col, owner_col, repo_col)
    s = judged_spans(scanned, few_owners)
    base = F.col("kind") < len(BASE)
    span = F.struct("start", "kind", "end")
    per = s.groupBy("rid").agg(
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k[0]}") for i, k in enumerate(KINDS)],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(F.col("owners") > few_owners, 1)).alias("n_example"),
        F.sort_array(F.collect_list(F.when(base, span))).alias("base_spans"),
        F.sort_array(F.collect_list(span)).alias("all_spans"))
    counts = [c for c in per.columns if c.startswith("n_")]
    return (scanned.select("rid", "doc_id").join(per, "rid", "left").drop("rid").fillna(0, counts)
            .withColumns({c: F.coalesce(F.col(c), F.array().cast(per.schema[c].dataType)) for c in ("base_spans", "all_spans")}))


def spans_text(c: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(F.col(c), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
