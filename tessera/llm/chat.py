"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it as context, then
the reply, the only text under the loss mask. Turns after the last reply (or a conversation
without one) make a last example with an empty mask, so no turn is lost. A turn is

    <|im_start|>role LF text <|im_end|> LF

and control strings inside texts are made harmless by one more backslash between ``<`` and
``|`` than the text has there, which ``unescape`` takes away again; in roles a backslash is
written backslash b and a line feed backslash n as well.

At scale: one exchange of the turns by conversation; positions are running sums over its
turns. Examples repeat their context, as the method says, so the output grows with the
square of a conversation's turns. Reading back parses only the longest example of each
conversation and moves digests and replies, no contexts.

Defined cases: NULL text or role counts as empty; turns that tie are ordered by role, then
text; a NULL turn sorts first; a NULL conv_id is a conversation of its own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of

START, END = "<|im_start|>", "<|im_end|>"
TARGET = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(escape(c), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """conv_id, example (from 0), n_examples, n_turns (in the example), text, loss_start and
    loss_end (code points of the example's text, end exclusive)."""
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     text_of(turns[role_col]).alias("role"), text_of(turns[text_col]).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    t = (t.withColumn("_head", head).withColumn("_body", escape(F.col("text")))
         .withColumn("_seg", F.concat("_head", "_body", F.lit(END + "\n"))))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    t = (t.withColumn("_no", F.row_number().over(in_order))
         .withColumn("_end", F.sum(F.length("_seg").cast("long")).over(so_far)))
    start = F.col("_end") - F.length("_seg") + F.length("_head")
    per = t.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_no", "_seg"))).alias("_segs"),
        F.array_sort(F.collect_list(F.when(F.col("role") == TARGET, F.struct(
            F.col("_no").alias("n_turns"), F.col("_end").alias("end"), start.alias("loss_start"),
            (start + F.length("_body")).alias("loss_end"))))).alias("_targets"),
        F.max(F.struct("_no", "_end")).alias("_all"))
    open_end = F.struct(F.col("_all._no").alias("n_turns"), F.col("_all._end").alias("end"),
                        F.col("_all._end").alias("loss_start"), F.col("_all._end").alias("loss_end"))
    closed = F.exists("_targets", lambda x: x["n_turns"] == F.col("_all._no"))
    per = per.select("conv_id", F.array_join(F.transform("_segs", lambda s: s["_seg"]), "").alias("_text"),
                     F.when(closed, F.col("_targets")).otherwise(F.concat("_targets", F.array(open_end))).alias("_ex"))
    return (per.select("conv_id", "_text", F.size("_ex").alias("n_examples"), F.posexplode("_ex").alias("example", "_e"))
            .select("conv_id", "example", "n_examples", F.col("_e.n_turns").alias("n_turns"),
                    F.substring(F.col("_text"), F.lit(1), F.col("_e.end").cast("int")).alias("text"),
                    F.col("_e.loss_start").alias("loss_start"), F.col("_e.loss_end").alias("loss_end")))


def parse_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    segs = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda s: s != "")
    return F.transform(segs, lambda s: F.struct(
        unescape_role(F.substring(F.substring_index(s, "\n", 1), len(START) + 1, 1 << 30)).alias("role"),
        unescape(F.substring(s, F.instr(s, "\n") + 1, F.lit(1 << 30))).alias("text")))


def read_back(ex: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: n_turns, turns_sha256, loss_text, formatted_chars."""
    longest = F.col("example") == F.col("n_examples") - 1
    turns = F.when(longest, parse_turns(F.col("text")))
    flat = F.array_join(F.transform(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    one = ex.withColumn("_turns", turns).select(
        "conv_id", "example", F.size("_turns").alias("_n"), F.sha2(flat, 256).alias("_sha"),
        F.length("text").cast("long").alias("_chars"),
        unescape(F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"),
                             (F.col("loss_end") - F.col("loss_start")).cast("int"))).alias("_loss"))
    replies = F.transform(F.array_sort(F.collect_list(F.struct("example", "_loss"))), lambda x: x["_loss"])
    return one.groupBy("conv_id").agg(
        F.max("_n").cast("long").alias("n_turns"), F.max("_sha").alias("turns_sha256"),
        F.array_join(replies, "").alias("loss_text"), F.sum("_chars").alias("formatted_chars"))
