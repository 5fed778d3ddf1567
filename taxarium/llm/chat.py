"""Chat formatting: reply trees, ranked root-to-leaf paths, reversible templates and loss masks.

A message table has (tree, node, parent, score, role, text).  ``reply_paths`` doubles ancestor
pointers by self-joins, so a path of n messages takes log2(n) rounds; ids and scores move, texts
do not.  Every round is a table in the shared scratch folder.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

TURN_START, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    r"""Control strings never stand in an escaped text: ``\`` becomes ``\b``, ``###`` ``\h`` and ``</turn>`` ``\e``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\e"))


def unescape(text: Column) -> Column:
    """The text that was escaped.  Backslashes come last: each heads exactly one pair."""
    text = F.replace(F.replace(text, F.lit("\\e"), F.lit("</turn>")), F.lit("\\h"), F.lit("###"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def reply_paths(spark: SparkSession, messages: DataFrame, top_k: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth): the top_k root-to-leaf paths of each tree, best total score first.

    A parent that is null or absent makes a root.  Messages on a parent cycle reach no root and
    give no path; neither do messages without a tree or a node.  Null scores count 0; ties go to
    the smaller leaf.  Message keys are unique within a tree.

    Only messages that have not reached their root take part in a round, and only trees that hold
    such messages are looked up in it, so short trees leave after few rounds.
    """
    scratch = Scratch(spark, "paths")
    base = messages.filter("tree is not null and node is not null").select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = base.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    state = scratch.save(
        base.join(known, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_n")), "left")
        .select("tree", "node", F.col("_n").alias("anc"), F.col("score").alias("total"), F.lit(1).alias("hops"), F.lit(True).alias("fresh"))
    )
    largest = state.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    done, jumps = [], []
    for _ in range(1 + math.ceil(math.log2(largest + 1))):
        done.append(state.filter("anc is null and fresh"))
        active = state.filter("anc is not null")
        if active.isEmpty():
            break
        jumps.append(active)
        looked_up = state.join(active.select("tree").distinct(), "tree", "left_semi")
        far = looked_up.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("anc").alias("_anc"), F.col("total").alias("_total"), F.col("hops").alias("_hops"))
        moved = active.join(far, (F.col("tree") == F.col("_t")) & (F.col("anc") == F.col("_n"))).select(
            "tree", "node", F.col("_anc").alias("anc"), (F.col("total") + F.col("_total")).alias("total"), (F.col("hops") + F.col("_hops")).alias("hops"), F.lit(True).alias("fresh")
        )
        state = scratch.save(moved.unionByName(looked_up.filter("anc is null").withColumn("fresh", F.lit(False))))
    leaves = reduce(DataFrame.unionByName, done)
    if jumps:
        leaves = leaves.join(jumps[0].select("tree", F.col("anc").alias("node")).distinct(), ["tree", "node"], "left_anti")
    best = F.struct(F.col("total"), -F.col("node"))
    if top_k == 1:
        ranked = leaves.groupBy("tree").agg(F.max_by(F.struct("node", "hops"), best).alias("leaf")).select("tree", F.col("leaf.node").alias("leaf"), F.lit(1).alias("rank"), F.col("leaf.hops").alias("hops"))
    else:
        order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
        ranked = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k).select("tree", F.col("node").alias("leaf"), "rank", "hops")
    path = ranked.select("tree", "leaf", "rank", F.col("leaf").alias("node"), (F.col("hops") - 1).alias("depth"))
    for k in reversed(range(len(jumps))):
        step = jumps[k].select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("anc").alias("_anc"))
        path = scratch.save(path)
        up = path.join(step, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n"))).select("tree", "leaf", "rank", F.col("_anc").alias("node"), (F.col("depth") - 2**k).cast("int").alias("depth"))
        path = path.unionByName(up)
    return path


def format_paths(paths: DataFrame, messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per path: tree, leaf, rank, formatted, and loss_spans (start, length in code points; ascending).

    Null roles and texts format as empty ones.
    """
    texts = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.join(texts, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
    head = F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit(ROLE_END))
    turns = turns.select("tree", "leaf", "rank", "depth", F.col("role").isin(*loss_roles).alias("learn"), head.alias("head"), escape(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + len(TURN_END)
    before = Window.partitionBy("tree", "leaf", "rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    gathered = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "head", "body", "start", "learn"))).alias("turns"))
    return gathered.select(
        "tree", "leaf", "rank",
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END)))).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, TURN_END), lambda p: p != "")
    at = lambda p: F.instr(p, ROLE_END)
    return F.transform(parts, lambda p: F.struct(unescape_role(F.substring(p, F.lit(len(TURN_START) + 1), at(p) - 1 - len(TURN_START))).alias("role"), unescape(F.substring(p, at(p) + len(ROLE_END), F.length(p))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: the rows of a conversation by turn (ties by role, then text), each replying to the one before.

    Null turns come first; rows without a conv_id form one conversation of their own.
    """
    key = F.struct(F.col("conv_id").isNull().alias("missing"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("id"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.select(key.alias("tree"), "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long") - 1)
    return rows.select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
