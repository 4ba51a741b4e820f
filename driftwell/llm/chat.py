"""Chat formatting from reply trees.

Messages point to the message they reply to. Self-joins on that pointer, whose reach doubles each round, give every
message its distance from the root and the sum of scores on the way; leaves are ranked by that sum; a second series of
joins over the same pointers enumerates the messages of the chosen leaves' paths. Each path becomes one conversation.

Template: ``### Role: text</turn>`` and a line feed for each turn. Inside roles and texts every backslash, ``###`` and
``</turn>`` (in roles every colon too) gets a backslash before it, so that the output can be read back.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table, tune

OPEN, CLOSE = "### ", "</turn>\n"
IN_TEXT, IN_ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"\\|###|</turn>|:")
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
#: A whole turn of formatted text: escapes are taken as units, so control strings inside texts can't end it.
TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|:)|[^\\:])*): ((?:\\(?:\\|###|</turn>|:)|(?!</turn>)[^\\])*)</turn>\n", re.S)


def escape(text: str, pattern: re.Pattern = IN_TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the loss mask as spans (code points, end exclusive) of the turns to learn."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role, IN_ROLE)}: ", escape(text)
        if role == learn and body:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """The messages of each tree's best root-to-leaf paths: tree, leaf, rank, depth, node.

    messages: tree, node (unique), parent (null at a root), score. Leaves of a tree are ranked by the sum of scores on
    their path, then by node; ``branches`` of them are taken (None: all). Rounds grow with the logarithm of the deepest
    path. Messages whose parent is missing count as roots. Messages in a cycle have no root and no path.
    """
    nodes = messages.select("node", "tree", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    there = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("has_parent"))
    nodes = nodes.join(there, "parent", "left").withColumn("up", F.when(F.col("has_parent"), F.col("parent")))
    inner = nodes.filter("up is not null").select(F.col("up").alias("node"), F.lit(True).alias("inner")).distinct()
    base = nodes.join(inner, "node", "left").select("node", "tree", "up", "score", F.coalesce("inner", F.lit(False)).alias("inner"))
    moving = cut(base.select("node", "tree", "inner", "up", F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")))
    limit, jumps = moving.count(), []
    settled, moving = moving.filter("up is null"), moving.filter("up is not null")
    # Messages whose pointer has reached the root stay aside, so that later rounds hold only the deeper ones.
    while not moving.isEmpty():
        if (1 << len(jumps)) > 2 * limit:  # only cycles are left
            break
        jumps.append(moving.select("node", "up"))
        other = settled.unionByName(moving).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("t2"))
        moved = cut(moving.join(other, "up").select("node", "tree", "inner", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("total") + F.col("t2")).alias("total")))
        settled, moving = settled.unionByName(moved.filter("up is null")), moved.filter("up is not null")
    leaves = settled.filter("not inner").select("tree", F.col("node").alias("leaf"), "depth", "total")
    if branches is None:
        order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf")
        chosen = leaves.withColumn("rank", F.row_number().over(order))
    elif branches == 1:  # aggregates before it shuffles
        best = leaves.groupBy("tree").agg(F.min_by(F.struct("leaf", "depth"), F.struct((-F.col("total")).alias("t"), "leaf")).alias("x"))
        chosen = best.select("tree", "x.leaf", "x.depth", F.lit(1).alias("rank"))
    else:
        order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf")
        chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= branches)
    found = chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), "depth")
    for k, step in enumerate(jumps):
        up = found.join(step.withColumnRenamed("up", "above"), "node").select("tree", "leaf", "rank", F.col("above").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        found = cut(found.unionByName(up))
    return found


def format_paths(messages: DataFrame, chosen: DataFrame, learn: str = "assistant") -> DataFrame:
    """One formatted conversation a path: tree, leaf, rank, formatted, mask array<struct<a, b>>.

    messages: node, role, text. Null roles and texts count as empty. A conversation is one string in the end, so its
    turns meet in one task, however many they are.
    """
    import pyarrow as pa

    tune(messages.sparkSession)
    texts = messages.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = chosen.join(texts, "node").groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))

    def run(batches):
        for batch in batches:
            done = [format_turns([(t["role"], t["text"]) for t in x], learn) for x in batch.column(3).to_pylist()]
            spans = pa.array([[{"a": a, "b": b} for a, b in m] for _, m in done], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x for x, _ in done], pa.string()), spans], names=["tree", "leaf", "rank", "formatted", "mask"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in turns.select("tree", "leaf", "rank").schema]
    return turns.mapInArrow(run, ", ".join([*fields, "formatted string", "mask array<struct<a: long, b: long>>"]))


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[m["a"] : m["b"]]) for m in mask)
                sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[j] for r in out], t) for j, t in enumerate(kinds))], names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "formatted", "mask").mapInArrow(run, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def reply_chain(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees without branches: each row replies to the row before it, by turn, role and text.

    Rows with the same turn, repeated rows too, all stay, one after another; null turns come last; rows with null conv_id form one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("place"))
    # Null ids get a key of their own beside the numbers.
    key = lambda place: F.struct(F.col("conv_id").isNull().alias("n"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("c"), place.alias("p"))
    return rows.select(
        F.struct(F.col("conv_id").isNull().alias("n"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("c")).alias("tree"), key(F.col("place")).alias("node"),
        F.when(F.col("place") > 1, key(F.col("place") - 1)).alias("parent"), F.lit(0.0).alias("score"), "role", "text",
    )


def op9_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(more)
    messages = cut(reply_chain(rows))
    done = digests(format_paths(messages, paths(messages, branches=1)))
    return done.select(F.when(~F.col("tree.n"), F.col("tree.c")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
