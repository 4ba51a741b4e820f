"""A Merkle manifest of documents: each source is a tree over its documents, and the sources' roots are the leaves of one.

Trees are cut into aligned parts of ``PART`` leaves. A part hashes its own levels, then the parts of a tree swap roots as
in a butterfly: in each round a part meets one part of each sibling subtree, namely those that differ from it in one
digit of their number, and both hash the same parent. So after the last round each part knows the whole way up from its
root; nothing is sent down again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Children of a node; leaves of a part, three levels.
FANOUT = 16
PART = FANOUT**3
STEPS = "array<struct<place: int, others: array<string>>>"


def leaf(text: str | Column = "text") -> Column:
    """Digest of a row: each value is its length in bytes, a colon and itself, or a dash for null."""
    values = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string"), F.col(text) if isinstance(text, str) else text]
    return F.sha2(F.concat(*(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values)), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree and more) with idx, the row's place in its tree by ``order`` from 0, and n, the tree's rows.

    Rows are dealt to ranges of (tree, order), so that a large tree fills many; only the ranges' counts are summed in order.
    Rows that are equal in everything are dealt by chance, so that many of them fill several ranges too.
    """
    placed = cut(rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange("tree", *order, "salt").withColumn("range", F.spark_partition_id()))
    sums = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("size"))
    own = Window.partitionBy("tree")
    sums = sums.select("tree", "range", (F.sum("size").over(own.orderBy("range")) - F.col("size")).alias("before"), F.sum("size").over(own).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order, "salt"))
    out = placed.withColumn("place", place).join(sums, ["tree", "range"])
    return out.withColumn("idx", F.col("before") + F.col("place") - 1).withColumn("part", F.floor(F.col("idx") / PART)).drop("salt", "range", "place", "before")


def _levels(digests: list[str], n: int) -> list[list[str]]:
    """The nodes of a part from its leaves to its root: three levels up in a tree of several parts, else until one is left."""
    levels, k = [digests], 1
    while k < n and k < PART:
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
        k *= FANOUT
    return levels


def butterfly(parts: DataFrame) -> DataFrame:
    """tree, part, parts, node (the part's root) to the same with node: the tree's root, and steps: the way up.

    In round r a subtree holds 16^r parts, each of which knows its root. Part c sends that root to the parts of its sibling
    subtrees with the same number within their subtree. A last subtree may hold fewer; its parts then send to several, so
    that each part gets exactly one root of each sibling. Groups hold 16 rows at most.
    """
    state = cut(parts.withColumn("steps", F.array().cast(STEPS)))
    most = state.agg(F.max("parts")).first()[0] or 0
    width = 1
    while width < most:
        state = cut(_round(state, width))
        width *= FANOUT
    return state


def _round(state: DataFrame, width: int) -> DataFrame:
    done, open_ = state.filter(F.col("parts") <= width), state.filter(F.col("parts") > width)
    size = lambda s: F.least(F.lit(width).cast("long"), F.col("parts") - s * width)  # noqa: E731  parts of subtree s
    rows = open_.select("tree", "part", "parts", "node", F.expr(f"part div {width}").alias("sub"), (F.col("part") % width).alias("low"))
    first = F.expr(f"sub div {FANOUT} * {FANOUT}")
    rows = rows.withColumn("to", F.explode(F.sequence(first, F.least(first + FANOUT, F.ceil(F.col("parts") / width)) - 1)))
    places = F.when(F.col("to") == F.col("sub"), F.array("low")).when(F.col("low") < size(F.col("to")), F.sequence(F.col("low"), size(F.col("to")) - 1, size(F.col("sub"))))
    sent = rows.withColumn("place", F.explode(places)).select("tree", (F.col("to") * width + F.col("place")).alias("part"), F.struct("sub", "node").alias("got"))
    met = sent.groupBy("tree", "part").agg(F.sort_array(F.collect_list("got")).alias("run"))
    met = open_.join(met, ["tree", "part"])
    mine = F.expr(f"part div {width}")
    step = F.struct((mine % FANOUT).cast("int").alias("place"), F.transform(F.filter("run", lambda x: x["sub"] != mine), lambda x: x["node"]).alias("others"))
    up = F.sha2(F.array_join(F.transform("run", lambda x: x["node"]), ""), 256)
    return done.unionByName(met.select("tree", "part", "parts", up.alias("node"), F.concat("steps", F.array(step)).cast(STEPS).alias("steps")))


def part_roots(rows: DataFrame) -> DataFrame:
    """tree, part, parts, node of numbered rows (tree, part, idx, n, leaf). A part has 4,096 rows at most."""
    import pyarrow as pa

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("idx")
        n = part.column("n")[0].as_py()
        node = _levels(part.column("leaf").to_pylist(), n)[-1][0]
        return pa.table({"tree": part.column("tree")[:1], "part": part.column("part")[:1], "parts": pa.array([-(-n // PART)], pa.int64()), "node": pa.array([node], pa.string())})

    return rows.select("tree", "part", "idx", "n", "leaf").groupBy("tree", "part").applyInArrow(run, "tree string, part bigint, parts bigint, node string")


def _fold(node: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a digest and its siblings give."""
    for place, others in steps:
        node = hashlib.sha256("".join([*others[:place], node, *others[place:]]).encode()).hexdigest()
    return node


def proofs(rows: DataFrame, ways: DataFrame, keep: bool = False) -> DataFrame:
    """Numbered rows (doc_id, leaf, claimed too) with proof_sha256, the digest of all siblings on the way up, and
    folded_root, which the claimed digest and those siblings give. ways: tree, part, subroot, root, steps.

    keep=True adds the siblings themselves (``proof``: place in the run, the others; from the leaf's run upwards).
    """
    import pyarrow as pa

    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + f", proof {STEPS}" * keep
    steps_type = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))

    def run(part: pa.Table, way: pa.Table) -> pa.Table:
        part = part.sort_by("idx")
        leaves, claimed, way = part.column("leaf").to_pylist(), part.column("claimed").to_pylist(), way.to_pylist()[0]
        levels = _levels(leaves, part.column("n")[0].as_py())
        above = [(s["place"], s["others"]) for s in way["steps"]]
        ways_up: dict[tuple[int, int], list] = {}  # of the nodes above the leaves, shared by all that lie below them

        def up(level: int, i: int) -> list:
            if level + 1 >= len(levels):
                return above
            if (level, i) not in ways_up:
                first = i - i % FANOUT
                others = levels[level][first:i] + levels[level][i + 1 : first + FANOUT]
                ways_up[level, i] = [(i % FANOUT, others), *up(level + 1, i // FANOUT)]
            return ways_up[level, i]

        digests, folded, kept = [], [], []
        for i in range(len(leaves)):
            steps = up(0, i)
            digests.append(hashlib.sha256("".join(x for _, others in steps for x in others).encode()).hexdigest())
            folded.append(_fold(claimed[i], steps))
            if keep:
                kept.append([{"place": p, "others": o} for p, o in steps])
        n = len(leaves)
        out = {"doc_id": part.column("doc_id"), "leaf": part.column("leaf"), "subroot": pa.array([way["subroot"]] * n), "root": pa.array([way["root"]] * n), "proof_sha256": pa.array(digests), "folded_root": pa.array(folded)}
        return pa.table(out | ({"proof": pa.array(kept, steps_type)} if keep else {}))

    left = rows.select("tree", "part", "idx", "n", "doc_id", "leaf", "claimed").groupBy("tree", "part")
    return left.cogroup(ways.select("tree", "part", "subroot", "root", "steps").groupBy("tree", "part")).applyInArrow(run, shape)


def manifest(docs: DataFrame, claimed: Column | None = None, keep: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, leaf, subroot (of its source), root, proof_sha256, folded_root, verified.

    claimed: digest of the row as someone shows it (the leaf unless given); it is folded with the original siblings, and
    verified says whether that gives the root. Within a source, rows are in order of doc_id, nulls first, then of the
    leaf; sources in order of bytes, null first. Rows that repeat are leaves of their own. Of docs, only doc_id, source,
    lang, n_chars and text are read; text never leaves the first pass. An empty table gives an empty table.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))  # null sorts first and is no text
    rows = docs.select(tree.alias("tree"), "doc_id", leaf().alias("leaf"), (leaf() if claimed is None else claimed).alias("claimed"))
    rows = cut(numbered(rows, ["doc_id", "leaf"]))
    parts = butterfly(part_roots(rows))
    sources = parts.filter("part = 0").select(F.lit("").alias("tree"), F.col("tree").alias("doc_id"), F.col("node").alias("leaf"), F.col("node").alias("claimed"))
    sources = cut(numbered(sources, ["doc_id"]))
    tops = butterfly(part_roots(sources)).select("tree", "part", F.col("node").alias("subroot"), F.col("node").alias("root"), "steps")
    tops = proofs(sources, tops, keep=True).select(F.col("doc_id").alias("tree"), "root", F.col("proof").alias("above"))
    ways = parts.select("tree", "part", F.col("node").alias("subroot"), "steps").join(tops, "tree")
    ways = ways.select("tree", "part", "subroot", "root", F.concat("steps", "above").alias("steps"))
    return proofs(rows, ways, keep).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents; of every fifth, by the checksum of its id, a text with capitals lost is shown."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf(lowered)).otherwise(leaf())
    return manifest(docs, shown)


OP13_SQL = """
with recursive l as (
  select doc_id, coalesce('s' || source, '') as tree,
    concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head, text,
    case when xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda x, e: xor(xor(x, e) // 2, 3988292384 * (xor(x, e) % 2))), 4294967295) % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as shown
  from documents
), o as (
  select *, row_number() over (partition by tree order by doc_id, leaf) - 1 as idx, count(*) over (partition by tree) as n
  from (select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf, sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) as claimed from l)
), up as (
  select tree, 0 as level, idx, leaf as node, n from o
  union all select tree, level + 1, idx // 16, sha256(string_agg(node, '' order by idx)), (n + 15) // 16 from up where n > 1 group by tree, level, idx // 16, n
), s as (
  select tree, node as subroot, row_number() over (order by tree) - 1 as idx, count(*) over () as n from up where n = 1
), top as (
  select 0 as level, idx, subroot as node, n from s
  union all select level + 1, idx // 16, sha256(string_agg(node, '' order by idx)), (n + 15) // 16 from top where n > 1 group by level, idx // 16, n
), below as (
  select o.doc_id, string_agg(u.node, '' order by u.level, u.idx) as proof from o join up u on u.tree = o.tree and u.n > 1
    and u.idx // 16 = o.idx // (16 ** u.level)::bigint // 16 and u.idx <> o.idx // (16 ** u.level)::bigint group by o.doc_id
), above as (
  select s.tree, string_agg(t.node, '' order by t.level, t.idx) as proof from s join top t on t.n > 1
    and t.idx // 16 = s.idx // (16 ** t.level)::bigint // 16 and t.idx <> s.idx // (16 ** t.level)::bigint group by s.tree
), f as (
  select doc_id, tree, 0 as level, idx, claimed as node, n from o
  union all select f.doc_id, f.tree, f.level + 1, f.idx // 16, sha256(string_agg(case when u.idx = f.idx then f.node else u.node end, '' order by u.idx)), (f.n + 15) // 16
  from f join up u on u.tree = f.tree and u.level = f.level and u.idx // 16 = f.idx // 16 where f.n > 1 group by f.doc_id, f.tree, f.level, f.idx, f.n
), g as (
  select f.doc_id, 0 as level, s.idx, f.node, s.n from f join s on s.tree = f.tree where f.n = 1
  union all select g.doc_id, g.level + 1, g.idx // 16, sha256(string_agg(case when t.idx = g.idx then g.node else t.node end, '' order by t.idx)), (g.n + 15) // 16
  from g join top t on t.level = g.level and t.idx // 16 = g.idx // 16 where g.n > 1 group by g.doc_id, g.level, g.idx, g.n
)
select o.doc_id, o.leaf, s.subroot, r.node as root, sha256(coalesce(below.proof, '') || coalesce(above.proof, '')) as proof_sha256, g.node as folded_root, g.node = r.node as verified
from o join s on s.tree = o.tree join top r on r.n = 1 join g on g.doc_id = o.doc_id and g.n = 1 left join below on below.doc_id = o.doc_id left join above on above.tree = o.tree
"""
