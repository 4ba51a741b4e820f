"""Near-duplicate embeddings by a random-projection tree forest.

Each tree splits recursively along the difference of two random sample points, at the sample's median, with a spill band
around it whose vectors go to both sides. The upper levels are fitted on one bounded sample; leaves that are still too
large are split further by trees fitted on a sample of their own rows, level by level, until leaves have one size
whatever the input. Vectors are compared within leaves, in double precision, by matrix products.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, table, tune
from .components import connected_components

COSINE = 0.95
TREES = 8
#: Share of a node's vectors, on each side of the median, that goes to both sides.
SPILL = 0.06
#: Vectors that a leaf should hold, and a node's sample points below which it isn't split.
LEAF, LEAST = 512, 32
#: Rows that the upper levels are fitted on at most, and the vector lengths (the most frequent ones) that they are fitted
#: for; other lengths begin with one leaf a tree. All rows are indexed.
SAMPLE_ROWS, WIDTHS = 20_000, 8
#: Leaves of more vectors are split further. Those that can't be (they hold near-equal vectors) are compared in blocks of
#: about this many, each pair of blocks by itself.
BLOCK = 2048
#: Rows that a split of one leaf is fitted on, about, and rows of a leaf that a task sends down the new tree.
OWN_ROWS, ROUTED_ROWS = 1024, 50_000
#: Levels of further splits; each makes leaves some 30 times smaller.
LEVELS = 16
#: Oversized leaves (8 bytes each) that may be broadcast.
BROADCAST_ROWS = 100_000


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@dataclass
class Forest:
    """Trees over vectors of one length. Inner nodes: direction, bounds of the spill band, children (negative: a leaf)."""

    roots: list[int]
    direction: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    first_leaf: int = 0

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of x and the leaves they are in, all trees; a row can be in several leaves of a tree."""
        rows, out = [], []
        stack = [(root, np.arange(len(x))) for root in self.roots]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                out.append(np.full(len(at), -node - 1 + self.first_leaf, np.int64))
                continue
            p = x[at] @ self.direction[node]
            stack.append((int(self.child[node, 0]), at[p <= self.high[node]]))
            stack.append((int(self.child[node, 1]), at[p >= self.low[node]]))
        return np.concatenate(rows), np.concatenate(out)


def fit_forest(sample: np.ndarray, total: int, seed: int, first_leaf: int = 0, trees: int = TREES, size: int = LEAF, least: int = LEAST) -> tuple[Forest, int]:
    """Fit on unit rows that stand for ``total`` vectors; also how many leaves there are."""
    rng = np.random.default_rng(seed)
    direction, low, high, child, leaves = [], [], [], [], 0
    scale = max(1.0, total / max(1, len(sample)))

    def grow(x: np.ndarray) -> int:
        nonlocal leaves
        if len(x) * scale > size and len(x) >= least:
            for _ in range(4):
                a, b = x[rng.choice(len(x), 2, replace=False)]
                d = a - b
                if (far := np.sqrt(d @ d)) > 1e-9:
                    p = x @ (d / far)
                    lo, hi = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
                    left, right = x[p <= hi], x[p >= lo]
                    if max(len(left), len(right)) < 0.9 * len(x):
                        node = len(direction)
                        direction.append(d / far)
                        low.append(lo)
                        high.append(hi)
                        child.append([0, 0])
                        child[node] = [grow(left), grow(right)]
                        return node
        leaves += 1
        return -leaves

    roots = [grow(sample) for _ in range(trees)]
    width = sample.shape[1]
    return Forest(roots, np.array(direction).reshape(-1, width), np.array(low), np.array(high), np.array(child, np.int64).reshape(-1, 2), first_leaf), leaves


def _matrix(vectors) -> np.ndarray:
    """Unit rows of an Arrow list column whose lists have one length."""
    vectors = vectors.combine_chunks()
    return unit_rows(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def split_further(routed: DataFrame, block: int, size: int, least: int, own_rows: int, seed: int) -> DataFrame:
    """routed (id, v, weight, codes) with the codes of smaller leaves in place of those of more than ``block`` vectors.

    Each level draws about ``own_rows`` of each large leaf, fits one tree on them, and sends the leaf's rows down, at most
    ROUTED_ROWS of a leaf in a task. A leaf that no direction splits keeps its rows under a code that is not tried again.
    """
    import pyarrow as pa

    kind = routed.schema["id"].dataType.simpleString()
    vectors, placed, stuck, changed = routed.select("id", "v"), routed.select("id", F.explode("codes").alias("leaf")), None, False
    for level in range(LEVELS):
        large = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
        large = cut(large if stuck is None else large.join(stuck, "leaf", "left_anti"))
        if large.isEmpty():
            break
        rows = placed.join(large, "leaf").join(vectors, "id").withColumn("salts", F.ceil(F.col("size") / ROUTED_ROWS))
        drawn = F.shiftrightunsigned(F.xxhash64("id", "leaf", F.lit(seed + level)), 11) / float(1 << 53) < own_rows / F.col("size")

        def fit(group):
            leaf, total = group["leaf"][0].as_py(), group["size"][0].as_py()
            forest, leaves = fit_forest(_matrix(group["v"]), total, abs(leaf) % (1 << 31) + seed + level, 0, 1, size, least)
            return pa.table({"leaf": pa.array([leaf]), "tree": pa.array([pickle.dumps(forest)], pa.binary()), "leaves": pa.array([leaves]), "salts": group["salts"].slice(0, 1)})

        def send(key, group, trees):
            if not trees.num_rows or not group.num_rows:
                return pa.table({"id": group["id"].slice(0, 0), "leaf": pa.array([], pa.int64())})
            at, new = pickle.loads(trees["tree"][0].as_py()).leaves(_matrix(group["v"]))
            parent = np.uint64(group["leaf"][0].as_py() & (2**64 - 1))
            code = (mix64(mix64(parent + np.zeros(len(new), np.uint64)) + new.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
            return pa.table({"id": group["id"].take(pa.array(at)), "leaf": pa.array(code)})

        fitted = cut(rows.filter(drawn).select("leaf", "size", "salts", "v").groupBy("leaf").applyInArrow(fit, "leaf long, tree binary, leaves long, salts long"))
        split = fitted.filter("leaves > 1")
        dealt = rows.join(split.select("leaf"), "leaf", "left_semi").select("leaf", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "id", "v")
        trees = split.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "tree")
        moved = dealt.groupBy("leaf", "salt").cogroup(trees.groupBy("leaf", "salt")).applyInArrow(send, f"id {kind}, leaf long")
        still = large.join(split, "leaf", "left_anti").select("leaf")
        stuck = cut(still if stuck is None else still.unionByName(stuck))
        placed, changed = cut(placed.join(split.select("leaf"), "leaf", "left_anti").unionByName(moved)), True
    if not changed:
        return routed
    codes = placed.groupBy("id").agg(F.sort_array(F.collect_set("leaf")).alias("codes"))  # some TREES times the spill
    return cut(routed.drop("codes").join(codes, "id").select("id", "v", "weight", "codes"))


def _compare(least: float):
    import pyarrow as pa

    def run(group):
        leaf, i, j = group["leaf"][0].as_py(), group["i"][0].as_py(), group["j"][0].as_py()
        n = group.num_rows
        ids = group["id"].combine_chunks().to_numpy(zero_copy_only=False)
        block, weight = group["block"].to_numpy(), group["weight"].to_numpy()
        x = _matrix(group["v"])
        codes = group["codes"].combine_chunks()
        lens = np.asarray(codes.value_lengths())
        code = np.full((n, int(lens.max())), -1, np.int64)
        code[np.repeat(np.arange(n), lens), np.concatenate([np.arange(k) for k in lens])] = codes.flatten().to_numpy()
        links = np.zeros(n, np.int64)
        found = []
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        for at in range(0, len(left), 256):
            a = left[at : at + 256]
            p, q = np.nonzero(x[a] @ x[right].T >= least)
            p, q = a[p], right[q]
            good = p < q if i == j else np.ones(len(p), bool)
            p, q = p[good], q[good]
            for s in range(0, len(p), 65536):  # a pair counts in the first leaf that it shares
                u, v = p[s : s + 65536], q[s : s + 65536]
                earlier = np.zeros(len(u), bool)
                for k in range(code.shape[1]):
                    c = code[u, k]
                    earlier |= (c >= 0) & (c < leaf) & (code[v] == c[:, None]).any(1)
                u, v = u[~earlier], v[~earlier]
                np.add.at(links, u, weight[v])
                np.add.at(links, v, weight[u])
                found.append((u, v))
        root = np.arange(n)
        if found:
            u, v = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            order = np.argsort(np.argsort(ids))  # labels are places by id, so that the least id wins
            root = order.copy()
            while True:
                m = np.minimum(root[u], root[v])
                new = root.copy()
                np.minimum.at(new, u, m)
                np.minimum.at(new, v, m)
                if (new == root).all():
                    break
                root = new
            back = np.argsort(order)
            root = back[root]
        on = np.flatnonzero(links > 0)
        return pa.table({"id": pa.array(ids[on]), "links": pa.array(links[on]), "root": pa.array(ids[root[on]])})

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", column: str = "embedding", seed: int = 11) -> DataFrame:
    """Links and components of vectors whose cosine, in double precision, is at least ``cosine``.

    Equal vectors are one class with a weight. The forest's upper levels are fitted on ``SAMPLE_ROWS`` rows at most; every
    class is indexed in every tree, large leaves are split further, what can't be split is compared in pairs of blocks, and a pair that shares several leaves is
    counted in the first. A task returns each vector's links and its local component, never the pairs. A link below
    the threshold is never reported; one above is missed only if spill splits part the two in all ``TREES`` trees.

    Returns vec_id, n_links, component_id, kept. Vectors that are null, zero, or hold null or non-finite components link
    with nothing, and so do vectors of different lengths. Repeated rows are vectors of their own with the same id.
    Other columns are not read.
    """
    import pyarrow as pa

    spark = tune(vectors.sparkSession)
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("fine", fine & F.col("id").isNotNull()).withColumn("h", F.xxhash64("v"))
    classes = cut(rows.filter("fine").groupBy("h", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")))
    forests, leaves = {}, 0
    widths = classes.groupBy(F.size("v").alias("width")).count().orderBy(F.col("count").desc(), "width").limit(WIDTHS).collect()
    for width, total in sorted(map(tuple, widths)):
        share = min(1.0, SAMPLE_ROWS / len(widths) / total)
        unit = F.shiftrightunsigned(F.xxhash64("rep", F.lit(seed)), 11) / float(1 << 53)
        sample = np.array([r.v for r in classes.filter((F.size("v") == width) & (unit < share)).select("rep", "v").orderBy("rep").collect()], np.float64).reshape(-1, width)
        if len(sample):
            forests[width], more = fit_forest(unit_rows(sample), total, seed, leaves)
            leaves += more
    held = spark.sparkContext.broadcast(forests)

    def route(batches):
        for batch in batches:
            lists = batch.column(1)
            widths = np.asarray(lists.value_lengths())
            codes = [np.zeros(0, np.int64)] * len(widths)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(widths)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                if width not in held.value:  # a rare length: a leaf for each tree, to be split where it is large
                    for k in at:
                        codes[k] = (1 << 40) + int(width) * TREES + np.arange(TREES)
                    continue
                x = unit_rows(flat[(ends[at] - width)[:, None] + np.arange(width)])
                r, leaf = held.value[int(width)].leaves(x)
                order = np.lexsort((leaf, r))
                r, leaf = r[order], leaf[order]
                for k, part in zip(at, np.split(leaf, np.searchsorted(r, np.arange(1, len(at)))), strict=True):
                    codes[k] = part
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=["id", "v", "weight", "codes"])

    routed = cut(classes.select(F.col("rep").alias("id"), "v", "weight").mapInArrow(route, f"id {kind}, v array<double>, weight long, codes array<long>"))
    routed = split_further(routed, BLOCK, LEAF, LEAST, OWN_ROWS, seed)
    sizes = routed.select(F.explode("codes").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > BLOCK)
    sizes = cut(sizes.select("leaf", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    placed = routed.withColumn("leaf", F.explode("codes")).join(F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes, "leaf", "left")
    placed = placed.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "block", "weight", "v", "codes")
    found = cut(dealt.groupBy("leaf", "i", "j").applyInArrow(_compare(cosine), f"id {kind}, links long, root {kind}"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.select("h", F.col("v").alias("class_v"), "rep", "weight").join(counts, F.col("rep") == F.col("id"), "left").drop("id")
    named = named.join(components, F.col("rep") == F.col("id"), "left").drop("id")
    named = cut(named.select("h", "class_v", "rep", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    r, c = rows.alias("r"), named.alias("c")
    out = r.join(c, F.col("r.fine") & (F.col("r.h") == F.col("c.h")) & (F.col("r.v") == F.col("c.class_v")), "left")
    out = out.select(F.col("r.id").alias(key), F.coalesce("c.n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c.component", "r.id").alias("component_id"))
    return out.withColumn("kept", F.col(key) == F.col("component_id"))


def op6_forest(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of embeddings: vec_id, n_links, component_id, kept."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
