"""Packing token sequences by cutting-stock column generation.

Documents that fit a sequence are packed whole, at their own lengths. Lengths are rounded up to a grid of ``UNIT`` ids;
a linear program over patterns (how many documents of each length share a sequence) is solved by column generation: the
knapsack over sequence capacity, by dynamic programming, prices the next pattern. Patterns are rounded down, what is
left is filled largest first, and documents take their places by rank within their length.

Rounding up leaves a gap at the end of a sequence. Gaps are filled from a flow of documents that are cut wherever a gap
ends: first the rests of documents longer than a sequence, which are cut anyway, then as few others as it takes, then
very short documents, most of which come to lie in sequences of their own.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import shared_automaton
from .common import cut, table, tune

CAPACITY, UNIT, END = 4096, 32, 2
#: Share by which the program may miss its optimum.
CLOSE = 1e-4
#: Documents of at most this many ids join the flow.
TINY = 64
#: One in how many documents may be cut to fill gaps, and into how many grades these are dealt by hash.
SPARE, GRADES = 8, 32
#: Pieces that one rank bucket should hold, and sequences whose gaps are filled together.
BUCKET_ROWS, TOGETHER = 10_000, 512
#: What may happen to a piece: it keeps its length, or it flows into gaps (in this order).
WHOLE, REST, OTHER, SHORT = 0, 1, 2, 3


def best_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = lengths <= room
        got = np.where(fits, best[room - lengths * fits] + values, -1.0)
        k = int(got.argmax())
        if got[k] > best[room - 1] + 1e-12:
            best[room], choice[room] = got[k], k
        else:
            best[room], choice[room] = best[room - 1], -2
    pattern, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0 and choice[room] != -1:
        if choice[room] == -2:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= int(lengths[choice[room]])
    return float(best[capacity]), pattern


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse by elimination, elementwise: threads of a BLAS need not have survived the start of the session's JVM."""
    m = len(a)
    both = np.concatenate([a.astype(np.float64), np.eye(m)], axis=1)
    for k in range(m):
        p = k + int(np.abs(both[k:, k]).argmax())
        both[[k, p]] = both[[p, k]]
        both[k] /= both[k, k]
        rest = np.arange(m) != k
        both[rest] -= both[rest, k][:, None] * both[k]
    return both[:, m:]


def cutting_stock(lengths: list[int], demand: list[int], capacity: int = CAPACITY) -> list[tuple[int, np.ndarray]]:
    """Patterns with their numbers of sequences, which hold exactly ``demand`` pieces of each of ``lengths``.

    Columns are priced until the program is within ``CLOSE``, or half a sequence, of its optimum: the number of sequences divided by the best
    pattern's value bounds the optimum from below (Farley 1990).
    """
    w, n = np.array(lengths, np.int64), np.array(demand, np.float64)
    m = len(w)
    n += 0.01 * np.arange(1, m + 1) / m  # no two bases have the same value, so that exchanges can't go round in circles
    if not m:
        return []
    basis = np.diag(capacity // w).astype(np.float64)
    inverse = np.diag(1.0 / np.diag(basis))
    x = inverse @ n
    for k in itertools.count():
        duals = inverse.sum(0)
        value, pattern = best_pattern(w, np.maximum(duals, 0), capacity)
        if value <= 1 + CLOSE or x.sum() * (1 - 1 / value) < 0.5:
            break
        column = inverse @ pattern
        ratio = np.where(column > 1e-7, x / np.where(column > 1e-7, column, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        inverse[out] /= column[out]
        inverse -= np.outer(np.where(np.arange(m) == out, 0, column), inverse[out])
        if k % 50 == 49:
            inverse = inverted(basis)
        x = np.maximum(inverse @ n, 0)
    plan, left = [], np.array(demand, np.int64)
    for p in np.argsort(-x):
        pattern = basis[:, p].astype(np.int64)
        used = pattern > 0
        times = int(min(np.floor(x[p] + 1e-9), (left[used] // pattern[used]).min()))
        if times > 0:
            plan.append((times, pattern))
            left -= times * pattern
    order = np.argsort(-w)
    while left.any():
        pattern, room = np.zeros(m, np.int64), capacity
        for k in order:
            take = min(int(left[k]), room // int(w[k]))
            pattern[k] = take
            room -= take * int(w[k])
        times = max(1, int((left[pattern > 0] // pattern[pattern > 0]).min()))
        plan.append((times, pattern))
        left -= times * pattern
    return plan


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, unit: int = UNIT, keep_ids: bool = False) -> DataFrame:
    """What is packed, before gaps are filled. One scan.

    uid (unique), doc_id, start, length, ids_crc32, doc_tokens, kind, grade (of what may flow), ids (binary: little-endian
    unsigned 32-bit; where the piece may flow, or all where asked for).
    """
    import pyarrow as pa
    from pyspark import TaskContext

    spark = tune(docs.sparkSession)
    held = shared_automaton(spark, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    tiny = min(TINY, capacity // unit)

    def run(batches):
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows: list[list] = [[] for _ in range(9)]
            for i, ids in enumerate(held.value.encode(batch.column(1).to_pylist())):
                ids = np.append(ids, np.int32(END)).astype("<u4")
                total = len(ids)
                for at in range(0, total, capacity):
                    part = ids[at : at + capacity].tobytes()
                    n, uid = len(part) // 4, uid + 1
                    what = WHOLE if n == capacity else REST if total > capacity else SHORT if n <= tiny else WHOLE
                    grade = zlib.crc32(uid.to_bytes(8, "little")) % (SPARE * GRADES)
                    what = OTHER if what == WHOLE and n < capacity and grade < GRADES else what
                    row = (i, uid, at, n, zlib.crc32(part), total, what, grade % GRADES, part if keep_ids or what != WHOLE else None)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = [batch.column(0).take(pa.array(rows[0], pa.int64())), *(pa.array(x, t) for x, t in zip(rows[1:], kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens", "kind", "grade", "ids"])

    shape = f"doc_id {kind}, uid long, start long, length long, ids_crc32 long, doc_tokens long, kind int, grade int, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, shape)


def plan(counts: list, capacity: int, unit: int) -> tuple[list, list, int]:
    """What flows, and the patterns for the rest. counts: (kind, grade, class, number, ids), a row for each.

    Returns (kind, grade) that flow, slots (class, low rank, high rank, first sequence, each) and the number of sequences.
    """
    ids = lambda rows: sum(r[4] for r in rows)
    steps = sorted({(r[0], r[1]) for r in counts if r[0] in (REST, OTHER)})
    flows: list = []
    while True:  # what flows is taken out of the program, whose gaps shrink with it
        fixed = [r for r in counts if r[0] != SHORT and (r[0], r[1]) not in flows]
        demand: dict[int, int] = {}
        for r in fixed:
            demand[r[2]] = demand.get(r[2], 0) + r[3]
        demand = dict(sorted(demand.items(), reverse=True))
        patterns = cutting_stock(list(demand), list(demand.values()), capacity // unit)
        gaps = sum(times for times, _ in patterns) * capacity - ids(fixed)
        have = ids([r for r in counts if (r[0], r[1]) in flows])
        if have >= gaps or len(flows) == len(steps):
            break
        more, enough = len(flows) + 1, max(1.02 * gaps + capacity, 1.25 * have)  # few rounds, each with one program
        while more < len(steps) and ids([r for r in counts if (r[0], r[1]) in steps[:more]]) < enough:
            more += 1
        flows = steps[:more]
    slots, ranks, sequence = [], dict.fromkeys(demand, 0), 0
    for times, pattern in patterns:
        for size, each in zip(demand, pattern.tolist(), strict=True):
            if each:
                slots.append((size, ranks[size], ranks[size] + times * each, sequence, each))
                ranks[size] += times * each
        sequence += times
    return flows, slots, sequence


def placed(fixed: DataFrame, slots: list) -> DataFrame:
    """uid, sequence_id, offset of pieces (uid, size, length) that keep their lengths, by rank within their size."""
    spark = fixed.sparkSession
    sizes = fixed.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("size", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("size", "bucket").orderBy("uid")
    ranked = fixed.withColumn("own", F.row_number().over(own) - 1).join(sizes, ["size", "bucket"]).withColumn("rank", F.col("first") + F.col("own"))
    # At most as many slots as the grid has sizes, for each of as many patterns and of the few that rounding leaves.
    places = F.broadcast(spark.createDataFrame(slots, "s_size long, low long, high long, first_sequence long, each long"))
    ranked = ranked.join(places, (F.col("size") == F.col("s_size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    ranked = ranked.select("uid", "size", "length", (F.col("first_sequence") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).cast("long").alias("sequence_id"))
    along = Window.partitionBy("sequence_id").orderBy(F.col("size").desc(), "uid").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.select("uid", "length", "sequence_id", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("long").alias("offset"))


def flowing(flow: DataFrame, gaps: DataFrame, sequences: int, capacity: int, groups: int) -> DataFrame:
    """Pieces of the flow: uid, at (ids of the flowing piece before it), length, sequence_id, offset.

    flow: uid, kind, length; gaps: sequence_id, used. Both are dealt to ``groups``. In a group, gaps lie one after another on
    a line, new sequences follow, and the flow lies along the same line; between two neighbouring marks of either kind is
    one piece.
    """
    line = Window.partitionBy("g").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    begin = lambda df, n: df.withColumn("pos", F.coalesce(F.sum(n).over(line), F.lit(0)).cast("long"))
    holes = gaps.filter(F.col("used") < capacity).select(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("g"), F.lit(0).alias("order"), F.col("sequence_id").alias("key"), "used", (capacity - F.col("used")).alias("n"))
    poured = flow.select(F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("g"), F.col("kind").alias("order"), F.col("uid").alias("key"), F.col("length").alias("n"))
    total = lambda df, name: df.groupBy("g").agg(F.sum("n").alias(name))
    more = total(poured, "poured").join(total(holes, "held"), "g", "left").withColumn("held", F.coalesce("held", F.lit(0))).filter("poured > held")
    new = more.select("g", F.col("held"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("poured") - F.col("held") - 1) / capacity))).alias("k"))
    new = new.select("g", (F.col("held") + F.col("k") * capacity).alias("pos"), F.struct((sequences + F.col("k") * groups + F.col("g")).alias("id"), F.lit(0).cast("long").alias("used"), (F.col("held") + F.col("k") * capacity).alias("pos")).alias("hole"))
    hole = begin(holes, "n").select("g", "pos", F.struct(F.col("key").alias("id"), F.col("used").cast("long").alias("used"), "pos").alias("hole")).unionByName(new)
    doc = begin(poured, "n").select("g", "pos", F.struct(F.col("key").alias("uid"), "n", "pos").alias("doc"))
    marks = hole.unionByName(doc, allowMissingColumns=True)
    marks = marks.withColumn("rank", F.when(F.col("doc").isNull(), F.col("hole.id")).otherwise(F.col("doc.uid")))
    order = Window.partitionBy("g").orderBy("pos", F.col("doc").isNull(), "rank")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = marks.select("pos", F.lead("pos").over(order).alias("next"), F.last("hole", True).over(so_far).alias("hole"), F.last("doc", True).over(so_far).alias("doc"))
    stop = F.least(F.coalesce("next", F.lit(2**62)), F.col("doc.pos") + F.col("doc.n"), F.col("hole.pos") + capacity - F.col("hole.used"))
    cuts = cuts.filter("doc is not null and hole is not null").withColumn("length", stop - F.col("pos")).filter("length > 0")
    return cuts.select(F.col("doc.uid").alias("uid"), (F.col("pos") - F.col("doc.pos")).alias("at"), "length", F.col("hole.id").alias("sequence_id"), (F.col("hole.used") + F.col("pos") - F.col("hole.pos")).alias("offset"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, unit: int = UNIT, keep_ids: bool = False) -> DataFrame:
    """Place all ids of docs in sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Null and empty texts are documents of one id, the end. Texts of any length are encoded whole. Repeated rows are
    documents of their own; a null doc_id is one like any other. An empty table gives no rows. Other columns are not
    read. The driver sees the histogram of lengths: at most capacity / unit rows for each kind and grade, whatever the input.
    """
    import pyarrow as pa

    done = cut(pieces(docs, path, capacity, unit, keep_ids))
    sized = done.withColumn("size", F.ceil(F.col("length") / unit))
    counts = sized.groupBy("kind", F.when(F.col("kind").isin(REST, OTHER), F.col("grade")).otherwise(0).alias("grade"), "size").agg(F.count(F.lit(1)), F.sum("length"))
    counts = [tuple(r) for r in counts.collect()]
    flows, slots, sequences = plan(counts, capacity, unit)
    flow = F.col("kind") == SHORT
    for kind, grade in flows:
        flow = flow | ((F.col("kind") == kind) & (F.col("grade") == grade))
    buckets = max(1, -(-sum(r[3] for r in counts) // BUCKET_ROWS))
    fixed = cut(placed(sized.filter(~flow).select("uid", "size", "length", F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int").alias("bucket")), slots))
    gaps = fixed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    volume = sum(r[4] for r in counts if r[0] == SHORT or (r[0], r[1]) in flows)
    groups = max(1, -(-sequences // TOGETHER), -(-volume // (TOGETHER * capacity)))
    poured = flowing(sized.filter(flow).select("uid", "kind", "length"), gaps, sequences, capacity, groups)
    pieces_of = fixed.withColumn("at", F.lit(0).cast("long")).unionByName(poured)
    about = done.select("uid", "doc_id", "start", "ids_crc32", "doc_tokens", "ids", F.col("length").alias("whole"))
    rows = pieces_of.join(about, "uid").withColumn("ids", F.substr("ids", (4 * F.col("at") + 1).cast("int"), (4 * F.col("length")).cast("int")))
    crc = F.when(F.col("length") < F.col("whole"), F.crc32("ids")).otherwise(F.col("ids_crc32")).alias("ids_crc32")
    rows = rows.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "length", crc, "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else []))
    if not keep_ids:
        return rows

    def run(batches):
        for batch in batches:
            ids = batch.column(7).cast(pa.binary())  # of whole ids: its bytes are the lists' values
            ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1] // 4
            values = np.frombuffer(ids.buffers()[2] or b"", "<i4")[ends[0] : ends[-1]]
            lists = pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], lists], names=batch.schema.names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")


def op3_packing(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents packed into sequences of 4096: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    from .vocab import vocabulary

    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), path or vocabulary("word_bpe_49k.json"))
