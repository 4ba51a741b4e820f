"""Document fingerprints by winnowing, with DataFrame functions only.

Every ``K`` consecutive code points are hashed, rolling over the text one code point at a time; of every ``WINDOW``
consecutive hashes the least is picked, of equal ones the rightmost. So two texts that share ``K + WINDOW - 1`` code
points in a row share a pick, and each pick's position says where. A text's picks are its fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Code points that are hashed together, and hashes of which one is picked. A match of K + WINDOW - 1 = 47 is never missed.
K, WINDOW = 16, 32
#: The greatest 31-bit number: hashes have 31 bits, and positions count down from it, so that the least is the rightmost.
TOP = (1 << 31) - 1
HASH = TOP << 32
#: Ranges that ids are cut into, for each shuffle partition of the session.
RANGES = 4


def none_() -> Column:
    """No picks."""
    return F.array().cast("array<bigint>")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _points(text: Column) -> Column:
    """Four bytes a code point: any gram is cut out in constant time. Texts shorter than a gram are filled up with bytes
    that are no code point."""
    return F.rpad(F.encode(text, "UTF-32"), F.greatest(F.length(text), F.lit(K)) * 4, b"\xff")


def _minima(points: Column, start: Column, stop: Column, at_least: Column) -> Column:
    """The least of each window over the grams of code points start to stop, as hash << 32 | TOP - position.

    The minimum of 32 is made of those of 4, 16 and 32 by three passes; past the end there is null, which least() skips.
    """
    grams = F.greatest(stop - start - (K - 1), F.lit(1))
    windows = F.greatest(grams - (WINDOW - 1), at_least)

    def gram(i):
        return F.xxhash64(F.substring(points, i * 4 + 1, F.lit(4 * K))).bitwiseAND(HASH).bitwiseOR((F.lit(TOP) - i).cast("long"))

    def four(a, step):
        return F.transform(a, lambda x, i: F.least(x, F.get(a, i + step), F.get(a, i + 2 * step), F.get(a, i + 3 * step)))

    hashes = F.transform(F.sequence(start, start + grams - 1), gram)
    sixteen = _let(_let(hashes, lambda a: four(a, 1)), lambda a: four(a, 4))
    both = _let(sixteen, lambda a: F.zip_with(a, F.slice(a, F.lit(17), F.greatest(F.size(a) - 16, F.lit(0))), lambda x, y: F.least(x, y)))
    return F.when(windows > 0, F.slice(both, F.lit(1), windows)).otherwise(none_())


def picks(text: Column) -> Column:
    """A text's fingerprint: hash << 32 | TOP - position of each pick, in order of position. An empty text has none."""
    n = F.length(text)
    found = _let(_points(text), lambda b: F.array_distinct(_minima(b, F.lit(0), n, F.lit(1))))
    return F.when(n > 0, found).otherwise(none_())


def positions(found: Column) -> Column:
    """Where each pick's gram begins, in code points."""
    return F.transform(found, lambda x: (F.lit(TOP) - x.bitwiseAND(TOP)).cast("int"))


def hashes(found: Column) -> Column:
    """The distinct hashes of picks."""
    return F.array_distinct(F.transform(found, lambda x: F.shiftright(x, 32).cast("int")))


def spelled(found: Column) -> Column:
    """Picks as text: position:hash in hexadecimal, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat((F.lit(TOP) - x.bitwiseAND(TOP)).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftright(x, 32))))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets; 1 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(1.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with their picks; positions() and spelled() read them. Null texts count as empty."""
    return docs.withColumn("picks", picks(F.coalesce("text", F.lit(""))))


# ---- neighbours in order of ids

#: Key of a document, in the order of the circle: null ids last, greater ids first, texts of one id by their hash.
PLACE = ["no_id", "down", "text_hash"]


def _placed(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), F.bitwise_not(F.coalesce("doc_id", F.lit(0)).cast("long")).alias("down"), F.xxhash64(text).alias("text_hash")).alias("place"), *more)


def _starts(places: DataFrame) -> DataFrame:
    """One row: starts, the first place of each range that places are cut into, in order, in blocks, and their number.

    A range for each partition of a range shuffle, so there are as many as the session asks for, whatever the rows.
    """
    n = RANGES * int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = places.repartitionByRange(n, "place").groupBy(F.spark_partition_id().alias("range")).agg(F.min("place").alias("place"))
    block = max(1, int(n**0.5))
    firsts = ranges.agg(F.sort_array(F.collect_list("place")).alias("all"))
    blocks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(all) - 1) div {block}").cast("int")), lambda k: F.slice("all", k * block + 1, F.lit(block)))
    return cut(firsts.filter(F.size("all") > 0).select(blocks.alias("blocks"), F.transform(blocks, lambda b: b[0]).alias("heads"), F.size("all").alias("ranges"), F.lit(block).alias("block")))


def in_circle(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Each document (place, text, doc_id) with range, and the first of each range once more as guest of the range before.

    So within a range, in order of guest and place, each document but the guest stands before its next one. The second
    frame counts documents that repeat (place, copies), if there are any; of those, one row stands for all.
    """
    keys = cut(_placed(docs).groupBy("place").agg(F.count(F.lit(1)).alias("copies")))
    rows, repeated = _placed(docs, "doc_id", F.coalesce("text", F.lit("")).alias("text")), keys.filter("copies > 1")
    if repeated.isEmpty():
        repeated = None
    else:
        rows = rows.groupBy("place").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    rows = rows.crossJoin(F.broadcast(_starts(keys.select("place"))))  # one row
    before = lambda a: F.size(F.filter(a, lambda s: s <= F.col("place"))) - 1
    rows = rows.withColumn("k", before("heads")).withColumn("b", F.get("blocks", F.col("k"))).withColumn("j", before("b"))
    own = F.col("k") * F.col("block") + F.col("j")
    first = F.get("b", F.col("j")) == F.col("place")
    last = F.when(own > 0, own - 1).otherwise(F.col("ranges") - 1)
    seats = F.when(first, F.array(F.struct(own.alias("range"), F.lit(False).alias("guest")), F.struct(last.alias("range"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct(own.alias("range"), F.lit(False).alias("guest"))))
    return rows.select("place", "doc_id", "text", F.explode(seats).alias("s")).select("place", "doc_id", "text", "s.range", "s.guest"), repeated


def with_edits(docs: DataFrame) -> DataFrame:
    """Each document with the picks of its text, those of its edited text, and the hashes of the next document's.

    The next document is the one with the greatest smaller doc_id, for the last the first; of one id, texts are in the
    order of their hash. The edited text has the last third (rounded down) of the code points replaced by the first as
    many of the next document's. Returns doc_id, n_chars, edited, picks, edited_picks, next_hashes.

    Texts are shuffled once, to ranges of ids, and fingerprinted there; the next document is a row's neighbour. Windows
    that lie before the edit are computed once for both texts. Rows that repeat doc_id and text are one document with one
    result for each row. Null texts are empty, null ids come last. An empty table gives an empty table; a document alone
    is its own next one. Other columns are not read.
    """
    rows, repeated = in_circle(docs)
    rows = rows.repartition("range").withColumn("n", F.length("text"))  # what follows is computed where the rows arrive
    rows = rows.withColumn("stays", (F.col("n") - F.floor(F.col("n") / 3)).cast("int"))
    shared = F.greatest(F.col("stays") - (K + WINDOW - 2), F.lit(0))  # windows before the edit
    both = lambda m: F.struct(F.array_distinct(m).alias("picks"), F.size(F.array_distinct(F.slice(m, F.lit(1), F.col("shared")))).alias("inside"))
    rows = rows.withColumn("shared", shared)
    rows = rows.withColumn("f", F.when(F.col("n") > 0, _let(_let(_points(F.col("text")), lambda b: _minima(b, F.lit(0), F.col("n"), F.lit(1))), both)).otherwise(F.struct(none_().alias("picks"), F.lit(0).alias("inside"))))
    rows = rows.select("range", "guest", "place", "doc_id", "text", "n", "stays", "shared", "f.picks", F.slice("f.picks", F.lit(1), F.col("f.inside")).alias("before"))
    following = Window.partitionBy("range").orderBy("guest", "place")
    rows = rows.withColumn("next", F.lead(F.struct("text", "picks")).over(following)).filter("not guest")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, stays)"), F.expr("substring(next.text, 1, n - stays)"))).withColumn("e", F.length("edited"))
    one = F.when(F.col("shared") > 0, F.lit(0)).otherwise(F.lit(1))
    rest = F.when(F.col("e") > 0, _let(_points(F.col("edited")), lambda b: _minima(b, F.col("shared"), F.col("e"), one))).otherwise(none_())
    rows = rows.select("place", "doc_id", F.col("n").cast("long").alias("n_chars"), "edited", "picks", F.array_distinct(F.concat("before", rest)).alias("edited_picks"), hashes(F.col("next.picks")).alias("next_hashes"))
    if repeated is not None:
        rows = rows.join(repeated, "place", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))))
    return rows.select("doc_id", "n_chars", "edited", "picks", "edited_picks", "next_hashes")


def op11_winnow(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how like they are."""
    rows = with_edits(table(spark, sf_dir, "documents", "doc_id", "text"))
    own, edited = hashes(F.col("picks")), hashes(F.col("edited_picks"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spelled(F.col("picks")).alias("fingerprint"), spelled(F.col("edited_picks")).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, F.col("next_hashes")).alias("near_next"),
    )


def _xxh64_sql() -> str:
    """Common table expressions from grams (doc_id, kind, pos, w0 to w7: 64 bytes as eight numbers) to hashed, with h, the
    31 bits that a pick keeps of the published 64-bit hash under seed 42. Arithmetic is modulo 2^64 in wider numbers."""
    # The hash's five primes, of which it uses four here.
    p1, p2, p3, p4 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579
    seed, m = 42, 1 << 64
    lanes = [(seed + p1 + p2) % m, (seed + p2) % m, seed, (seed - p1) % m]
    u = lambda x: f"{x}::uhugeint"
    mod = lambda x: f"(({x}) & {u(m - 1)})"
    turned = lambda x, r: f"({mod(f'{x} * {u(1 << r)}')} + ({x} >> {u(64 - r)}))"
    step = lambda x: mod(f"{turned(x, 31)} * {u(p1)}")
    shifted = lambda x, r: f"xor({x}, {x} >> {u(r)})"
    merged = "e"
    for j in range(4):
        merged = mod(f"xor({merged}, q{j}) * {u(p1)} + {u(p4)}")
    stages = [
        ("x1", "grams", [*(f"w{j}" for j in range(4, 8)), *(f"{mod(f'{u(lanes[j])} + {mod(f"w{j} * {u(p2)}")}')} as a{j}" for j in range(4))]),
        ("x2", "x1", [*(f"w{j}" for j in range(4, 8)), *(f"{step(f'a{j}')} as b{j}" for j in range(4))]),
        ("x3", "x2", [f"{mod(f'b{j} + {mod(f"w{j + 4} * {u(p2)}")}')} as c{j}" for j in range(4)]),
        ("x4", "x3", [f"{step(f'c{j}')} as d{j}" for j in range(4)]),
        ("x5", "x4", [f"{mod(' + '.join(turned(f'd{j}', r) for j, r in enumerate((1, 7, 12, 18))))} as e", *(f"{mod(f'd{j} * {u(p2)}')} as r{j}" for j in range(4))]),
        ("x6", "x5", ["e", *(f"{step(f'r{j}')} as q{j}" for j in range(4))]),
        ("x7", "x6", [f"{mod(f'{merged} + {u(64)}')} as f"]),
        ("x8", "x7", [f"{mod(f'{shifted("f", 33)} * {u(p2)}')} as k"]),
        ("hashed", "x8", [f"(({mod(f'{shifted("k", 29)} * {u(p3)}')} >> {u(32)}) & {u(TOP)})::bigint as h"]),
    ]
    return ", ".join(f"{name} as (select doc_id, kind, pos, n, {', '.join(columns)} from {source})" for name, source, columns in stages)


def _op11_sql() -> str:
    swapped = "(c % 256) * 16777216 + (c // 256 % 256) * 65536 + (c // 65536 % 256) * 256"
    ahead = lambda j: f"lead(s, {j}, 4294967295) over w" if j else "s"
    words = ", ".join(f"({ahead(2 * j)})::uhugeint + ({ahead(2 * j + 1)})::uhugeint * 4294967296::uhugeint as w{j}" for j in range(K // 2))
    return f"""
with d as (
  select doc_id, coalesce(text, '') as text, coalesce(lead(doc_id) over (order by doc_id desc), max(doc_id) over ()) as next_id from documents
), e as (
  select d.doc_id, d.next_id, d.text, left(d.text, length(d.text) - length(d.text) // 3) || left(x.text, length(d.text) // 3) as edited from d join d x on x.doc_id = d.next_id
), chars as (
  select doc_id, kind, length(t) as n, unnest(range(length(t))) as pos, unnest(regexp_extract_all(t, '(?s).')) as ch
  from (select doc_id, 0 as kind, text as t from e union all select doc_id, 1, edited from e)
), s as (
  select doc_id, kind, n, pos, {swapped} as s from (select *, unicode(ch)::bigint as c from chars)
), grams as (
  select * from (select doc_id, kind, n, pos, {words} from s window w as (partition by doc_id, kind order by pos)) where pos <= greatest(n - {K}, 0)
), {_xxh64_sql()}, minima as (
  select doc_id, kind, pos, n, min(h * 2147483648 + ({TOP} - pos)) over (partition by doc_id, kind order by pos rows between current row and {WINDOW - 1} following) as m from hashed
), picks as (
  select distinct doc_id, kind, m // 2147483648 as h, {TOP} - m % 2147483648 as pos from minima where pos <= greatest(n - {K + WINDOW - 1}, 0)
), spelled as (
  select doc_id, kind, string_agg(pos || ':' || format('{{:x}}', h), ',' order by pos) as f from picks group by doc_id, kind
), sets as (
  select distinct doc_id, kind, h from picks
), sizes as (
  select doc_id, kind, count(*) as n from sets group by doc_id, kind
), pairs as (
  select doc_id, doc_id as other, 1 as kind from e union all select doc_id, next_id, 0 from e
), shared as (
  select p.doc_id, p.kind, count(*) as n from pairs p join sets a on a.doc_id = p.doc_id and a.kind = 0 join sets b on b.doc_id = p.other and b.kind = p.kind and b.h = a.h group by p.doc_id, p.kind
), near as (
  select p.doc_id, p.kind, case when coalesce(a.n, 0) + coalesce(b.n, 0) = 0 then 1e0 else coalesce(s.n, 0) / (coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(s.n, 0))::double end as likeness
  from pairs p left join sizes a on a.doc_id = p.doc_id and a.kind = 0 left join sizes b on b.doc_id = p.other and b.kind = p.kind left join shared s on s.doc_id = p.doc_id and s.kind = p.kind
)
select e.doc_id, length(e.text) as n_chars, sha256(e.edited) as edited_sha256, coalesce(f.f, '') as fingerprint, coalesce(g.f, '') as edited_fingerprint, x.likeness as near_edited, y.likeness as near_next
from e left join spelled f on f.doc_id = e.doc_id and f.kind = 0 left join spelled g on g.doc_id = e.doc_id and g.kind = 1 join near x on x.doc_id = e.doc_id and x.kind = 1 join near y on y.doc_id = e.doc_id and y.kind = 0
"""


OP11_SQL = _op11_sql()
