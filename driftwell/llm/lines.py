"""Line dedup by content-defined chunks of lines, with DataFrame functions only.

A rolling hash over the hashes of two neighbouring lines marks places where chunks begin, and others where they end. Both
marks look at lines of the chunk alone, so lines inserted before or after a passage change none of its chunks. There are
four families of marks, which complement each other: one bit of the hash begins chunks where it is set in two families and
where it isn't in the others, and likewise a second bit ends them. So any two neighbouring lines are a chunk of one
family, whatever their hash, and a passage of two lines is found wherever it repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table, text_key

#: Lines that a chunk has at most. A chunk whose end isn't marked by then is none; its lines are in chunks of other families.
MOST = 16
#: Bytes that may be broadcast.
BROADCAST_BYTES = 4 << 20


def few(df: DataFrame, size) -> DataFrame:
    """df, marked for broadcast if it is small. size: bytes of a row. df is a written table, so the sum costs little."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def _ends(lines: Column, ids: Column) -> Column:
    """For each line but the last, what the rolling hash over it and the next says: 0 to 3, one bit for the beginning of a
    chunk and one for its end; 4 for two blank lines, which are in no chunk."""
    blank = lambda i: F.trim(F.get(lines, i)) == ""
    pair = lambda x, i: F.when(blank(i) & blank(i + 1), F.lit(4)).otherwise(F.xxhash64(x, F.get(ids, i + 1)).bitwiseAND(3).cast("int"))
    return F.transform(F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))), pair)


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, stop (lines, end exclusive), key (hashes of its lines) of the chunks of every whole text.

    A chunk begins before any pair of lines whose first bit is the family's, and ends with the first pair whose second bit
    is the family's. At each line two of the four families begin one: a chunk ends at once in one of them, later in the other.
    """
    rows = docs.select(*text_key(), F.split("text", "\n").alias("lines")).filter(F.size("lines") > 1)
    rows = rows.withColumn("ids", F.transform("lines", lambda x: F.xxhash64(x)))
    rows = rows.withColumn("marks", _ends(F.col("lines"), F.col("ids")))

    def begun(_, i):
        ahead = lambda keep: F.array_position(F.transform(F.slice("marks", i + 1, F.lit(MOST - 1)), keep), True)
        blank = ahead(lambda m: m == 4)
        ends = [ahead(lambda m: F.shiftright(m, 1) == 0), ahead(lambda m: F.shiftright(m, 1) == 1)]
        spans = F.array(*(F.struct(i.alias("start"), F.when((e > 0) & ((blank == 0) | (e < blank)), i + 1 + e.cast("int")).alias("stop")) for e in ends))
        return F.filter(spans, lambda s: s["stop"].isNotNull())

    rows = rows.select("doc_id", "text_hash", "ids", F.explode(F.flatten(F.transform("marks", begun))).alias("s"))
    return rows.select("doc_id", "text_hash", "s.start", "s.stop", F.slice("ids", F.col("s.start") + 1, F.col("s.stop") - F.col("s.start")).alias("key"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, stop of the chunks to remove: those that begin earlier too (by doc_id, text_hash, line), in
    another document or, in the same, without overlap.

    Only hashes of lines are shuffled to find them; counts aggregate before they shuffle, and a chunk that many documents
    hold is split by adaptive execution in the join. Then the lines' bytes are compared: of each hash of a line that is to
    go, the least and the greatest text are one, or else the chunks that hold it stay.
    """
    all_ = cut(chunks(docs))
    place = F.struct("doc_id", "text_hash", "start")
    firsts = cut(all_.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").select("key", "first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    later = F.when(same, F.col("first.start") + F.size("key") <= F.col("start")).otherwise(F.lit(True))
    found = cut(all_.join(few(firsts, 40 + 8 * F.size("key")), "key").filter(later).select("doc_id", "text_hash", "start", "stop", "key"))
    ids = cut(found.select(F.explode("key").alias("id")).distinct())
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).withColumn("id", F.xxhash64("line"))
    if (ids.count()) * 8 <= BROADCAST_BYTES:
        lines = lines.join(F.broadcast(ids), "id", "left_semi")
    unlike = cut(lines.groupBy("id").agg(F.min("line").alias("least"), F.max("line").alias("most")).filter("least <> most").select("id"))
    found = found.drop("key") if unlike.isEmpty() else _without(found, unlike)
    return found


def _without(found: DataFrame, unlike: DataFrame) -> DataFrame:
    """The chunks none of whose lines' hashes stands for several texts."""
    bad = found.withColumn("id", F.explode("key")).join(unlike, "id").select("key").distinct()
    return found.join(bad, "key", "left_anti").drop("key")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs' rows without the repeated chunks: doc_id, n_lines, n_removed, kept (text).

    Null texts stay null, with no lines; an empty text has one empty line. Two blank lines in a row are in no chunk. Each
    line that goes stands earlier in a text where it stays. Rows that repeat doc_id and text are one document; null ids
    come first. An empty table gives an empty table. Other columns are not read.
    """
    lost = repeated_chunks(docs).select("doc_id", "text_hash", F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("line"))
    gone = lost.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("gone"))
    gone = few(cut(gone), 16 + 4 * F.size("gone")).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    rows = docs.select(*text_key(), "text")
    rows = rows.join(gone, rows["doc_id"].eqNullSafe(F.col("gone_id")) & (rows["text_hash"] == F.col("gone_hash")), "left")
    lines = F.split("text", "\n")
    stays = F.transform(F.array(lines), lambda a: F.transform(F.array_except(F.sequence(F.lit(0), F.size(a) - 1), "gone"), lambda i: F.get(a, i)))[0]
    return rows.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")).alias("kept"),
    )


def op5_line_chunks(spark, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines removed from all documents: doc_id, n_lines, n_removed, kept_sha256."""
    done = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP5_SQL = """
with l as (
  select doc_id, line, i from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text is not null)
), p as (
  select doc_id, i, line, lead(line) over (partition by doc_id order by i) as following, lead(i) over (partition by doc_id order by i) as j from l
), f as (
  select doc_id, i, first_value(doc_id) over w as first_id, first_value(i) over w as first_i from p where j is not null and (trim(line, ' ') <> '' or trim(following, ' ') <> '')
  window w as (partition by line, following order by doc_id, i rows between unbounded preceding and unbounded following)
), g as (
  select doc_id, i from f where first_id <> doc_id or first_i + 2 <= i
), r as (
  select l.doc_id, l.line, l.i, exists (select 1 from g where g.doc_id = l.doc_id and g.i in (l.i, l.i - 1)) as gone from l
), k as (
  select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed, coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as kept from r group by doc_id
)
select d.doc_id, cast(coalesce(k.n_lines, 0) as bigint) as n_lines, cast(coalesce(k.n_removed, 0) as bigint) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from documents d left join k on k.doc_id = d.doc_id
"""
