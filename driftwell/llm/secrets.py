"""Secret scans: parts of credentials by pattern, then linked by interval joins within a scope."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table, text_key, tune

#: Base patterns, in the order in which they are listed: (kind, pattern, group that is measured, least length).
BASE = [
    ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
]
#: Weak candidates: reported only when a complementary part lies in the same scope. (kind, pattern, part, its complements)
WEAK = [
    ("bare", re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/_=-])"), "secret", ("id",)),
    ("login", re.compile(r"""(?<![A-Za-z0-9_])(?:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.I | re.A), "id", ("secret",)),
    ("endpoint", re.compile(r"""(?:https?|jdbc:[a-z]{2,}|postgres(?:ql)?|mysql|redis|amqps?|mongodb)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{3,}""", re.A), "endpoint", ("id", "secret")),
]
#: What part a base kind is.
PART = {"assign": "secret", "access": "id", "hex": "secret"}
#: Code points between two parts at most for them to be in one scope, unless the caller says otherwise.
SCOPE = 200
ORDER = ["assign", "access", "hex", "bare", "login", "endpoint"]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches, leftmost and non-overlapping in each kind; matches that are too short go after matching."""
    out = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    return out


def weak_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, m.start(), m.end()) for kind, pattern, _, _ in WEAK for m in pattern.finditer(text)]


def parts(docs: DataFrame, *keep: str) -> DataFrame:
    """Every part of every whole text: keep, kind, part, strong, start, stop (code points, end exclusive). One scan."""
    import pyarrow as pa

    tune(docs.sparkSession)
    source = docs.select(*keep, "text")
    weak_part = {kind: part for kind, _, part, _ in WEAK}

    def run(batches):
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                if not text:
                    continue
                rows += [(i, k, PART[k], True, a, b) for k, a, b in base_spans(text)]
                rows += [(i, k, weak_part[k], False, a, b) for k, a, b in weak_spans(text)]
            at = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch.column(j).take(at) for j in range(len(keep))]
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
            columns += [pa.array([r[j + 1] for r in rows], t) for j, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "kind", "part", "strong", "start", "stop"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return source.mapInArrow(run, ", ".join([*fields, "kind string, part string, strong boolean, start long, stop long"]))


def beside(weak: DataFrame, others: DataFrame, keys: list[str], scope: int) -> DataFrame:
    """The rows of weak that have a complementary part among others within scope code points of the same document.

    An interval semi-join: a part lies in the bins of its document that it touches, a weak part looks into the bins
    that its scope touches, and the exact distance is tested in the join. A key holds at most one bin's parts, however
    long a document is. Of two weak parts neither may lie in the other: one token is not an id and a secret at once.
    """
    width = 4 * scope
    others = others.select(*keys, F.col("part").alias("s_part"), F.col("strong").alias("s_strong"), F.col("start").alias("s_start"), F.col("stop").alias("s_stop"))
    others = others.withColumn("bin", F.explode(F.sequence(F.floor(F.col("s_start") / width), F.floor((F.col("s_stop") - 1) / width))))
    weak = weak.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / width), F.floor((F.col("stop") + scope) / width))))
    pairs = F.lit(False)
    for kind, _, _, complements in WEAK:
        pairs = pairs | ((weak["kind"] == kind) & others["s_part"].isin(*complements))
    near = (others["s_start"] <= weak["stop"] + scope) & (others["s_stop"] >= weak["start"] - scope)
    apart = others["s_strong"] | (weak["kind"] == "endpoint") | (others["s_start"] >= weak["stop"]) | (others["s_stop"] <= weak["start"])
    same = [weak[k].eqNullSafe(others[k]) for k in keys] + [weak["bin"] == others["bin"]]
    condition = near & pairs & apart
    for c in same:
        condition = condition & c
    return weak.join(others, condition, "left_semi").drop("bin").distinct()


def linked(found: DataFrame, keys: list[str], scope: int = SCOPE) -> DataFrame:
    """The weak parts of found that make up a credential with parts nearby, strong or weak.

    An id and a secret within scope suffice, whatever their strength: a login beside a bare token links both. An
    endpoint needs a strong part, or a weak one that is itself linked, within scope: an address beside a token that
    no id accompanies stays out.
    """
    pair = cut(beside(found.filter("not strong and part <> 'endpoint'"), found.filter("part <> 'endpoint'"), keys, scope))  # read twice
    return pair.unionByName(beside(found.filter("part = 'endpoint'"), found.filter("strong").unionByName(pair), keys, scope))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Spans of secrets by document: doc_id, text_hash, spans array<struct<start, rank, kind, stop>> in order.

    Base matches always count. Weak candidates (bare tokens, logins, endpoints) are reported only when complementary
    parts, strong or weak, lie within ``scope`` code points (linked() has the rule). Documents without spans, null and empty texts have no row. Rows
    that repeat doc_id and text share one row. Other columns are not read.
    """
    keyed = docs.select(*text_key(), "text")
    found = cut(parts(keyed, "doc_id", "text_hash").distinct())  # read several times below
    spans = found.filter("strong").unionByName(linked(found, ["doc_id", "text_hash"], scope))
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind"))
    one = F.struct(F.col("start"), rank.alias("rank"), F.col("kind"), F.col("stop"))
    return spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """find_secrets() with counts and digests, a row for each row of docs (no spans: zeros and empty strings)."""
    rows = docs.select(*text_key())
    found = find_secrets(docs, scope)
    d, f = rows.alias("d"), found.alias("f")
    out = d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_hash") == F.col("f.text_hash")), "left")
    spans = F.coalesce(F.col("f.spans"), F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>"))
    out = out.select(F.col("d.doc_id").alias("doc_id"), spans.alias("spans"))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*PART))
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[removed]") -> DataFrame:
    """docs with the same columns, each secret in text replaced by mark; overlapping spans are replaced as one."""
    import pyarrow as pa

    columns = docs.columns
    found = find_secrets(docs, scope).select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), F.transform("spans", lambda x: F.struct(x["start"].alias("a"), x["stop"].alias("b"))).alias("found_spans"))
    out = docs.join(found, docs["doc_id"].eqNullSafe(F.col("found_id")) & (F.xxhash64(docs["text"]) == F.col("found_hash")), "left").select(*columns, "found_spans")
    place = columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for i, spans in enumerate(batch.column(len(columns)).to_pylist()):
                if spans:
                    text, out, at = texts[i], [], 0
                    for s in spans:
                        if s["b"] <= at:
                            continue
                        if s["a"] >= at:
                            out += [text[at : s["a"]], mark]
                        at = s["b"]
                    texts[i] = "".join([*out, text[at:]])
            new = [batch.column(j) if j != place else pa.array(texts, pa.string()) for j in range(len(columns))]
            yield pa.RecordBatch.from_arrays(new, names=columns)

    return out.mapInArrow(run, docs.schema)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of documents: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))
