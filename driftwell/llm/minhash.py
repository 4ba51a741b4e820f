"""Near-duplicate texts by SuperMinHash signatures, banding, verification on full sets, and union.

SuperMinHash (Ertl 2017) gives each shingle a random permutation of the signature's places and, for the k-th of them,
the value k plus a fraction; a place keeps its least value. The ranks of one shingle are thus correlated, which lowers
the variance, and a shingle can stop as soon as k exceeds the largest value that any place still holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, table, tune, utf8_column
from .components import connected_components

WORDS, SIMILARITY = 5, 75
#: 32 bands of 4 places: two texts of similarity 0.75 share no band with probability 5e-6.
BANDS, ROWS = 32, 4
#: Shingles at a time; longer texts go through in blocks.
BLOCK = 1 << 14
#: Members in a block and their shingles, on average, and shingles (columns) that a block's product takes at a time.
MEET, MEET_SHINGLES, COLUMNS = 256, 1 << 18, 1 << 13
#: Members of a bucket that meet each other at once.
SMALL = 24

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 << 40))
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word ([^\\x20\\x09-\\x0D]+, A-Z lower-cased) of texts, and the words' texts."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = _LOWER[data]
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < len(data)]
    start[edge] = word[edge]  # a text's first byte begins a word
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    within = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data)))) if begin[0] == 0 else np.concatenate(
        [np.zeros(begin[0], np.int64), np.arange(begin[0], len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))]
    )
    length = np.add.reduceat(word, begin, dtype=np.int64)
    powers = np.multiply.accumulate(np.full(int(within.max()) + 1, _MUL[0] | np.uint64(1), np.uint64))
    value = np.where(word, _BYTE[data] * powers[within], np.uint64(0))
    # White space inside a word's stretch comes after it, so places within the word are unbroken.
    code = mix64(np.add.reduceat(value, begin) + length.astype(np.uint64))
    return code, np.searchsorted(offsets, begin, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts as sorted 64-bit hashes, text after text, and each text's number of them.

    A text with fewer words than a shingle has its whole sequence as one shingle; one without words has none.
    """
    n = len(offsets) - 1
    code, of = word_hashes(data, offsets)
    total = np.bincount(of, minlength=n)
    first = np.concatenate([[0], np.cumsum(total)])[:-1]
    shingles, owners = [], []
    if len(code) >= words:
        whole = np.zeros(len(code) - words + 1, np.uint64)
        for k in range(words):
            whole += mix64(code[k : len(code) - words + 1 + k] * _MUL[k % 5] + np.uint64(k))
        good = of[words - 1 :] == of[: len(code) - words + 1]
        shingles.append(mix64(whole[good]))
        owners.append(of[: len(code) - words + 1][good])
    for i in np.flatnonzero((total > 0) & (total < words)):
        own = np.arange(total[i], dtype=np.uint64)
        got = mix64(code[first[i] : first[i] + total[i]] * _MUL[own % 5] + own + np.uint64(100)).sum(keepdims=True)
        shingles.append(mix64(got + np.uint64(total[i])))
        owners.append(np.array([i]))
    if not shingles:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    s, o = np.concatenate(shingles), np.concatenate(owners)
    order = np.lexsort((s, o))
    s, o = s[order], o[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    return s[new], np.bincount(o[new], minlength=n).astype(np.int64)


def superminhash(shingles: np.ndarray, owner: np.ndarray, n: int, places: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (n x places, doubles; infinity where a set is empty). owner: ascending, the set of each shingle."""
    out = np.full((n, places), np.inf)
    for at in range(0, len(shingles), BLOCK):
        s, o = shingles[at : at + BLOCK], owner[at : at + BLOCK]
        low = int(o[0])
        sig = out[low : int(o[-1]) + 1]
        live, seed, of = np.arange(len(s)), s, o - low
        order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(s), 1))
        flat = sig.reshape(-1)
        for k in range(places):
            draw = mix64(seed + np.uint64((k * 0xD1B54A32D192ED03) & (2**64 - 1)))
            fraction = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
            swap = k + ((draw & np.uint64(0x7FFFFFFF)) * np.uint64(places - k) >> np.uint64(31)).astype(np.int64)
            place = order[live, swap]
            order[live, swap] = order[live, k]
            np.minimum.at(flat, of * places + place, k + fraction)
            if k + 1 < places:
                on = (sig.max(1) > k + 1)[of]
                if not on.all():
                    live, seed, of = live[on], seed[on], of[on]
                    if not len(live):
                        break
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash (binary, null for empty sets), bands array<long> of every whole text. One scan."""
    import pyarrow as pa

    tune(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            ids, counts, hashes, bands = batch.column(0), [], [], []
            at = 0
            while at < len(ids):  # about 4 MB of text at a time
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), "right")) - 1)
                s, n = shingle_sets(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                sig = superminhash(s, np.repeat(np.arange(len(n)), n), len(n))
                code = np.zeros((len(n), BANDS), np.uint64)
                bits = sig.view(np.uint64).reshape(len(n), BANDS, ROWS)
                for k in range(ROWS):
                    code = mix64(code ^ bits[:, :, k])
                code = mix64(code ^ np.arange(BANDS, dtype=np.uint64))
                ends = np.cumsum(n)
                hashes += [hashlib.blake2b(s[e - c : e].tobytes(), digest_size=16).digest() if c else None for e, c in zip(ends.tolist(), n.tolist(), strict=True)]
                counts.append(n)
                bands.append(code.view(np.int64))
                at = to
            if not counts:
                continue
            flat = np.concatenate(bands).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(counts)), pa.array(hashes, pa.binary()), lists], names=["doc_id", "n_shingles", "set_hash", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, set_hash binary, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= similarity * union.

    Joins the texts to the pairs, by shuffle; a hot id's rows are split by adaptive execution.
    """
    import pyarrow as pa

    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    ).select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            keep = []
            sides = []
            for j in (2, 3):
                data, offsets = utf8_column(batch.column(j))
                s, n = shingle_sets(data, offsets)
                sides.append((s, np.concatenate([[0], np.cumsum(n)])))
            (s, p), (t, q) = sides
            for i in range(batch.num_rows):
                x, y = s[p[i] : p[i + 1]], t[q[i] : q[i + 1]]
                common = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                keep.append(common > 0 and 100 * common >= similarity * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def meet(group, similarity: int):
    """Links among one pair of blocks of a bucket's members, as each member's root: id, root. group: an Arrow table.

    Intersections of all sets at once are a product of the incidence matrix with itself, some columns after others.
    """
    import pyarrow as pa

    ids, comp, block = (group[c].to_numpy() for c in ("id", "c", "block"))
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    data, offsets = utf8_column(group["text"].combine_chunks())
    s, n = shingle_sets(data, offsets)
    owner = np.repeat(np.arange(len(n)), n)
    _, column, often = np.unique(s, return_inverse=True, return_counts=True)
    shared = often[column] > 1  # a shingle of one member is in no intersection
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    common = np.zeros((len(n), len(n)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        m = np.zeros((len(n), COLUMNS), np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        common += m @ m.T
    union = n[:, None] + n[None, :] - common
    link = (common > 0) & (100 * common >= similarity * union) & (comp[:, None] != comp[None, :])
    if i != j:
        link &= block[:, None] != block[None, :]
    u, v = np.nonzero(link)
    place = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    root = place.copy()
    while len(u):
        new = root.copy()
        np.minimum.at(new, u, root[v])
        if (new == root).all():
            break
        root = new
    by_place = np.argsort(place)
    moved = np.flatnonzero(root != place)
    return pa.table({"a": group["id"].take(pa.array(moved)), "b": group["id"].take(pa.array(by_place[root[moved]]))})


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Components of docs under links of 100 * intersection >= similarity * union of their word shingle sets.

    Equal sets are one class, represented by its smallest doc_id. A band's bucket is settled without emitting all of
    its pairs: its members meet the smallest of them, then, if they are in more than one component, another drawn one.
    Members of small buckets that are still apart meet in pairs. What is then apart in a large bucket meets in pairs
    of blocks, in one matrix product each, which give back links but no pairs. So every two
    members of a bucket were compared or are connected by links, and no link between components is lost but those
    that share no band (5e-6 at the threshold, less above).

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable, itself included), kept. Null, empty and blank
    texts have no shingles and link with nothing. Rows that repeat a doc_id are one node: what one links, both link;
    each gives a row. Other columns of docs are not read. A null doc_id links
    nothing: its component is null, and it is kept. Very long texts meet in smaller blocks. An empty table gives no rows.
    """
    sig = cut(signatures(docs))
    classes = cut(sig.filter("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r")).select("set_hash", "r.*"))
    spread = classes.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lead")).filter("size > 1")
    members = cut(spread.join(buckets, "key"))
    shape = lambda x, y, n, m: ((100 * F.least(n, m) >= similarity * F.greatest(n, m)) & (x != y))
    leads = classes.select(F.col("doc_id").alias("lead"), F.col("n_shingles").alias("lead_n"))
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    texts = cut(docs.select("doc_id", "text").join(wanted, "doc_id"))

    def pair(df: DataFrame, x: str, y: str, nx: str, ny: str) -> DataFrame:
        good = df.filter(shape(F.col(x), F.col(y), F.col(nx), F.col(ny)))
        return good.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()

    tested = cut(pair(members.join(leads, "lead"), "id", "lead", "n", "lead_n"))
    links = cut(verify(tested, texts, similarity))
    kind = classes.schema["doc_id"].dataType.simpleString()
    pointers = lambda c: c.select(F.col("id").alias("a"), F.col("component").alias("b"))

    def undecided(components: DataFrame, turn: int) -> DataFrame:
        """Members of buckets that hold more than one component, with one member drawn from each bucket."""
        named = members.join(components, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
        apart = named.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min_by(F.struct("id", "c", "n"), F.xxhash64("id", F.lit(turn))).alias("drawn"), F.sum("n").alias("shingles")).filter("c0 < c1")
        return cut(named.join(apart.select("key", "drawn", "shingles"), "key").select("key", "id", "n", "c", "size", "drawn", "shingles"))

    components = connected_components(links)
    rest = undecided(components, 1)
    x, y = rest.filter(F.col("size") <= SMALL).alias("x"), rest.filter(F.col("size") <= SMALL).alias("y")
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") > F.col("y.id")) & (F.col("x.c") != F.col("y.c")) & shape(F.col("x.id"), F.col("y.id"), F.col("x.n"), F.col("y.n")))
    drawn = rest.filter((F.col("size") > SMALL) & (F.col("c") != F.col("drawn.c"))).select("id", "n", F.col("drawn.id").alias("d"), F.col("drawn.n").alias("m"))
    new = pair(drawn, "id", "d", "n", "m").unionByName(cross.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))).distinct()
    more = cut(verify(cut(new.join(tested, ["a", "b"], "left_anti")), texts, similarity))
    if not more.isEmpty():
        components = connected_components(more.unionByName(pointers(components)))
    large = undecided(components, 2).filter(F.col("size") > SMALL)
    blocks = F.ceil(F.greatest(F.col("size") / MEET, F.col("shingles") / MEET_SHINGLES)).cast("int")
    placed = large.select("key", "id", "c", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "c", "block")
    dealt = dealt.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")
    last = cut(dealt.groupBy("key", "i", "j").applyInArrow(lambda g: meet(g, similarity), f"a {kind}, b {kind}"))
    if not last.isEmpty():
        components = connected_components(last.unionByName(pointers(components)))
    rep = classes.select("set_hash", F.col("doc_id").alias("id")).join(components, "id", "left").select("set_hash", F.coalesce("component", "id").alias("component"))
    out = sig.select("doc_id", "n_shingles", "set_hash").join(cut(rep), "set_hash", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_superminhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
