"""Fingerprints, fill-in-middle and the manifest against plain Python, with nulls, ties, repeated rows and empty tables."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from driftwell.llm import bpe, chat, exact, fim, forest, language, lines, merkle, minhash, packing, queries, secrets, suffixes, winnow  # noqa: F401

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(30_000))
WORDS = "the quick brown fox jumps over a lazy dog and runs away from seven other clever foxes".split()


def some_rows(seed=0, n=60):
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(k))
    rows = [(i, prose(rng.choice([1, 2, 5, 12, 60, 200])), rng.choice(["en", None]), rng.choice(["a", "b", None, ""])) for i in range(n)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, " \t\n ", "en", "é"), (103, LONG, "en", "a"), (104, "Ünïcödé ÀÉ \U0001f600 中文 \x00 текст" * 9, None, "b"), (-5, "x", "en", "b"), (105, "ends in space  ", "en", "b"), (106, "  begins", "en", "b")]
    rows += [(200, "has a <P> mark in it", "en", "a"), (201, "same text", "en", "a"), (202, "same text", "en", "a"), (7, "another text of a repeated id", "en", "a"), (203, "AKIA Upper CASE", "en", "a")]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for c in ("range", "guest", "place", "picks", "n", "form", "output", "leaf", "tree", "part", "idx", "root", "steps", "node", "claimed"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


# ---- winnowing


def picks(t):
    k, w = winnow.K, winnow.WINDOW
    if not t:
        return []
    b = t.encode("utf-32-be")
    b += b"\xff" * max(0, 4 * k - len(b))
    h = [xxhash.xxh64_intdigest(b[4 * i : 4 * i + 4 * k], seed=42) >> 32 & 0x7FFFFFFF for i in range(max(len(t) - k + 1, 1))]
    out = []
    for i in range(max(len(h) - w + 1, 1)):
        least = min(range(i, min(i + w, len(h))), key=lambda j: (h[j], -j))
        if not out or out[-1][0] != least:
            out.append((least, h[least]))
    return out


def spell(found):
    return ",".join(f"{p}:{h:x}" for p, h in found)


def like(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of rows without repeats."""
    hashed = lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), seed=42)))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1])))
    out = []
    for k, (i, t, *_) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        e = t[: len(t) - cut] + following[:cut]
        a, b, c = picks(t), picks(e), picks(following)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), spell(a), spell(b), like(a, b), like(a, c)))
    return out


def query(spark, monkeypatch, module, df, run):
    monkeypatch.setattr(module, "table", lambda s, root, name, *columns: df.select(*columns) if columns else df)
    return run(spark, "")


@pytest.mark.parametrize("rows", [some_rows(), some_rows(1, 9)[:9], [(1, "one alone, which is its own next document " * 3, None, None)], [(None, "a null id", None, None), (3, "ab", None, None)]])
def test_winnow_equals_brute_force(spark, monkeypatch, rows):
    got = query(spark, monkeypatch, winnow, frame(spark, rows), winnow.op11_winnow).collect()
    key = lambda r: (str(r[0]), r[3])
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)


def test_winnow_repeats_and_no_rows(spark, monkeypatch):
    rows = some_rows(2, 12)[:12]
    want = expected(rows)
    got = query(spark, monkeypatch, winnow, frame(spark, rows + rows[:5] + rows[:5]), winnow.op11_winnow).collect()
    assert sorted(map(tuple, got)) == sorted(want + [w for w in want if w[0] < 5] * 2)
    assert query(spark, monkeypatch, winnow, frame(spark, rows).filter("false"), winnow.op11_winnow).count() == 0


def test_winnow_finds_every_shared_passage(spark):
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    pairs = []
    for i in range(60):
        shared = letters(winnow.K + winnow.WINDOW - 1)
        pairs.append((i, letters(rng.randrange(90)) + shared + letters(rng.randrange(90)), letters(rng.randrange(90)) + shared + letters(rng.randrange(90))))
    df = spark.createDataFrame(pairs, "i int, a string, b string").select("a", winnow.picks(F.col("a")).alias("p"), winnow.hashes(winnow.picks(F.col("b"))).alias("q"))
    rows = df.select(F.size(F.array_intersect(winnow.hashes(F.col("p")), F.col("q"))).alias("n"), "a", winnow.positions(F.col("p")).alias("at")).collect()
    assert all(r.n > 0 for r in rows)
    assert all(0 <= p <= len(r.a) - winnow.K and list(r.at) == sorted(r.at) for r in rows for p in r.at)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- fill in the middle


def units(t):
    return re.findall(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", t)


def middle(i, t):
    t = t or ""
    d = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    u = units(t)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in fim.MARKS) or h[2] % 100 >= 50:
        return i, len(u), "plain", None, None, t
    return (i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else (i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fim_equals_brute_force(spark, monkeypatch):
    rows = some_rows() + [(None, "a null id with words", None, None)] + some_rows()[:3]
    out = fim.fill_in_middle(frame(spark, rows)).collect()
    key = lambda r: (str(r[0]), r[5])
    assert sorted((tuple(r) for r in out), key=key) == sorted((middle(i, t) for i, t, *_ in rows), key=key)
    assert {r.form for r in out} == {"plain", "spm", "psm"}
    done = query(spark, monkeypatch, fim, frame(spark, rows), fim.op12_fim).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(r.restored_sha256 for r in done) == sorted(sha(t) for _, t, *_ in rows)
    assert query(spark, monkeypatch, fim, frame(spark, rows).filter("false"), fim.op12_fim).count() == 0


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        tree, at = fim.WaveletMatrix(symbols, 2), np.arange(n + 1)
        for c in range(4):
            assert tree.rank(c, at).tolist() == [int((symbols[:i] == c).sum()) for i in at]


# ---- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(r):
    i, t, lang, source = r
    n = None if t is None else len(t)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, t)))


def tree(nodes):
    """The root, and for each node its siblings from below upwards."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k in range(len(nodes)):
            first = at[k] - at[k] % 16
            paths[k].append((at[k] % 16, level[first : at[k]] + level[at[k] + 1 : first + 16]))
            at[k] //= 16
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], paths


def fold(node, path):
    for place, others in path:
        node = h(*others[:place], node, *others[place:])
    return node


def whole_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources, out = sorted(by, key=lambda s: (s is not None, (s or "").encode())), []
    trees = {}
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, row_leaf(r)))
        trees[s] = (own, *tree([row_leaf(r) for r in own]))
    root, above = tree([trees[s][1] for s in sources])
    for s, up in zip(sources, above, strict=True):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths, strict=True):
            steps = path + up
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                shown = (r[0], re.sub("[A-Z]", lambda m: m[0].lower(), r[1]), *r[2:])
            n = None if r[1] is None else len(r[1])
            claimed = h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], n, shown[1])))
            folded = fold(claimed, steps)
            out.append((r[0], row_leaf(r), subroot, root, h(*(x for _, others in steps for x in others)), folded, folded == root))
    return out


@pytest.mark.parametrize("rows", [some_rows() + some_rows()[:3] + [(None, "no id", None, "a")], some_rows(5, 700), [(1, "One Alone", "en", None)], [(i, "T", None, f"s{i}") for i in range(300)]])
def test_merkle_equals_brute_force(spark, monkeypatch, rows):
    got = query(spark, monkeypatch, merkle, frame(spark, rows), merkle.op13_merkle).collect()
    assert sorted(map(tuple, got), key=str) == sorted(whole_manifest(rows), key=str)


def test_merkle_of_no_rows(spark, monkeypatch):
    assert query(spark, monkeypatch, merkle, frame(spark, some_rows()).filter("false"), merkle.op13_merkle).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 15, 16, 17, 33, 256, 257, 300, 530])
def test_butterfly_knows_every_way_up(spark, parts):
    nodes = [h(str(i)) for i in range(parts)]
    df = spark.createDataFrame([("t", i, parts, x) for i, x in enumerate(nodes)] + [("u", 0, 1, "alone")], "tree string, part long, parts long, node string")
    got = {(r.tree, r.part): (r.node, [(s.place, list(s.others)) for s in r.steps]) for r in merkle.butterfly(df).collect()}
    root, paths = tree(nodes)
    assert got == {("t", i): (root, p) for i, p in enumerate(paths)} | {("u", 0): ("alone", [])}


def test_merkle_of_several_parts(spark):
    n = 2 * merkle.PART + 33
    df = spark.range(0, n, 1, 7).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.lit("t").alias("text"))
    got = {r.doc_id: r for r in merkle.manifest(df, keep=True).collect()}
    root, paths = tree([h(f"{len(str(i))}:{i}", "1:s", "-", "1:1", "1:t") for i in range(n)])
    assert len(got) == n and {r.root for r in got.values()} == {root} and all(r.verified for r in got.values())
    for i in (0, 15, 16, merkle.PART - 1, merkle.PART, n - 34, n - 1):
        assert [(s.place, list(s.others)) for s in got[i].proof] == paths[i]
    wrong = merkle.manifest(df, F.when(F.col("doc_id") == 77, F.sha2(F.lit("x"), 256)).otherwise(merkle.leaf())).filter("not verified").collect()
    assert [r.doc_id for r in wrong] == [77]


# ---- lines: passages that repeat


def test_short_passages_are_found(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"a line of its own {rng.random()}" for _ in range(n)]
    passages = [[f"passage {p} line {i} {rng.random()}" for i in range(rng.randint(2, 10))] for p in range(80)]
    rows, planted = [], {}
    for i in range(240):
        p = passages[i % 80]
        rows.append((i, "\n".join([*fresh(rng.randrange(5)), *p, *fresh(rng.randrange(5))])))
        planted[i] = len(p) if i >= 80 else 0
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == planted


def pairs_removed(rows):
    """Lines that go, by the rule on pairs of neighbouring lines."""
    first, gone = {}, {}
    hashed = lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)))
    for k, (i, t) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))):
        own, drop = t.split("\n"), set()
        for s in range(len(own) - 1):
            if own[s].strip(" ") or own[s + 1].strip(" "):
                at = first.setdefault((own[s], own[s + 1]), (k, s))
                if at[0] != k or at[1] + 2 <= s:
                    drop |= {s, s + 1}
        gone[i, t] = "\n".join(x for j, x in enumerate(own) if j not in drop)
    return gone


def test_lines_equal_pairs(spark):
    rng = random.Random(9)
    rows = list({(rng.choice([None, *range(30)]), "\n".join(rng.choice(["", " ", "a", "b", "c", "d"]) for _ in range(rng.randrange(1, 14)))) for _ in range(60)})
    rows += [(90, "\n".join(["x"] * 40)), (91, "\n".join(f"{i % 20}" for i in range(5000)))]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = pairs_removed(rows)
    assert sorted((str(r.doc_id), r.kept) for r in out.collect()) == sorted((str(i), kept) for (i, _), kept in want.items())


# ---- every query on empty tables


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    text, ids = pa.string(), pa.int64()
    shapes = {
        "documents": [("doc_id", ids), ("text", text), ("lang", text), ("source", text), ("n_chars", ids)], "embeddings": [("vec_id", ids), ("label", ids), ("embedding", pa.list_(pa.float32()))],
        "conversations": [("conv_id", ids), ("turn", ids), ("role", text), ("text", text)],
    }
    given = "/root/testdata/sf0.001"
    for table, shape in shapes.items():
        schema = pq.read_schema(f"{given}/{table}.parquet") if os.path.isdir(given) else pa.schema(shape)
        pq.write_table(schema.empty_table(), tmp_path / f"{table}.parquet")
    rows = queries.QUERIES[name](spark, f"file://{tmp_path}").count()
    assert rows == (1 if name == "op9_chat" else 0)  # op9 adds a conversation of its own


# ---- substrings: what goes is decided by bytes


def settled_by_hand(texts, docs, length):
    least = {}
    for t, d in zip(texts, docs, strict=True):
        for i in range(len(t) - length + 1):
            least[t[i : i + length]] = min(d, least.get(t[i : i + length], d))
    return {(d, k, i) for k, (t, d) in enumerate(zip(texts, docs, strict=True)) for i in range(len(t) - length + 1) if least[t[i : i + length]] < d}


@pytest.mark.parametrize("collide", [False, True])
def test_intervals_decide_even_if_hashes_collide(monkeypatch, collide):
    rng = random.Random(6)
    letters = lambda n: bytes(rng.choice(b"abcdef") for _ in range(n))
    if collide:  # every segment of a size has one hash
        monkeypatch.setattr(suffixes, "_codes", lambda data, begin, stop, *more: (stop - begin).astype(np.uint64))
    kinds = [letters(50 + rng.choice([0, 3, 3, 9])) for _ in range(12)]
    texts = [rng.choice(kinds) for _ in range(30)]
    docs = [rng.randrange(20) for _ in texts]
    data, n = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) - 49 for t in texts])
    held = [rng.randrange(30) for _ in range(8)]  # copies that are sent without their bytes
    more = [rng.randrange(20) for _ in held]
    copies = np.array([held, more, [30 + k for k in range(8)], [0] * 8])
    out = suffixes._settled(data, np.zeros(30, np.int64), np.array(docs), np.arange(30), np.zeros(30, np.int64), n, copies, 50)
    got = {(d, part, i) for d, part, start, stop in out.T.tolist() for i in range(start, stop - 49)}
    assert got == settled_by_hand(texts + [texts[h] for h in held], docs + more, 50) and got


def test_substrings_and_null_ids(spark):
    shared = "a passage that three rows hold, of which one has no id at all, and so on and on"
    rows = [(None, f"{shared} with another end"), (5, f"begins otherwise {shared}"), (9, f"{shared}!"), (None, shared)]
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans) for r in suffixes.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, len(shared) + 17): (0, 0), (5, len(shared) + 17): (0, 0), (9, len(shared) + 1): (len(shared), 1), (None, len(shared)): (0, 0)}
