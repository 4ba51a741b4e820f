"""Operators and pipeline stages against independent brute-force versions."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.llm import language, minhash, secrets, suffixes
from driftwell.llm.vocab import vocabulary

WHITE = " \t\n\x0b\x0c\r"


# ---- secrets: a scanner without the module's base patterns, and a linker of nested loops


def scan_base(text):
    out, low = [], "".join(c.lower() if c in string.ascii_uppercase else c for c in text)
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    i = 0
    while i < len(text):  # assignments
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            j = i + len(name)
            if low[i:j] != name:
                continue
            j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] not in (":", "=") or not text[j : j + 1]:
                continue
            j += 1
            while text[j : j + 1] == " ":
                j += 1
            j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
            k = j
            while k < len(text) and text[k] in value:
                k += 1
            if k > j:
                if k - j >= 6:
                    out.append(("assign", i, k))
                i = k - 1
                break
        i += 1
    i = 0
    while i < len(text):  # access identifiers
        if text.startswith("AKIA", i):
            k = i + 4
            while k < len(text) and text[k] in string.ascii_uppercase + string.digits:
                k += 1
            if k > i + 4:
                if k - i >= 20:
                    out.append(("access", i, k))
                i = k
                continue
        i += 1
    i = 0
    while i < len(text):  # hexadecimal runs
        k = i
        while k < len(text) and text[k] in "0123456789abcdef":
            k += 1
        if k - i >= 24:
            out.append(("hex", i, k))
        i = max(k, i + 1)
    return out


def link(text, scope):
    """All spans by comparing every part with every other."""
    part = {"assign": "secret", "access": "id", "hex": "secret", "bare": "secret", "login": "id", "endpoint": "endpoint"}
    found = [(*s, True) for s in scan_base(text)] + [(*s, False) for s in secrets.weak_spans(text)]
    near = lambda x, y: y[1] <= x[2] + scope and y[2] >= x[1] - scope
    apart = lambda x, y: y[3] or y[1] >= x[2] or y[2] <= x[1]
    other = {"id": "secret", "secret": "id"}
    pair = [x for x in found if not x[3] and part[x[0]] != "endpoint" and any(part[y[0]] == other[part[x[0]]] and near(x, y) and apart(x, y) for y in found)]
    ends = [x for x in found if x[0] == "endpoint" and any(near(x, y) for y in found if part[y[0]] != "endpoint" and (y[3] or y in pair))]
    order = ["assign", "access", "hex", "bare", "login", "endpoint"]
    return sorted({x[:3] for x in found if x[3]} | {x[:3] for x in pair} | {x[:3] for x in ends}, key=lambda x: (x[1], order.index(x[0]), x[2]))


def secret_texts(seed=3, n=250):
    rng = random.Random(seed)
    token = lambda k: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(k))
    make = [
        lambda: f"{rng.choice(['password', 'Token', 'API_KEY', 'apikey', 'secret', 'passwd'])}{rng.choice(['', chr(34), chr(39)])}{rng.choice([' ', '', '  '])}{rng.choice('=:')}{rng.choice(['', ' ', chr(34)])}{token(rng.choice([4, 5, 6, 30]))}",
        lambda: "AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(rng.choice([8, 15, 16, 30]))), lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([20, 23, 24, 64]))),
        lambda: token(rng.choice([31, 32, 40, 90, 400])), lambda: f"user{rng.choice(['', 'name'])}{rng.choice('=:')} {token(rng.choice([2, 3, 80]))}", lambda: f"https://{token(9)}.example/{'a/' * rng.choice([1, 300])}?k={token(3)}",
        lambda: "." * rng.choice([10, 150, 195, 205, 400]), lambda: " ", lambda: "\n", lambda: "wörd ", lambda: "passwordpassword=abcdefg", lambda: "tokentoken = ",
    ]
    return [(d, "".join(rng.choice(make)() for _ in range(rng.randrange(14)))) for d in range(n)]


def test_secrets_equal_a_nested_loop_linker(spark):
    rows = secret_texts()
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    kinds = Counter()
    for d, text in rows:
        base = sorted(scan_base(text), key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))
        assert got[d].base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest(), text
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(x[0] == k for x in base) for k in ("assign", "access", "hex"))
        want = link(text, secrets.SCOPE)
        assert got[d].spans == joined(want), text
        kinds.update(x[0] for x in want)
    assert all(kinds[k] > 5 for k in ("assign", "access", "hex", "bare", "login", "endpoint"))


# ---- language


def grams(text):
    t = text.lower()
    return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_language_kernel_is_the_presence_kernel():
    texts = ["the quick brown fox", "der schnelle braune fuchs", "the slow brown dog", "él zorro"]
    rows = np.zeros((4, language.PLACES), bool)
    for x, r in zip(texts, rows, strict=True):
        assert language.mark_presences(x, r)
    sets = [grams(x) for x in texts]
    assert [int(r.sum()) for r in rows] == [len(s) for s in sets]  # no two n-grams of these share a place
    assert ((rows.astype(int) @ rows.T.astype(int)) == [[len(a & b) for b in sets] for a in sets]).all()


def test_language_equals_explicit_kernel_ridge():
    """With every row a landmark, scores are those of one-versus-rest kernel ridge regression with the explicit kernel."""
    rng = np.random.default_rng(1)
    words = {"x": ["alpha", "beta", "gamma", "delta"], "y": ["eins", "zwei", "drei", "vier"]}
    texts = [" ".join(rng.choice(words[k], 6)) for k in ("x", "y") for _ in range(12)]
    labels = ["x"] * 12 + ["y"] * 12
    rows = np.zeros((len(texts), language.PLACES), bool)
    for x, r in zip(texts, rows, strict=True):
        language.mark_presences(x, r)
    model = language.fit(np.packbits(rows, axis=1), labels)
    sets = [grams(x) for x in texts]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    k = np.array([[kernel(a, b) for b in sets] for a in sets])
    y = np.where(np.array(labels)[:, None] == ["x", "y"], 1.0, -1.0) / 12
    alpha = np.linalg.solve(k @ k / 12 + language.RIDGE * k / len(k) + 1e-9 * np.eye(len(k)), k @ y)
    new = ["alpha drei gamma", "vier vier zwei", "beta"]
    want = np.array([[kernel(grams(x), s) for s in sets] for x in new]) @ alpha
    langs, score = model.predict(new)
    assert langs == [["x", "y"][i] for i in want.argmax(1)]
    assert np.abs(np.clip((want.max(1) + 1) / 2, 0, 1) - score).max() < 0.02


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = language.op1_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) > 0.95 * len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_language_sample_is_bounded(spark, monkeypatch):
    rows = [(7, f"one text of number {i % 40}", "en") for i in range(3000)] + [(7, "the same text", "de")] * 2000
    seen = []
    monkeypatch.setattr(language, "fit", lambda bits, labels, seed=7: seen.append(Counter(labels)) or language.Model([], np.zeros((language.PLACES, 0))))
    language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=25)
    assert seen[0]["en"] <= 25 and seen[0]["de"] <= 1


# ---- near-duplicates and repeated strings


def near_groups(rows):
    sets = {}
    for d, t in rows:
        words = [w for w in re.split(f"[{WHITE}]+", "".join(c.lower() if c in string.ascii_uppercase else c for c in t or "")) if w]
        sets[d] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def test_null_ids_link_nothing(spark):
    text = "one two three four five six seven eight"
    out = minhash.near_duplicates(spark.createDataFrame([(1, text), (None, text), (2, text), (None, None)], "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in out) == Counter({(1, 1, True): 1, (2, 1, False): 1, (None, None, True): 2})


@pytest.mark.parametrize("block", [150, 333])
def test_texts_longer_than_a_block(monkeypatch, block):
    """What the tasks do, in this process, so that they see the small block."""
    import pyarrow as pa
    from test_edges import brute_substrings

    rng = random.Random(block)
    shared = "".join(rng.choice("abcdef") for _ in range(400))
    own = lambda n: "".join(rng.choice("ABCDEF") for _ in range(n))
    rows = [(1, own(200) + shared), (2, shared[100:] + own(300) + shared[:120]), (3, own(90) + "=" * 500), (4, "=" * 120 + shared)]
    monkeypatch.setattr(suffixes, "BLOCK", block)
    packets = defaultdict(list)
    for k, (d, text) in enumerate(rows):  # a block each
        data = np.frombuffer(text.encode(), np.uint8)
        cut_up = suffixes._cut(data, np.array([0, len(data)]), np.zeros(1, bool), 50)
        assert len(cut_up) == -(-len(data) // block) and all(len(x[0]) <= block + 49 for x in cut_up)
        for part, own, _, base, found in cut_up:
            for bucket, packed in suffixes._pack(part, own, np.array([d]), np.array([k]), 3, found, np.zeros(len(found[0]), bool), base, 50):
                packets[bucket].append(packed)
    cover = {d: np.zeros(len(t), bool) for d, t in rows}
    for packed in packets.values():
        for r in suffixes._bucket(50)(pa.table({"packed": pa.array(packed, pa.binary())})).to_pylist():
            cover[r["doc_id"]][r["start"] : r["stop"]] = True
    assert [(d, int(cover[d].sum())) for d, _ in rows] == [(d, removed) for d, _, removed, _, _ in brute_substrings(rows)]


# ---- the pipeline, stage by stage


def corpus():
    rng = random.Random(9)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(300)]
    rows = [(d, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 60)))) for d in range(40)]
    rows += [(100 + d, t.replace(" ", "  ")) for d, t in rows[:8]] + [(200 + d, t + " " + rng.choice(words)) for d, t in rows[8:20]]
    rows += [(300 + d, f"{rows[d][1]} {t}") for d, t in secret_texts(8, 20)] + [(400, None), (401, ""), (402, "12 34"), (403, rows[3][1])]
    rng.shuffle(rows)
    return rows


def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline as p
    from tokenizers import Tokenizer

    rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({"key": F.lit("clash"), "id": F.lit(1)})
    columns, steps = docs.columns, dict(p.STAGES)
    held = lambda df: sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    docs, rows = p.cut(steps["language"](spark, docs, "")), sorted((d, t) for d, t in rows if t and any(map(str.isalpha, t)))
    assert held(docs) == rows and docs.columns == columns
    best = {}
    for d, t in rows:
        key = "".join(c for c in t if c not in WHITE)
        best[key] = min(best.get(key, (1, 0, "")), (-len(t), d, t))
    docs, rows = p.cut(steps["exact"](spark, docs, "")), sorted((d, t) for _, d, t in best.values())
    assert held(docs) == rows and docs.columns == columns
    group = near_groups(rows)
    docs, rows = p.cut(steps["near"](spark, docs, "")), [(d, t) for d, t in rows if group[d] == d]
    assert held(docs) == rows and docs.columns == columns and len(rows) < len(group)

    def redacted(text):
        out, at = [], 0
        for _, a, b in link(text, secrets.SCOPE):
            if b > at:
                out += [text[at:a], "[removed]"] if a >= at else []
                at = b
        return "".join([*out, text[at:]])

    docs, rows = p.cut(steps["secrets"](spark, docs, "")), [(d, redacted(t)) for d, t in rows]
    assert held(docs) == rows and docs.columns == columns and any("[removed]" in t for _, t in rows)
    assert docs.filter("n_chars <> length(text)").isEmpty()
    out, whole, tk = steps["packing"](spark, docs, "").collect(), defaultdict(int), Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = dict(rows)
    for r in out:
        ids = [*tk.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        part = ids[r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids) and r.ids == part and len(part) == r.length
        whole[r.doc_id] += r.length
    assert {d: n for d, n in whole.items()} == {r.doc_id: r.doc_tokens for r in out} and set(whole) == set(texts)


def test_pipeline_on_empty_and_null_tables(spark):
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long, h string"
    for rows in ([], [(None, None, None, None, None, "x")] * 3, [(None, "some words here", None, None, None, None)] * 2 + [(1, "some words here", "en", "s", 15, "y")]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in p.STAGES:
            out = p.cut(stage(spark, docs, ""))
            assert name == "packing" or out.columns == docs.columns
            docs = out
        assert docs.count() == (0 if not rows or rows[0][1] is None else 1)


def test_words_that_share_a_hash(monkeypatch):
    """Known words are told apart by their code points, not by their hash."""
    from driftwell.llm import bpe

    path = vocabulary("word_bpe_49k.json")
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    want = [x.tolist() for x in bpe.compile_automaton(path).encode(texts)]
    monkeypatch.setattr(bpe, "mix64", lambda x: np.asarray(x).astype(np.uint64) % np.uint64(97))
    monkeypatch.setattr(bpe, "CHUNK", 3)
    crowded = bpe.Automaton(**{k: v for k, v in bpe.compile_automaton(path).__dict__.items() if k != "_ready"})
    assert [x.tolist() for x in crowded.encode(texts)] == want
