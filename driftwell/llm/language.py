"""Language ID by string kernels.

The kernel of two texts is the number of distinct n-grams of length 1 to N that both hold (a blended spectrum of
presences), over the geometric mean of their own numbers. N-grams are hashed to a fixed number of places. Nystroem
landmarks give features, ridge regression fits one output for each language against the rest, and batches of texts
are scored by matrix products: the landmarks' presences times the coefficients is one (places x languages) matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix64, table, tune

#: Places that n-grams are hashed to, and the longest n-gram.
PLACES, LONGEST = 1 << 15, 3
#: Bounds of what is fitted on: languages (the most frequent ones), training rows of a language and of all, landmarks of
#: a language and of all.
LANGUAGES, TRAIN_ROWS, ALL_ROWS, LANDMARKS, ALL_LANDMARKS = 256, 400, 16_384, 64, 1024
RIDGE = 1e-2
#: Code points at a time; a text of any length is read whole, a stretch after another.
STRETCH = 1 << 18
UNKNOWN = "und"


def mark_presences(text: str, row: np.ndarray) -> bool:
    """Set the places of a text's n-grams in row (booleans); says whether the text has a letter."""
    letters = False
    for at in range(0, len(text), STRETCH):
        part = text[at : at + STRETCH + LONGEST - 1]  # an n-gram across the border is seen too
        part = part.lower()
        if not letters:
            letters = any(map(str.isalpha, part))
        cps = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(cps), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(cps) < n:
                break
            h = (h[: len(cps) - n + 1] * np.uint64(0x100000001B3)) ^ (cps[n - 1 :] + np.uint64(n << 32))
            row[(h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PLACES.bit_length() + 1)] = True
    return letters


@dataclass
class Model:
    """languages, and one column of place weights for each; PLACES x languages numbers in all."""

    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        seen = np.zeros((len(texts), PLACES), bool)
        known = np.array([mark_presences(x, seen[i]) if x else False for i, x in enumerate(texts)], bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        norm = np.sqrt(np.maximum(seen.sum(1), 1))[:, None]
        out = (seen.astype(np.float32) @ self.weights).astype(np.float64) / norm
        best = out.argmax(1)
        score = np.clip((out[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def unit(bits: np.ndarray) -> np.ndarray:
    """Packed presences as rows of length one."""
    rows = np.unpackbits(bits, axis=1).astype(np.float32)
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


def fit(bits: np.ndarray, labels: list[str], seed: int = 7) -> Model:
    """Nystroem landmarks and one-versus-rest kernel ridge regression. bits: rows x PLACES / 8 bytes of packed presences.

    Presences are unpacked some rows at a time; the driver holds the landmarks and one block.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((PLACES, 0), np.float32))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    each = min(LANDMARKS, ALL_LANDMARKS // len(languages))
    chosen = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:each] for k in range(len(languages))])
    marks = unit(bits[chosen])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate([(unit(bits[at : at + 64]) @ marks.T).astype(np.float64) @ whiten for at in range(0, len(bits), 64)])
    targets = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    balance = (1.0 / np.bincount(y, minlength=len(languages)))[y][:, None]  # each language weighs the same
    left = features.T @ (balance * features) + RIDGE * np.eye(features.shape[1]) / len(chosen)
    coefficients = (whiten @ np.linalg.solve(left, features.T @ (balance * targets))).astype(np.float32)
    return Model(languages, marks.T @ coefficients)


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id") -> Model:
    """Fit on ``rows`` different labelled texts of each language at most, chosen by a hash of key and text.

    labelled: key, text, lang. Rows with null lang or text are left out. The ``LANGUAGES`` most frequent languages are
    learned. Texts are drawn by the share that a language's count gives, rows that repeat key and text count once, and of
    more than ``rows`` texts the least hashes stay: at most ALL_ROWS bit rows of PLACES / 8 bytes reach the driver,
    whatever repeats.
    """
    import pyarrow as pa

    spark = tune(labelled.sparkSession)
    labelled = labelled.filter("lang is not null and text is not null")
    counts = cut(labelled.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES))  # a bound of the model
    rows = min(rows, ALL_ROWS // max(1, counts.count()))
    draw = F.xxhash64(key, "text", F.lit("train"))
    drawn = labelled.join(F.broadcast(counts), "lang").withColumn("draw", draw)
    drawn = drawn.filter(F.shiftrightunsigned("draw", 11) / float(1 << 53) < 1.25 * rows / F.col("count"))
    drawn = drawn.groupBy("lang", "draw").agg(F.min(F.struct(key, "text")).alias("x"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    taken = drawn.withColumn("place", place).filter(F.col("place") <= rows).select(f"x.{key}", "lang", "x.text")

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                row = np.zeros(PLACES, bool)
                mark_presences(text, row)
                out.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=[key, "lang", "bits"])

    kind = labelled.schema[key].dataType.simpleString()
    got = taken.mapInArrow(run, f"`{key}` {kind}, lang string, bits binary").collect()
    got.sort(key=lambda r: (r["lang"], str(r[key]), r["bits"]))
    bits = np.frombuffer(b"".join(r["bits"] for r in got), np.uint8).reshape(len(got), PLACES // 8)
    return fit(bits, [r["lang"] for r in got])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score added, from the text column alone.

    Null texts and texts without a letter get ``und`` and 0. Repeated rows each give a row. Columns of docs of these
    names are replaced. One scan, no shuffle; the broadcast is PLACES x languages numbers.
    """
    import pyarrow as pa

    spark = tune(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    held, columns, place = spark.sparkContext.broadcast(model), docs.columns, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            langs, scores = [], []
            for at in range(0, len(texts), 64):
                a, b = held.value.predict(texts[at : at + 64])
                langs += a
                scores.append(b)
            extra = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*columns, "lang_pred", "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """True for the rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Language of every whole text of documents: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without those whose language can't be told (null texts, texts without a letter); learned as in op1.

    Where nothing is labelled nothing can be learned, and a letter is all that is asked for.
    """
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return identify(docs, model).filter(F.col("lang_pred") != UNKNOWN).select(*docs.columns)
