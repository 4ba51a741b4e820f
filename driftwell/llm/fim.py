"""Fill-in-middle: a document is cut at two token boundaries and put together with its middle last.

Boundaries are found in a wavelet matrix over classes of characters. Two classes end a token; the ranks of both add up
to the number of boundaries before a place, and bisection on that number finds the place of a boundary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Marks of prefix, suffix and middle; a text that contains one stays plain.
MARKS = ("<P>", "<S>", "<M>")
#: Classes of characters: bit 1 for white space, bit 0 where a token ends.
WORD_END, SPACE_END = 0b01, 0b11


class WaveletMatrix:
    """Ranks of small symbols in a sequence, in time that grows with the bits of a symbol only.

    Level by level from the highest bit, the sequence is reordered stably: zeros, then ones. Each level keeps its bits in
    words of 64 and the ones before each word. Queries take arrays of positions.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.levels.append((level, words, before, len(symbols) - int(before[-1])))
            ones = bit.astype(bool)
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often symbol stands before each position."""
        begin, end = np.zeros_like(at), at
        for level, words, before, zeros in self.levels:
            one = lambda i, words=words, before=before: before[i >> 6] + np.bitwise_count(words[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            if symbol >> level & 1:
                begin, end = zeros + one(begin), zeros + one(end)
            else:
                begin, end = begin - one(begin), end - one(end)
        return end - begin


def boundary_classes(points: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Class of each code point of texts that lie one after another; stops: their ends.

    A token is a run of other characters with the white space before it; white space at a text's end is one too.
    """
    space = (points == 32) | ((points >= 9) & (points <= 13))
    last = np.zeros(len(points) + 1, bool)
    last[stops] = True  # the first code point of the next text
    last = last[1:]
    ends = last.copy()
    ends[:-1] |= space[1:]
    ends &= ~space | last
    return (space.astype(np.uint8) << 1) | ends


def cuts(texts: Sequence[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text, and the code points before its two cuts.

    draws: two numbers a text; modulo the tokens plus one they are the tokens before the cuts, the smaller first.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    tree = WaveletMatrix(boundary_classes(points, stops), 2)
    bounds = lambda at: tree.rank(WORD_END, at) + tree.rank(SPACE_END, at)
    base = bounds(starts)
    n = bounds(stops) - base
    wanted = np.sort(draws % (n[:, None] + 1), axis=1)
    places = []
    for k in range(2):
        low, high, goal = starts.copy(), stops.copy(), base + wanted[:, k]
        while (open_ := low < high).any():  # the first place with as many boundaries before it
            middle = (low + high) >> 1
            enough = bounds(middle) >= goal
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        places.append(low - starts)
    return n, places[0], places[1]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, marks: Sequence[str] = MARKS) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null where plain), output: a row for each row of docs.

    The first 16 bytes of the hash of seed and doc_id are four draws: two cuts, whether to cut (``rate`` in a hundred) and
    whether the suffix comes first (spm, ``suffix_first`` in a hundred; else psm). A text that is empty or holds a mark
    stays plain. Null texts count as empty, a null doc_id draws as an empty one; equal ids with equal texts give equal
    rows. Texts of any length are cut whole; a batch of texts is worked on at once. Other columns are not read.
    """
    import pyarrow as pa

    marks = tuple(marks)

    def run(batches):
        p, s, m = marks
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            drawn = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
            draws = np.frombuffer(b"".join(drawn), ">u4").astype(np.int64).reshape(-1, 4)
            n, first, second = cuts(texts, draws[:, :2])
            forms, prefix, middle, out = [], [], [], []
            for k, t in enumerate(texts):
                a, b = int(first[k]), int(second[k])
                if not t or draws[k, 2] % 100 >= rate or any(x in t for x in marks):
                    forms.append("plain"), prefix.append(None), middle.append(None), out.append(t)
                    continue
                spm = draws[k, 3] % 100 < suffix_first
                forms.append("spm" if spm else "psm"), prefix.append(a), middle.append(b - a)
                out.append(f"{s}{t[b:]}{p}{t[:a]}{m}{t[a:b]}" if spm else f"{p}{t[:a]}{s}{t[b:]}{m}{t[a:b]}")
            arrays = [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text again, from output and form alone: marks stand in no text that was cut, so they are found by splitting."""
    parts = F.split(output, "|".join(map(re.escape, marks)))
    part = lambda k: F.element_at(parts, k)
    return F.when(form == "psm", F.concat(part(2), part(4), part(3))).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(output)


def op12_fim(spark, sf_dir: str) -> DataFrame:
    """All documents transformed, with digests of the outputs and of the texts rebuilt from them."""
    rows = fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as d, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units from documents
), h as (
  select *, len(units) as n, ('0x' || d[1:8])::ubigint as h1, ('0x' || d[9:16])::ubigint as h2, ('0x' || d[17:24])::ubigint as h3, ('0x' || d[25:32])::ubigint as h4 from t
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from h
), p as (
  select doc_id, text, n, form, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:n], '') as suffix from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""
