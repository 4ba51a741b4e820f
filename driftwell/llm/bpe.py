"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the correct tokenizations. It starts as one state with a loop on
every base symbol. Each merge (a, b) -> c, in rank order, adds one gadget: the target of the a-arcs gets its own
state, which loses its b-arc; wherever an a-arc led to a b-arc, a c-arc now leads to the target of b. An arc's
target depends on its label only, so a state is shared by all the tokens that lead to it, and arcs that leave the
same states share a column of the transition table. The table is therefore (states x columns) bits.

A worker's tables are small: the bits, and the spelling tree as a double array (Aoe 1989), where rows of edges are
shifted until they fit into each other's gaps.

A word's symbols are spelled by exactly one accepted path. Texts are cut into words, equal words are encoded once
a batch, and all words of a batch advance together, one table lookup for each step. Decoding emits the labels of
the arcs that the ids name.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import mix64, table, tune

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
#: Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Endings that the vocabulary's splitting pattern takes together with an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Code points encoded at a time, which bounds a worker's memory.
CHUNK = 1 << 19
#: Encoded words that a worker remembers before it starts anew, and their code points.
KNOWN, KNOWN_SIZE = 300_000, 4_000_000
#: Words of more bytes than this advance alone.
LONG = 64


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


def classes() -> np.ndarray:
    """Class of each code point: space, letter, digit (any number) or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = DIGIT
    out[WHITE_SPACE] = SPACE
    return out


@dataclass
class Automaton:
    """The compiled tables; all are bounded by the vocabulary."""

    labels: list[str]
    specials: dict[str, int]
    state: np.ndarray  # of the arc's target, by token
    column: np.ndarray  # of the arc, by token
    arcs: np.ndarray  # bits: states x columns
    length: np.ndarray  # base symbols of each token
    shift: np.ndarray  # spelling tree: place of a node's row of edges in the two below
    owner: np.ndarray  # the node that an edge leaves
    to: np.ndarray  # the node that it leads to
    inner: np.ndarray  # token spelled by a node inside a word, or -1
    final: np.ndarray  # token spelled by a node at a word's end, or -1
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_ready": {}}

    # ---- tables that each worker derives once

    def ready(self) -> dict:
        if not self._ready:
            self._ready = {
                "class": classes(), "split": re.compile("|".join(map(re.escape, self.specials))) if self.specials else None,
                "labels": np.array(self.labels, dtype=object),
                "known": no_words(),
            }
        return self._ready

    def step(self, node, symbol):
        """The node below ``node`` by ``symbol``, or -1."""
        at = self.shift[node] + symbol
        return np.where(self.owner[at] == node, self.to[at], np.int32(-1))

    def follows(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether there is an arc for token in the state that last leads to."""
        col = self.column[token]
        return (self.arcs[self.state[last], col >> 3] >> (col & 7).astype(np.uint8)) & 1 == 1

    # ---- words

    def _together(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words of nearly equal length: (words x places) with -1 after the end, and their numbers."""
        n, width = symbols.shape
        last = np.full((n, width + 1), -1, np.int32)
        for j in range(width):
            at = np.flatnonzero((lens > j) & (last[:, j] >= 0)) if j else np.flatnonzero(lens > 0)
            node = np.zeros(len(at), np.int32)
            for end in range(j + 1, width + 1):
                if not len(at):
                    break
                node = self.step(node, symbols[at, end - 1])
                token = np.where(lens[at] == end, self.final[node], self.inner[node])
                good = np.flatnonzero((node >= 0) & (token >= 0))
                if j and len(good):
                    good = good[self.follows(last[at[good], j], token[good])]
                last[at[good], end] = token[good]
                on = (node >= 0) & (lens[at] > end)
                at, node = at[on], node[on]
        out, count, end = np.full((n, width), -1, np.int32), np.zeros(n, np.int64), lens.copy()
        rows = np.arange(n)
        while len(rows := rows[end[rows] > 0]):
            token = last[rows, end[rows]]
            if (token < 0).any():
                raise ValueError("a word has no accepted path; the vocabulary lacks a base symbol")
            out[rows, count[rows]] = token
            count[rows] += 1
            end[rows] -= self.length[token]
        return out, count

    def _alone(self, word: bytes) -> list[int]:
        n, inner, final = len(word), self.inner, self.final
        last = [-1] * (n + 1)
        for j in range(n):
            if j and last[j] < 0:
                continue
            node = 0
            for end in range(j + 1, n + 1):
                node = int(self.step(node, word[end - 1]))
                if node < 0:
                    break
                t = int(final[node] if end == n else inner[node])
                if t >= 0 and (not j or bool(self.arcs[self.state[last[j]], self.column[t] >> 3] >> (self.column[t] & 7) & 1)):
                    last[end] = t
        out, end = [], n
        while end > 0:
            if last[end] < 0:
                raise ValueError("a word has no accepted path; the vocabulary lacks a base symbol")
            out.append(last[end])
            end -= int(self.length[last[end]])
        return out[::-1]

    def words(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many words, flat, and how many each word has. data: bytes; starts, lens: of the words."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 6, 8, 10, 12, 16, 24, 32, LONG):
            for at in np.array_split(chosen := np.flatnonzero((lens > low) & (lens <= high)), max(1, len(chosen) // 16384)):
                if not len(at):
                    continue
                places = starts[at][:, None] + np.arange(high)
                symbols = data[np.minimum(places, len(data) - 1)]
                out, n = self._together(symbols, lens[at])
                counts[at] = n
                parts.append((at, out[:, ::-1][out[:, ::-1] >= 0], n))
            low = high
        for k in np.flatnonzero(lens > LONG):
            got = self._alone(data[starts[k] : starts[k] + lens[k]].tobytes())
            counts[k] = len(got)
            parts.append((np.array([k]), np.array(got, np.int32), counts[k : k + 1]))
        flat = np.empty(int(counts.sum()), np.int32)
        begins = np.concatenate([[0], np.cumsum(counts)])[:-1]
        for at, tokens, n in parts:
            flat[ragged(begins[at], n)] = tokens
        return flat, counts

    # ---- texts

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, flat, and how many each text has."""
        r = self.ready()
        joined = "\n".join(texts) + "\n"
        ascii_only = joined.isascii()
        if not ascii_only:
            # In the library, normalisation is a text's own and letters are lower-cased one by one.
            if not unicodedata.is_normalized("NFC", joined):
                texts = [unicodedata.normalize("NFC", x) for x in texts]
            texts = [x.replace("Σ", "σ").lower() for x in texts]
            joined = "\n".join(texts) + "\n"
        else:
            joined = joined.lower()
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
        kind = r["class"][cps]
        change = np.ones(len(cps), bool)
        change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        begin = np.flatnonzero(change)
        stop = np.append(begin[1:], len(cps))
        lone = np.flatnonzero((cps[begin] == 39) & (stop - begin == 1))
        lone = lone[lone + 1 < len(begin)]
        lone = lone[kind[begin[lone + 1]] == LETTER]
        for k in lone:  # an apostrophe of its own before letters may take an ending with it
            word = joined[begin[k + 1] : min(begin[k + 1] + 2, stop[k + 1])]
            if ending := next((e for e in ENDINGS if word.startswith(e)), None):
                stop[k] += len(ending)
                begin[k + 1] += len(ending)
        keep = (kind[begin] != SPACE) & (stop > begin)
        begin, stop = begin[keep], stop[keep]
        n = stop - begin
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        place = ragged(begin, n)
        within = place - np.repeat(begin, n)
        powers = np.multiply.accumulate(np.full(int(n.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
        values = mix64(cps[place].astype(np.uint64)) * powers[within]
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        code = mix64(np.add.reduceat(values, first) + n.astype(np.uint64))
        _, where, back = np.unique(code, return_index=True, return_inverse=True)
        same = cps[place] == cps[np.minimum(np.repeat(begin[where][back], n) + within, len(cps) - 1)]
        clash = not (same.all() and (n == n[where][back]).all())
        if clash:  # two words with one hash: tell words apart by themselves, and remember none
            _, where, back = np.unique([joined[b:e] for b, e in zip(begin, stop, strict=True)], return_index=True, return_inverse=True)
        blob = joined.encode("utf-8", "surrogatepass")
        data = np.frombuffer(blob, np.uint8)
        if len(data) == len(cps):
            offset = None
        else:
            offset = np.concatenate([[0], np.cumsum(1 + (cps >= 0x80) + (cps >= 0x800) + (cps >= 0x10000), dtype=np.int64)])
        at, to = (begin[where], stop[where]) if offset is None else (offset[begin[where]], offset[stop[where]])
        known, size, word = r["known"], n[where], begin[where]
        if clash or len(known["code"]) > KNOWN or len(known["cps"]) > KNOWN_SIZE:
            known = r["known"] = no_words()
        code = code[where]  # ascending, unless words clash
        slot = np.minimum(np.searchsorted(known["code"], code), max(0, len(known["code"]) - 1))
        held = np.zeros(len(code), bool)
        if len(known["code"]) and not clash:
            taken = known["code"][slot] == code
            k = np.flatnonzero(taken & (known["size"][slot] == size))
            if len(k):  # what has the hash of a known word must be that word
                alike = cps[ragged(word[k], size[k])] == known["cps"][ragged(known["from"][slot[k]], size[k])]
                held[k] = np.logical_and.reduceat(alike, np.cumsum(size[k]) - size[k])
        else:
            taken = held
        new = np.flatnonzero(~held)
        flat, n_new = self.words(data, at[new], (to - at)[new])
        tokens, first, counts = np.concatenate([known["flat"], flat]), np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        first[held], counts[held] = known["at"][slot[held]], known["n"][slot[held]]
        first[new], counts[new] = len(known["flat"]) + np.cumsum(n_new) - n_new, n_new
        add = np.flatnonzero(~held & ~taken)
        if len(add) and not clash:
            order = np.argsort(np.concatenate([known["code"], code[add]]), kind="stable")
            more = {"code": code[add], "size": size[add], "from": len(known["cps"]) + np.cumsum(size[add]) - size[add], "at": first[add], "n": counts[add]}
            r["known"] = {name: np.concatenate([known[name], x])[order] for name, x in more.items()}
            r["known"] |= {"cps": np.concatenate([known["cps"], cps[ragged(word[add], size[add])]]), "flat": tokens}
        counts = counts[back]
        ids = tokens[ragged(first[back], counts)]
        of = np.searchsorted(edges, begin, "right") - 1
        return ids, np.bincount(of, weights=counts, minlength=len(texts)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none), as int32 arrays."""
        r = self.ready()
        pieces, spread = [], []  # spread: for each text, the pieces and special ids that make it up
        for x in texts:
            x, own, at = x or "", [], 0
            if "<|" in x and r["split"]:
                for m in r["split"].finditer(x):
                    own += [("piece", x[at : m.start()]), ("id", self.specials[m[0]])]
                    at = m.end()
            own.append(("piece", x[at:] if at else x))
            row = []
            for what, y in own:
                if what == "id":
                    row.append(np.array([y], np.int32))
                else:
                    for part in parts(y, r["class"]):
                        row.append(len(pieces))
                        pieces.append(part)
            spread.append(row)
        done: list[np.ndarray] = []
        at = 0
        while at < len(pieces):
            to, size = at, 0
            while to < len(pieces) and (to == at or size + len(pieces[to]) <= CHUNK):
                size += len(pieces[to]) + 1
                to += 1
            ids, counts = self._plain(pieces[at:to])
            done += np.split(ids, np.cumsum(counts)[:-1])
            at = to
        return [y if not isinstance(y, int) else done[y] for (y,) in spread] if all(len(x) == 1 for x in spread) else [
            np.concatenate([done[y] if isinstance(y, int) else y for y in row]) for row in spread
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The arcs' labels, one after another with a space between, as the library joins them."""
        return " ".join(self.ready()["labels"][ids].tolist())


def double_array(parent: list[int], symbol: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges parent[k] -> k by symbol[k] (k from 1) as shifted rows: each node's shift, and the owner and target at a place."""
    below: dict[int, list[int]] = {}
    for k in range(1, len(parent)):
        below.setdefault(parent[k], []).append(k)
    shift = np.zeros(len(parent), np.int32)
    size = 256 * len(below) + 2048
    owner, to, at, window = np.full(size, -1, np.int32), np.full(size, -1, np.int32), 0, np.arange(256)[:, None]
    for node, kids in sorted(below.items(), key=lambda x: -len(x[1])):
        if len(kids) == 1:
            break
        own = np.array([symbol[k] for k in kids])
        while not len(fits := np.flatnonzero((owner[at : at + 1024][window + own] < 0).all(1))):
            at += 128  # what is free before it is left to lone edges
        shift[node] = at + fits[0]
        owner[shift[node] + own], to[shift[node] + own] = node, kids
    lone = np.array([kids[0] for kids in below.values() if len(kids) == 1], np.int64)  # one edge fits any gap
    gaps = np.flatnonzero(owner[256:] < 0)[: len(lone)] + 256
    node = np.array(parent)[lone]
    shift[node] = gaps - np.array(symbol)[lone]
    owner[gaps], to[gaps] = node, lone
    used = int(np.flatnonzero(owner >= 0)[-1]) + 257  # any symbol may be looked up at the last shift
    owner, to = owner[:used].copy(), to[:used].copy()
    return shift, owner, to


def no_words() -> dict:
    """An empty memory of encoded words, by hash: their code points (size of them from a place on) and tokens."""
    none = np.zeros(0, np.int64)
    return {"code": np.zeros(0, np.uint64), "size": none, "from": none, "at": none, "n": none, "cps": np.zeros(0, np.uint32), "flat": np.zeros(0, np.int32)}


def parts(text: str, kinds: np.ndarray):
    """A text in parts of about CHUNK code points at most, cut before white space only."""
    while len(text) > CHUNK:
        window = np.frombuffer(text[:CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        gaps = np.flatnonzero(kinds[window] == SPACE)
        if len(gaps) and gaps[-1] > 0:
            at = int(gaps[-1])
        else:
            more = re.compile(r"[ \t-\r]").search(text, CHUNK)
            if not more:
                break
            at = more.start()
        yield text[:at]
        text = text[at:]
    yield text


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + lens[0] - 1, then the same for the next, and so on."""
    lens = np.asarray(lens, np.int64)
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lens), lens)


@lru_cache(maxsize=2)
def compile_automaton(path: str) -> Automaton:
    """Compile a vocabulary file's merges, gadget by gadget."""
    spec = json.load(open(path, encoding="utf-8"))
    model, vocab = spec["model"], spec["model"]["vocab"]
    mark = model.get("end_of_word_suffix") or ""
    specials = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    size = max([*vocab.values(), *specials.values()]) + 1
    labels = [""] * size
    for word, k in [*vocab.items(), *specials.items()]:
        labels[k] = word
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    width = len(merges) + 2
    state, column = [0] * size, [0] * size
    tokens_in, tokens_of = {0: size}, {0: size, 1: 0}
    arcs = np.zeros((1024, width // 8 + 1), np.uint8)
    arcs[0, 0] = 1  # column 0: arcs of base symbols; column 1: of tokens that nothing can lead to
    states, columns = 1, 2
    length = [1] * size
    for left, right in merges:
        a, b, c = vocab[left], vocab[right], vocab[left + right]
        length[c] = length[a] + length[b]
        tokens_in[state[c]] -= 1
        tokens_of[column[c]] -= 1
        state[c] = state[b]
        tokens_in[state[b]] += 1
        if not arcs[state[a], column[b] >> 3] >> (column[b] & 7) & 1:
            column[c] = 1
            tokens_of[1] += 1
            continue
        if tokens_in[state[a]] > 1:
            tokens_in[state[a]] -= 1
            if states == len(arcs):
                arcs = np.concatenate([arcs, np.zeros_like(arcs)])
            arcs[states] = arcs[state[a]]
            state[a], tokens_in[states] = states, 1
            states += 1
        if tokens_of[column[b]] > 1:
            old = column[b]
            tokens_of[old] -= 1
            arcs[:states, columns >> 3] |= ((arcs[:states, old >> 3] >> (old & 7)) & 1) << (columns & 7)
            column[b], tokens_of[columns] = columns, 1
            columns += 1
        arcs[state[a], column[b] >> 3] &= 255 ^ (1 << (column[b] & 7))
        column[c] = column[a]
        tokens_of[column[a]] += 1
    byte_of = {ch: k for k, ch in enumerate(byte_characters())}
    nodes: dict[tuple[int, int], int] = {}
    parent, symbol, inner, final = [0], [0], [-1], [-1]
    for word, k in vocab.items():
        if word in specials:
            continue
        ends = bool(mark) and word.endswith(mark)
        node = 0
        for ch in word[: -len(mark)] if ends else word:
            key = (node, byte_of[ch])
            if key not in nodes:
                nodes[key] = len(parent)
                parent.append(node)
                symbol.append(key[1])
                inner.append(-1)
                final.append(-1)
            node = nodes[key]
        if ends or not mark:
            final[node] = k
        if not ends:
            inner[node] = k
    i32 = lambda x: np.array(x, np.int32)
    table = np.ascontiguousarray(arcs[:states, : columns // 8 + 1])
    return Automaton(labels, specials, i32(state), i32(column), table, i32(length), *double_array(parent, symbol), i32(inner), i32(final))


def shared_automaton(spark, path: str):
    """The compiled automaton as a broadcast; its size depends on the vocabulary alone."""
    return spark.sparkContext.broadcast(compile_automaton(path))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True) -> DataFrame:
    """Encode a text column and decode it again.

    Returns ``keep`` and: ids array<int> (where asked for), n_tokens, ids_sha256 of the ids as little-endian unsigned
    32-bit integers, decoded (where ids are asked for), decoded_sha256. Null and empty texts have no ids; decoding
    gives the empty text. Repeated rows each give a row; other columns are not read. Strings of special tokens in a
    text become their ids, as in the library. One scan, no shuffle.
    """
    import pyarrow as pa

    spark = tune(docs.sparkSession)
    held = shared_automaton(spark, path)
    source = docs.select(*keep, text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    more = ["ids array<int>", "decoded string"] if ids else []

    def run(batches):
        automaton = held.value
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            rows = automaton.encode(texts)
            decoded = [automaton.decode(x) for x in rows]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [
                pa.array([len(x) for x in rows], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in rows], pa.string()),
                pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in decoded], pa.string()),
            ]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns += [pa.array(rows, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, ", ".join([*fields, "n_tokens long", "ids_sha256 string", "decoded_sha256 string", *more]))


def op10_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every whole text of documents encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    from .vocab import vocabulary

    return encode(table(spark, sf_dir, "documents", "doc_id", "text"), path or vocabulary("word_bpe_49k.json"), ids=False)
