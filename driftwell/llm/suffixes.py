"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

Texts are written once as compressed blocks. Every string of ``LENGTH`` bytes has a minimizer, the least hash of its
substrings of ``SEED`` bytes; equal strings have the same. Runs of strings with one minimizer are segments. First only the
minimizers are counted, a few bytes each: a segment whose minimizer no other document has is never sent. The others are
dealt to buckets by minimizer, so that all the places of a string meet in one bucket and buckets are independent. Copies
of a segment are folded before they are shuffled. A minimizer with more bytes than a share of a bucket, as at the edges
of a passage that many documents hold, would fill its bucket; its strings are dealt by a hash of the whole string
instead, one by one, and compared by 128 bits of hash.

In a bucket, segments that stand alone under their minimizer go. Copies of a segment are one, held by the least of their
documents; where a minimizer has no second segment that settles its strings. Of the others those go that share with no
other segment the seed and half of the rest of a string on one side of it: every string that two segments share holds
one of these. What is left is dealt to shards; each shard's transform is built once, and the transforms are merged by refining their interleave (Holt and McMillan 2014): pass h places the
suffixes in the order of their first h bytes by one stable counting step through the transforms, without comparing or
sorting suffixes again. Carrying the blocks of equal beginnings along gives the common prefixes (Egidi and Manzini
2017): after ``LENGTH`` passes each block is a repeated interval, and its least document owns the string.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, table, text_key, tune, utf8_column

LENGTH, SEED = 50, 20
#: Strings in a segment at most.
RUN = 64
#: Bytes of input whose segments one bucket holds, and segments in a shard.
BUCKET_BYTES, SHARD = 3 << 20, 4096
#: Bytes of text that are cut into segments at a time, and in a written block (more where a text has more).
BLOCK, PACKED = 8 << 20, 3 << 20
#: Bytes of a minimizer's segments, folded within blocks, from which its strings are dealt one by one.
HOT_BYTES = BUCKET_BYTES // 4
#: Bytes of segments in a bucket that are merged at a time.
MERGED = 1 << 20
#: Bytes after which segments that share nothing leave a merge.
EARLY = 16
#: Rows of a block are numbered below this, blocks of a partition below its square.
ROWS = 1 << 11

_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 << 41))
_P = 0x9E3779B97F4A7C15 | 1
#: A second hash, with other values and another base.
_BYTE2, _P2 = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 << 43)), 0xD1342543DE82EF95


def _seeds(data: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the ``seed`` bytes from each place, by doubling."""
    parts, size, h = [], 1, _BYTE[data]
    left, out, at = seed, None, 0
    while True:
        if left & size:
            shifted = h[at : at + len(data) - seed + 1]
            out = shifted.copy() if out is None else out + shifted * np.uint64(pow(_P, at, 1 << 64))
            at += size
            left -= size
        if not left:
            return mix64(out)
        h = h[:-size] + h[size:] * np.uint64(pow(_P, size, 1 << 64))
        size *= 2
        parts.append(size)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """Runs of strings of ``length`` bytes with one minimizer: start, number of strings, minimizer, text."""
    if len(data) < length:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    least = _least(_seeds(data, seed), length - seed + 1)
    valid = np.ones(len(least), bool)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = of[: len(least)] == of[length - 1 :]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (of[1 : len(least)] != of[: len(least) - 1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(change)
    n = np.diff(np.append(begin, len(least)))
    good = valid[begin]
    begin, n = begin[good], n[good]
    more = (n - 1) // RUN + 1
    if (more > 1).any():  # long runs, as of one repeated byte
        first = np.cumsum(more) - more
        k = np.arange(int(more.sum())) - np.repeat(first, more)
        begin, left = np.repeat(begin, more) + k * RUN, np.repeat(n, more) - k * RUN
        n = np.minimum(left, RUN)
    return begin, n, least[begin], of[begin]


def _ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)


def _codes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, values: np.ndarray = _BYTE, base: int = _P) -> np.ndarray:
    """A 64-bit hash of each stretch, from one running sum."""
    powers = np.multiply.accumulate(np.full(len(data) + 1, base, np.uint64))
    back = np.multiply.accumulate(np.full(len(data) + 1, pow(base, -1, 1 << 64), np.uint64))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[:-1], out=total[1:])
    return mix64((total[stop] - total[begin]) * back[begin] + (stop - begin).astype(np.uint64))


def blocks_of(rows: DataFrame) -> DataFrame:
    """doc_id, text (not null), skip, copy as blocks: block, ids, skip, sizes (bytes of each text), packed (their bytes,
    zstd), copy."""
    import pyarrow as pa
    from pyspark import TaskContext

    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        block = TaskContext.get().partitionId() * ROWS * ROWS
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            at = 0
            while at < batch.num_rows:
                to = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + PACKED, "right")) - 1), at + ROWS)
                ids, skip, copy = ([batch.column(j).slice(at, to - at).to_pylist()] for j in (0, 2, 3))
                packed = zstandard.compress(data[offsets[at] : offsets[to]].tobytes(), 3)
                columns = [pa.array([block]), pa.array(ids, pa.list_(batch.column(0).type)), pa.array(skip, pa.list_(pa.bool_())), pa.array([np.diff(offsets[at : to + 1])], pa.list_(pa.int64()))]
                columns += [pa.array([packed], pa.binary()), pa.array(copy, pa.list_(pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "skip", "sizes", "packed", "copy"])
                at, block = to, block + 1

    return rows.select("doc_id", "text", "skip", "copy").mapInArrow(run, f"block long, ids array<{kind}>, skip array<boolean>, sizes array<long>, packed binary, copy array<boolean>")


def _read(batch) -> Iterator[tuple[int, np.ndarray, np.ndarray, list, np.ndarray]]:
    """block, bytes, offsets, ids (as they are) and skip of each row of blocks_of()."""
    block, ids, skip, sizes = (batch.column(j).to_pylist() for j in range(4))
    for i, packed in enumerate(batch.column(4)):
        data = np.frombuffer(zstandard.decompress(packed.as_buffer()), np.uint8)
        yield block[i], data, np.concatenate([[0], np.cumsum(sizes[i])]).astype(np.int64), ids[i], np.array(skip[i], bool)


def _cut(data: np.ndarray, offsets: np.ndarray, skip: np.ndarray, length: int) -> list:
    """Segments of what is searched in a block: (bytes, offsets, first row, place in a long text, segments), some at a time."""
    out, at = [], 0
    while at < len(skip):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        for lo, hi, base in _stretches(offsets, at, to, length):
            own = np.array([0, hi - lo]) if base is not None else offsets[at : to + 1] - offsets[at]
            found = segments(data[lo:hi], own, length)
            good = ~skip[at + found[3]]
            out.append((data[lo:hi], own, at, base or 0, tuple(x[good] for x in found)))
        at = to
    return out


def _minimizers(cut_up: list, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The different minimizers of a block in the order of their buckets, and the buckets."""
    value = np.unique(np.concatenate([x[4][2] for x in cut_up]) if cut_up else np.zeros(0, np.uint64))
    bucket = (mix64(value) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return value[order], bucket[order]


def _seen(buckets: int, length: int):
    """A block's minimizers, by bucket: block, bucket, 4 bytes of each, and whether two rows have it, and its folded bytes."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = []
            for block, data, offsets, _, skip in _read(batch):
                cut_up = _cut(data, offsets, skip, length)
                value, bucket = _minimizers(cut_up, buckets)
                if not len(value):
                    continue
                sort, order = np.sort(value), np.argsort(value)
                size, low, high = np.zeros(len(value), np.int64), np.full(len(value), 1 << 62), np.full(len(value), -1)
                for text, _, first, _, (begin, n, least, of) in cut_up:
                    at = order[np.searchsorted(sort, least)]
                    np.minimum.at(low, at, first + of)
                    np.maximum.at(high, at, first + of)
                    again = np.flatnonzero(np.bincount(at, minlength=len(value))[at] > 1)
                    lone = np.ones(len(at), bool)
                    if len(again):  # copies count once
                        lone[again] = False
                        lone[again[np.unique(_codes(text, begin[again], begin[again] + n[again] + length - 1), return_index=True)[1]]] = True
                    size += np.bincount(at[lone], (n[lone] + length - 1), minlength=len(value)).astype(np.int64)
                marks, several = (value >> np.uint64(32)).astype("<u4"), low < high
                for k in _by_bucket(np.arange(len(value)), bucket):
                    rest = zstandard.compress(several[k].astype(np.uint8).tobytes() + size[k].astype("<u4").tobytes(), 3)
                    out.append((int(bucket[k[0]]), block, marks[k].tobytes(), rest))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "block", "marks", "rest"])

    return run


def _told(hot_bytes: int):
    """For each packet of a bucket: two bits a minimizer, whether another row has it, and whether it is hot."""
    import pyarrow as pa

    def run(group):
        marks = [np.frombuffer(x.as_buffer(), "<u4") for chunk in group["marks"].chunks for x in chunk]
        rest = [np.frombuffer(zstandard.decompress(x.as_buffer()), np.uint8) for chunk in group["rest"].chunks for x in chunk]
        lens = np.array([len(x) for x in marks])
        several = np.concatenate([r[:n] for r, n in zip(rest, lens, strict=True)])
        size = np.concatenate([r[n:].view("<u4") for r, n in zip(rest, lens, strict=True)]).astype(np.int64)
        _, back, count = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
        shared = (count > 1) | (np.bincount(back, several) > 0)
        hot = shared & (np.bincount(back, size) >= hot_bytes)
        ends = np.cumsum(lens)
        bits = [np.packbits(np.stack([shared[back[e - n : e]], hot[back[e - n : e]]])).tobytes() for e, n in zip(ends, lens, strict=True)]
        return pa.table({"block": group["block"], "bucket": group["bucket"], "bits": pa.array(bits, pa.binary())})

    return run


def dealt(blocks: DataFrame, buckets: int, length: int = LENGTH, hot_bytes: int | None = None) -> DataFrame:
    """bucket, packed segments and strings; and, with them, removals that are certain within one block."""
    import pyarrow as pa

    hot_bytes = HOT_BYTES if hot_bytes is None else hot_bytes
    seen = blocks.mapInArrow(_seen(buckets, length), "bucket int, block long, marks binary, rest binary")
    told = seen.groupBy("bucket").applyInArrow(_told(hot_bytes), "block long, bucket int, bits binary")
    told = told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("told"))
    both = blocks.join(told, "block").select("block", "ids", "skip", "sizes", "packed", "told")

    def run(batches):
        for batch in batches:
            for (block, data, offsets, ids, skip), told in zip(_read(batch), batch.column(5).to_pylist(), strict=True):
                cut_up = _cut(data, offsets, skip, length)
                value, bucket = _minimizers(cut_up, buckets)
                flags = np.zeros((2, len(value)), bool)
                for k, t in zip(_by_bucket(np.arange(len(value)), bucket), told, strict=True):
                    flags[:, k] = np.unpackbits(np.frombuffer(t["bits"], np.uint8))[: 2 * len(k)].reshape(2, -1)
                sort, order = np.sort(value), np.argsort(value)
                ids = np.array([0 if x is None else x for x in ids], np.int64)
                for text, own, first, base, (begin, n, least, of) in cut_up:
                    at = order[np.searchsorted(sort, least)]
                    go = flags[0][at]
                    rows = np.arange(first, first + len(own) - 1)
                    out = _pack(text, own, ids[rows], block * ROWS + rows, buckets, (begin[go], n[go], least[go], of[go]), flags[1][at][go], base, length)
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["bucket", "packed"])

    return both.mapInArrow(run, "bucket int, packed binary")


def _stretches(offsets, at, to, length):
    """Bytes to read at a time: several texts, or overlapping stretches of one long text (then with their place in it)."""
    low, high = int(offsets[at]), int(offsets[to])
    if to > at + 1 or high - low <= BLOCK:
        yield low, high, None
        return
    for lo in range(low, high, BLOCK):
        yield lo, min(high, lo + BLOCK + length - 1), lo - low


def _pack(data, offsets, ids, parts, buckets, found, single, base, length):
    """Packets of segments (start, strings, minimizer, text). single: whether the segment's strings go one by one."""
    begin, n, least, of = found
    if not len(begin):
        return []
    if single.any():  # a hot minimizer's segments become strings
        k = np.flatnonzero(single)
        cool = ~single
        begin, of = np.concatenate([begin[cool], _ragged(begin[k], n[k])]), np.concatenate([of[cool], np.repeat(of[k], n[k])])
        single = np.arange(len(begin)) >= int(cool.sum())
        n, least = np.concatenate([n[cool], np.ones(int(single.sum()), n.dtype)]), np.concatenate([least[cool], np.zeros(int(single.sum()), np.uint64)])
    stop = begin + n + length - 1
    code = _codes(data, begin, stop)
    least = np.where(single, code, least)
    order = np.argsort(code, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = code[order][1:] != code[order][:-1]
    group = np.cumsum(first) - 1
    owner = np.minimum.reduceat(ids[of[order]], np.flatnonzero(first))
    later = np.zeros(len(order), bool)
    later[order] = ids[of[order]] > owner[group]
    lead = np.empty(len(order), np.int64)  # of each segment: the one that stands for all like it, of the least document
    by_id = order[np.lexsort((ids[of[order]], group))]
    lead[by_id] = np.repeat(by_id[np.flatnonzero(first)], np.diff(np.append(np.flatnonzero(first), len(order))))
    later &= _same_bytes(data, begin, stop - begin, lead)  # a hash that unlike texts share folds nothing
    place = begin - offsets[of] + base
    bucket = (mix64(least) % np.uint64(buckets)).astype(np.int64)
    out = []
    gone = np.flatnonzero(later & single)
    if len(gone):  # a smaller document of this very batch holds the same hot string; any bucket will do
        out.append((int(mix64(ids[of[gone[:1]]].astype(np.uint64))[0] % np.uint64(buckets)), b"R" + zstandard.compress(np.stack([ids[of[gone]], parts[of[gone]], place[gone], place[gone] + (stop - begin)[gone]]).astype("<i8").tobytes(), 3)))
    if single.any():
        other = _codes(data, begin, stop, _BYTE2, _P2)
        for k in _by_bucket(np.flatnonzero(~later & single), bucket):
            strings = np.stack([code[k].view(np.int64), other[k].view(np.int64), ids[of[k]], parts[of[k]], place[k]]).astype("<i8")
            out.append((int(bucket[k[0]]), b"H" + zstandard.compress(strings.tobytes(), 3)))
    copies, at = np.flatnonzero(later & ~single), np.zeros(len(begin), np.int64)
    follow = dict(zip(bucket[[c[0] for c in _by_bucket(copies, bucket)]].tolist(), _by_bucket(copies, bucket), strict=True)) if len(copies) else {}
    for k in _by_bucket(np.flatnonzero(~later & ~single), bucket):
        text = data[_ragged(begin[k], (stop - begin)[k])]
        c, at[k] = follow.get(int(bucket[k[0]]), copies[:0]), np.arange(len(k))
        c = c[np.lexsort((place[c], of[c]))]
        refs = [_planes(x) for x in (at[lead[c]], np.diff(ids[of[c]], prepend=0), np.diff(place[c], prepend=0), np.diff(parts[of[c]], prepend=0))]
        head = [_planes(x) for x in (np.diff(ids[of[k]], prepend=0), np.diff(place[k], prepend=0), np.diff(parts[of[k]], prepend=0))]
        body = zstandard.compress(b"".join([*refs, *head, n[k].astype(np.uint8).tobytes(), text.tobytes()]), 3)
        marks = least[k].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 5:].tobytes()  # its three upper bytes; two minimizers under one mark cost time only
        out.append((int(bucket[k[0]]), b"S" + struct.pack("<qq", len(k), len(c)) + marks + body))
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers, all lowest bytes first and so on: zeros stand together, and compress to next to nothing."""
    return np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").reshape(-1)


def _same_bytes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Whether each stretch has the bytes of the one that leads it, which is as long. Compared byte by byte."""
    same, rows = np.ones(len(begin), bool), np.flatnonzero(lead != np.arange(len(begin)))
    rows = rows[size[rows] == size[lead[rows]]]
    same[(lead != np.arange(len(begin))) & (size != size[lead])] = False
    ends = np.cumsum(size[rows])
    for a, z in _shares(ends):
        k = rows[a:z]
        unlike = data[_ragged(begin[k], size[k])] != data[_ragged(begin[lead[k]], size[k])]
        if unlike.any():
            same[k[np.unique(np.searchsorted(np.cumsum(size[k]), np.flatnonzero(unlike), "right"))]] = False
    return same


def _shares(ends: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of rows whose bytes, summed up in ends, are ``most`` or little more."""
    out, at = [], 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        out.append((at, to))
        at = to
    return out


def _by_bucket(sent, bucket):
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    edges = np.flatnonzero(np.diff(bucket[sent], prepend=-1, append=-2)) if len(sent) else np.zeros(1, np.int64)
    return [sent[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _hot_ranges(strings: np.ndarray, length: int) -> np.ndarray:
    """doc_id, part, start, stop of the strings (code, other code, doc_id, part, place) that a smaller doc_id holds too."""
    order = np.lexsort((strings[2], strings[1], strings[0]))
    code, other, doc, part, place = strings[:, order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (other[1:] != other[:-1])
    first = np.flatnonzero(new)
    gone = np.repeat(doc[first], np.diff(np.append(first, len(doc)))) < doc
    return _joined(doc[gone], part[gone], place[gone], length)


def _joined(doc: np.ndarray, part: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Strings at neighbouring places as ranges: doc_id, part, start, stop."""
    order = np.lexsort((place, part, doc))
    doc, part, place = doc[order], part[order], place[order]
    new = np.ones(len(place), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (place[1:] != place[:-1] + 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(place)) - 1 if len(place) else a
    return np.stack([doc[a], part[a], place[a], place[z] + length])


def shard_transform(text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a shard's segments in the order of their first ``length`` bytes or more (ends first), and their transform.

    Suffixes are places in text; a segment's end is a place of its own. The transform has the two bytes before each, the
    nearer one as the lower; 0 where a segment begins. Bytes are raised by one, so that 0 marks ends.
    """
    n = len(begin)
    total = int((size + 1).sum())
    first = np.cumsum(size + 1) - (size + 1)
    line = np.zeros(total + length, np.uint8)  # UTF-8 has no byte 255
    where = _ragged(first, size)
    line[where] = text[_ragged(begin, size)] + np.uint8(1)
    # Keys of 8 bytes by doubling; what follows an end counts as 0. Then ranks by 8 bytes give those by 16, 32 and 64.
    suffix = np.arange(total)
    rest = np.repeat(size, size + 1) - (suffix - np.repeat(first, size + 1))  # bytes before the end
    owner = np.repeat(np.arange(n), size + 1)
    eight = line[:total].astype(np.uint64)
    for width in (1, 2, 4):
        after = np.zeros(total, np.uint64)
        after[: total - width] = eight[width:] if total > width else 0
        after[(eight & np.uint64(255)) == 0] = 0
        eight = eight << np.uint64(8 * width) | after
    order = np.argsort(eight, kind="stable")
    eight = eight[order]
    new = np.ones(total, bool)
    new[1:] = eight[1:] != eight[:-1]
    known = 8
    while known < length:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))  # the rest is already in place
        if not len(tied):
            break
        block = np.cumsum(new)
        rank = np.empty(total, np.int64)
        rank[order] = block
        sub = order[tied]
        key = block[tied] * (total + 1) + np.where(rest[sub] > known, rank[np.minimum(sub + known, total - 1)], 0)
        o = np.argsort(key, kind="stable")
        order[tied], key = sub[o], key[o]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] |= fresh
        known *= 2
    ends = np.flatnonzero(rest == 0)
    is_end = rest[order] == 0
    order = np.concatenate([ends, order[~is_end]])
    inside = suffix - first[owner]
    near, far = np.where(inside > 0, line[np.maximum(suffix - 1, 0)], 0), np.where(inside > 1, line[np.maximum(suffix - 2, 0)], 0)
    return order, (near.astype(np.uint16) | far.astype(np.uint16) << np.uint16(8))[order]


def merge(transforms: list[np.ndarray], ends: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge shard transforms: which shard each suffix of the merged order is from, and where blocks begin.

    ends: numbers of segments in the shards. A pass takes two bytes (for an odd length, the first takes one): after h
    bytes, suffixes are ordered by their first h bytes and blocks hold those that share them; segments' ends are unlike
    each other, so they are blocks of their own, as are their last bytes.
    """
    few = np.uint8 if len(transforms) < 256 else np.uint16  # small keys are counted, not compared, by a stable argsort
    shard = np.repeat(np.arange(len(transforms), dtype=few), [len(t) for t in transforms])
    joined = np.concatenate(transforms)
    n_ends = sum(ends)
    block = np.zeros(len(shard), np.int32)
    pair_at = joined  # the transforms' bytes in the merged order
    end_shards = np.repeat(np.arange(len(ends), dtype=few), ends)
    # A suffix of one byte has nothing two bytes after its beginning: it comes from the end, by that byte alone.
    lasts = np.concatenate([t[:n] & np.uint16(255) for t, n in zip(transforms, ends, strict=True)]) << np.uint16(8)
    alone = -1 - np.arange(n_ends, dtype=np.int32)
    new = np.ones(len(shard), bool)
    done = 0
    while done < length:
        if (length - done) % 2:  # suffixes that begin segments (byte 0) lead to ends, whose order is fixed
            char_at = pair_at & np.uint16(255)
            order = np.argsort(char_at, kind="stable")[n_ends:]
            char, old, come = char_at[order], block[order], shard[order]
        else:  # the first two suffixes of a segment lead to none
            char_at = np.concatenate([lasts, pair_at])
            order = np.argsort(char_at, kind="stable")[2 * n_ends :]
            char, old, come = char_at[order], np.concatenate([alone, block])[order], np.concatenate([end_shards, shard])[order]
        done += 2 - (length - done) % 2
        shard[n_ends:] = come
        shard[:n_ends] = end_shards
        new[n_ends + 1 :] = (char[1:] != char[:-1]) | (old[1:] != old[:-1])
        block = np.cumsum(new, dtype=np.int32)
        pair_at = np.empty_like(joined)
        if len(transforms) <= 6:
            for k, own in enumerate(transforms):
                pair_at[shard == k] = own
        else:
            pair_at[np.argsort(shard, kind="stable")] = joined
    return shard, new


def _merged(text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all suffixes of segments (places, segment after segment, each with its end), and where the
    intervals of equal first ``length`` bytes begin in it."""
    line = np.cumsum(size + 1) - (size + 1)
    orders, transforms, ends = [], [], []
    for at in range(0, len(begin), SHARD):
        own = slice(at, at + SHARD)
        order, before = shard_transform(text, begin[own], size[own], length)
        orders.append(order + line[at])
        transforms.append(before)
        ends.append(len(begin[own]))
    shard, new = merge(transforms, ends, length)
    merged = np.empty(len(shard), np.int64)
    merged[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    return merged, new


def _owners(text: np.ndarray, begin: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For each suffix of each segment (and its end), segment after segment: the least doc that holds its first bytes."""
    merged, new = _merged(text, begin, size, length)
    edges = np.flatnonzero(new)
    least = np.minimum.reduceat(np.repeat(doc, size + 1)[merged], edges)
    out = np.empty(len(merged), doc.dtype)
    out[merged] = np.repeat(least, np.diff(np.append(edges, len(merged))))
    return out


def _sharing(text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Whether any suffix of each segment stands in an interval with others after ``length`` bytes."""
    merged, new = _merged(text, begin, size, length)
    several = ~(new & np.append(new[1:], True))
    return np.bincount(np.repeat(np.arange(len(begin)), size + 1)[merged[several]], minlength=len(begin)) > 0


def _meeting(text: np.ndarray, begin: np.ndarray, size: np.ndarray, mark: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """The different segments that may share a string with another one.

    A string has its seed and ``length - seed`` more bytes, so at least half of these on one side of it. Segments whose
    seed with that half on the left, and with that half on the right, is nobody else's, share none.
    """
    several = np.unique(mark, return_inverse=True, return_counts=True)
    of = np.flatnonzero(several[2][several[1]] > 1)
    if not len(of):
        return of
    b, n, half = begin[of], size[of], (length - seed + 1) // 2
    places = n - seed + 1
    first = np.cumsum(places) - places
    h = _seeds(text, seed)[_ragged(b, places)]
    own = np.repeat(np.arange(len(of)), places)
    within = np.arange(len(h)) - first[own]
    least = np.minimum.reduceat(h, first)
    hit = np.flatnonzero(h == least[own])
    keep = np.bincount(own[hit], minlength=len(of)) != 1  # a seed that stands once is in every string; of several, any may be the shared one
    at = np.zeros(len(of), np.int64)
    at[own[hit]] = b[own[hit]] + within[hit]
    for low, high in ((at - half, at + seed), (at, at + seed + half)):
        inside = np.flatnonzero((low >= b) & (high <= b + n))
        _, back, count = np.unique(_codes(text, low[inside], high[inside]), return_inverse=True, return_counts=True)
        keep[inside[count[back] > 1]] = True
    return of[keep]


def _classes(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of segment, and each segment's kind. Like hashes are proven by bytes; unlike bytes under one
    hash are kinds of their own."""
    _, lead, back = np.unique(_codes(text, begin, begin + size), return_index=True, return_inverse=True)
    odd = np.flatnonzero(~_same_bytes(text, begin, size, lead[back]))
    if len(odd):
        kinds: dict[bytes, int] = {}
        for i in odd.tolist():
            back[i] = kinds.setdefault(text[begin[i] : begin[i] + size[i]].tobytes(), len(lead) + len(kinds))
        lead = np.concatenate([lead, odd[np.unique(back[odd], return_index=True)[1]]])
    return lead, back


def _settled(text: np.ndarray, mark: np.ndarray, doc: np.ndarray, part: np.ndarray, place: np.ndarray, n: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """doc_id, part, start, stop of the strings of segments that a smaller doc_id holds too. text: segment after segment.
    copies: segment, doc_id, part, place of more segments with the bytes of one that is there.

    Copies of a segment are one string with the least of their documents; every kind of segment that has copies, or may
    share a string with another one, goes into shards. So what goes is always decided by an interval of a merge. Kinds that
    have copies only are merged by themselves first: a segment whose suffixes all have intervals of their own after EARLY
    bytes has them after ``length`` too, and owns its strings; the others join the rest.
    """
    size = n + length - 1
    begin = np.cumsum(size) - size
    lead, back = _classes(text, begin, size)
    of = np.concatenate([np.arange(len(doc)), copies[0]])
    back, doc, part, place = back[of], np.concatenate([doc, copies[1]]), np.concatenate([part, copies[2]]), np.concatenate([place, copies[3]])
    holder = np.full(len(lead), np.iinfo(np.int64).max)
    np.minimum.at(holder, back, doc)
    met = _meeting(text, begin[lead], size[lead], mark[lead], length)
    copied = np.setdiff1d(np.flatnonzero(np.bincount(back, minlength=len(lead)) > 1), met)
    if len(copied):
        met = np.union1d(met, copied[_sharing(text, begin[lead][copied], size[lead][copied], min(EARLY, length))])
    first = np.cumsum(n[lead]) - n[lead]
    owner = np.repeat(holder, n[lead])  # of each string; its only document, where a segment has no copy and meets no other
    if len(met):
        line = np.cumsum(size[lead][met] + 1) - (size[lead][met] + 1)
        merged = _owners(text, begin[lead][met], size[lead][met], holder[met], length)
        owner[_ragged(first[met], n[lead][met])] = merged[_ragged(line, n[lead][met])]
    n = n[of]
    gone = owner[_ragged(first[back], n)] < np.repeat(doc, n)
    return _joined(np.repeat(doc, n)[gone], np.repeat(part, n)[gone], _ragged(place, n)[gone], length)


def _bucket(length: int):
    import pyarrow as pa

    def run(group):
        marks, docs, places, rows, strings, texts, gone, hot, refs, at = [], [], [], [], [], [], [], [], [], 0
        for row in (x for chunk in group["packed"].chunks for x in chunk):
            raw = row.as_py()
            if raw[:1] == b"H":
                hot.append(np.frombuffer(zstandard.decompress(raw[1:]), "<i8").reshape(5, -1))
                continue
            if raw[:1] == b"R":
                gone.append(np.frombuffer(zstandard.decompress(raw[1:]), "<i8").reshape(4, -1))
                continue
            n, c = struct.unpack("<qq", raw[1:17])
            marks.append(np.frombuffer(raw, np.uint8, 3 * n, 17).reshape(-1, 3) @ np.array([1, 1 << 8, 1 << 16]))
            body = np.frombuffer(zstandard.decompress(raw[17 + 3 * n :]), np.uint8)
            ref, copy_doc, copy_place, copy_part = (_from_planes(body[8 * c * j : 8 * c * (j + 1)]) for j in range(4))
            refs.append(np.stack([ref + at, np.cumsum(copy_doc), np.cumsum(copy_part), np.cumsum(copy_place)]))
            body, at = body[32 * c :], at + n
            for column, j in ((docs, 0), (places, 1), (rows, 2)):
                column.append(np.cumsum(_from_planes(body[8 * n * j : 8 * n * (j + 1)])))
            strings.append(body[24 * n : 25 * n].astype(np.int64))
            texts.append(body[25 * n :])
        parts = list(gone)
        if hot:
            parts.append(_hot_ranges(np.concatenate(hot, axis=1), length))
        if marks:
            mark, doc, place, row, n, text = (np.concatenate(x) for x in (marks, docs, places, rows, strings, texts))
            copies = np.concatenate(refs, axis=1)
            size = n + length - 1
            begin = np.cumsum(size) - size
            order = np.argsort(mark, kind="stable")
            edges = np.flatnonzero(np.diff(mark[order], prepend=-1))
            least, most = doc.copy(), doc.copy()
            np.minimum.at(least, copies[0], copies[1])
            np.maximum.at(most, copies[0], copies[1])
            low, high = np.minimum.reduceat(least[order], edges), np.maximum.reduceat(most[order], edges)
            count = np.diff(np.append(edges, len(order)))
            chosen = order[np.repeat(low < high, count)]  # in the order of marks
            # Marks are independent of each other: some at a time bound the memory.
            fresh = np.diff(mark[chosen], prepend=-1) != 0
            before = np.cumsum(size[chosen]) - size[chosen]
            share = np.maximum.accumulate(np.where(fresh, before, 0)) // MERGED
            share_of, at_ = np.full(len(mark), -1), np.zeros(len(mark), np.int64)
            share_of[chosen] = share
            copies = copies[:, np.argsort(share_of[copies[0]], kind="stable")]
            copy_share = share_of[copies[0]]
            for own in np.split(chosen, np.flatnonzero(np.diff(share)) + 1) if len(chosen) else []:
                text_own, at_[own] = text[_ragged(begin[own], size[own])], np.arange(len(own))
                a, z = np.searchsorted(copy_share, share_of[own[0]], "left"), np.searchsorted(copy_share, share_of[own[0]], "right")
                mine = np.concatenate([at_[copies[:1, a:z]], copies[1:, a:z]])
                parts.append(_settled(text_own, mark[own], doc[own], row[own], place[own], n[own], mine, length))
        done = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64)
        return pa.table({name: pa.array(done[k], pa.int64()) for k, name in enumerate(("doc_id", "part", "start", "stop"))})

    return run


def repeated_ranges(blocks: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """doc_id, part, start, stop (bytes) of stretches whose every string of ``length`` bytes starts in a smaller doc_id too.

    part: the block's number times ROWS, and the row's in it. Ranges of a text may touch or overlap. Buckets follow the
    input, partitions the session's settings.
    """
    return dealt(blocks, buckets, length).groupBy("bucket").applyInArrow(_bucket(length), "doc_id long, part long, start long, stop long")


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts in a document with a smaller doc_id.

    Texts are UTF-8 bytes; null counts as empty; strings never cross documents; they are judged on the input. Texts
    that are equal as a whole are one to the search, with their smallest doc_id; the others of them go whole. Rows
    that repeat doc_id and text have the same result; rows that share a doc_id don't remove from each other. Rows with
    null doc_id lose and take nothing. Empty tables give no rows, other columns are not read, and a text of any length is
    cut in stretches that overlap. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).
    """
    import pyarrow as pa

    tune(docs.sparkSession)
    rows = docs.select(*text_key(), F.coalesce("text", F.lit("")).alias("text"))
    keys = rows.filter(F.octet_length("text") >= length).filter("doc_id is not null").select("doc_id", "text_hash", F.xxhash64(F.lit(1), "text").alias("other_hash"))
    least = cut(keys.groupBy("text_hash", "other_hash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    copies = cut(keys.join(least, ["text_hash", "other_hash"]).filter("doc_id > first").select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")).distinct())
    copy = (F.col("doc_id") == F.col("copy_id")) & (F.col("text_hash") == F.col("copy_hash"))
    flagged = rows.join(F.broadcast(copies) if copies.count() <= 200_000 else copies, copy, "left")  # 16 bytes each
    # 0: searched, 1: neither searched nor changed, 2: a copy, which goes whole.
    state = F.when(F.col("copy_id").isNotNull(), 2).when(F.col("doc_id").isNull() | (F.octet_length("text") < length), 1).otherwise(0)
    blocks = cut(blocks_of(flagged.select("doc_id", "text", (state > 0).alias("skip"), (state == 2).alias("copy"))))
    total = blocks.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).agg(F.sum("n")).first()[0] or 0
    ranges = repeated_ranges(blocks, max(1, -(-total // BUCKET_BYTES)), length)
    ranges = ranges.groupBy(F.floor(F.col("part") / ROWS).alias("range_block")).agg(F.collect_list(F.struct((F.col("part") % ROWS).alias("row"), "start", "stop")).alias("ranges"))
    marked = blocks.join(cut(ranges), F.col("block") == F.col("range_block"), "left").select("block", "ids", "skip", "sizes", "packed", "copy", "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for (_, data, offsets, ids, _), copy, found in zip(_read(batch), batch.column(5).to_pylist(), batch.column(6), strict=True):
                cover = np.zeros(len(data) + 1, np.int32)
                if found.is_valid and len(found):
                    row, start, stop = (found.values.field(j).to_numpy(zero_copy_only=False) for j in range(3))
                    np.add.at(cover, offsets[row] + start, 1)
                    np.add.at(cover, offsets[row] + stop, -1)
                hit = np.cumsum(cover[:-1]) > 0
                out = []
                for i, gone in enumerate(copy):
                    x, h = data[offsets[i] : offsets[i + 1]], hit[offsets[i] : offsets[i + 1]]
                    h = np.ones(len(x), bool) if gone else h
                    spans = int(h[0]) + int((h[1:] & ~h[:-1]).sum()) if len(h) else 0
                    out.append((len(x), int(h.sum()), spans, x[~h].tobytes()))
                columns = [pa.array([o[j] for o in out], pa.int64()) for j in range(3)]
                columns += [pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string()), pa.array([o[3] for o in out], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(1).type.value_type), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return marked.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op2_suffix_merge(spark, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings removed from all documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")
