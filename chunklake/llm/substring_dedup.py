"""Repeated byte strings by a hash-compared suffix sort (operator 7).

Every string of ``width`` bytes holds an anchor: the gram of 100 bytes, of those
inside it, whose hash is least.  Equal strings have the same anchor at the same
place, so only suffixes that start near equal anchors have to be compared, and
anchors are what documents are shuffled by: about one for 150 bytes, with the
range of starts that choose it and a hash of that whole region.

Regions that occur more than once are repeated as they are.  Of the others, one
for each content is fetched, and the suffixes at equal anchors are sorted by
mergesort.  A comparison takes prefix polynomial hashes and a binary search for
the common extension, so a logarithm of steps; a found extension is compared
byte by byte before it counts.  Sorted neighbours share the longest extensions
to the right; a second sort gives those to the left; together they say which
starts are repeated.  An anchor with more different regions than one task should
hold is not sorted in one: its strings are counted start by start, over all tasks.

Passages of 50 words, most of them shorter than 400 bytes, are not removed but
reported where another document has them too: by the same anchors, over words.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import keyed_rows, materialize, release, table

WIDTH = 400
GRAM = 100
#: Words of a passage that is reported, and of the grams that anchor it.
WORDS = 50
WORD_GRAM = 8
#: Bytes that are hashed together.
SLICE = 1 << 22
#: Different regions at one anchor that one task sorts, at most: some 6 MB of text, and 100 MB while they are sorted.
TOGETHER = 8192

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FULL = (1 << 64) - 1
_LOW = (1 << 24) - 1
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: A random number for each byte.
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(data: bytes | np.ndarray) -> np.ndarray:
    """Polynomial hashes of the prefixes of ``data``, bytes or numbers, the empty one first."""
    out = np.zeros(len(data) + 1, np.uint64)
    values = _BYTES[np.frombuffer(data, np.uint8)] if isinstance(data, bytes) else data
    np.cumsum(values * _power(len(data))[0], out=out[1:])
    return out


def word_hashes(data: bytes) -> np.ndarray:
    """A number for each word of ``data``, which is split in slices that end at blanks."""
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        blank = _BLANK.search(data, at + SLICE)
        end = blank.start() if blank else len(data)
        words = data[at:end].split()
        out.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _chosen(data: bytes | np.ndarray, width: int, gram: int) -> Iterator[tuple]:
    """Anchors of ``data``, bytes or numbers, by slices: (place and content of the slice, its prefix hashes, and as arrays in it: anchor hashes, first and last starts, anchors' places)."""
    for base in range(0, max(0, len(data) - width + 1), SLICE):
        part = data[base : base + SLICE + width - 1]
        if len(part) < width:
            break
        s = prefix_hashes(part)
        n = len(part) - gram + 1
        h = (s[gram:] - s[:n]) * _power(n)[1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # Ties go to the later place: the low bits count down.
        places = np.uint64(_LOW) - np.arange(n, dtype=np.uint64)
        least = _least((h & ~np.uint64(_LOW)) | places, width - gram + 1)
        at = _LOW - (least & np.uint64(_LOW)).astype(np.int64)
        edge = np.flatnonzero(np.diff(at)) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(at)]]) - 1
        yield base, part, s, h[at[first]].view(np.int64), first, last, at[first]


def regions(data: bytes, width: int = WIDTH, gram: int = GRAM) -> list[tuple[int, int, int, int, int]]:
    """(anchor hash, first start, last start, anchor's place, region hash) of ``data``'s anchors."""
    out: list[tuple[int, int, int, int, int]] = []
    for base, part, _, keys, first, last, at in _chosen(data, width, gram):
        for a, lo, hi, key in zip(at.tolist(), first.tolist(), last.tolist(), keys.tolist(), strict=True):
            out.append((key, base + lo, base + hi, base + a, xxhash.xxh64_intdigest(part[lo : hi + width], a - lo) - (1 << 63)))
    return out


def _anchors(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    names = ["_row", "anchor", "lo", "hi", "at", "region"]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = (text or "").encode()
            if len(data) >= width:
                found = regions(data, width)
                cols[0] += [row] * len(found)
                for c, v in zip(cols[1:], zip(*found, strict=True), strict=True):
                    c += v
            if len(cols[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)
                cols = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


class _Region:
    """A region's bytes, its prefix hashes, and where its anchor is."""

    __slots__ = ("row", "lo", "at", "data", "h", "alone", "starts")

    def __init__(self, row: int, lo: int, hi: int, at: int, n: int, data: bytes):
        self.row, self.lo, self.at, self.data, self.alone = row, lo, at - lo, data, n == 1
        self.starts = hi - lo + 1
        self.h: list[int] = []

    def hashes(self) -> list[int]:
        if not self.h:
            self.h = prefix_hashes(self.data).tolist()
        return self.h


def _equal(x: _Region, a: int, y: _Region, b: int, n: int, up: list[int]) -> bool:
    """Hashes of x[a:a+n] and y[b:b+n] are equal."""
    hx, hy = x.hashes(), y.hashes()
    return not (((hx[a + n] - hx[a]) * up[b] - (hy[b + n] - hy[b]) * up[a]) & _FULL)


def extension(x: _Region, y: _Region, up: list[int], right: bool) -> int:
    """Bytes that x and y have in common from their anchors to the right, or before them."""
    low, high = 0, min(len(x.data) - x.at, len(y.data) - y.at) if right else min(x.at, y.at)
    while low < high:
        mid = (low + high + 1) // 2
        a, b = (x.at, y.at) if right else (x.at - mid, y.at - mid)
        if _equal(x, a, y, b, mid, up):
            low = mid
        else:
            high = mid - 1
    while low:  # a collision of hashes would show here
        a, b = (x.at, y.at) if right else (x.at - low, y.at - low)
        if x.data[a : a + low] == y.data[b : b + low]:
            break
        low -= 1
    return low


def _order(group: list[_Region], up: list[int], right: bool) -> list[int]:
    """The regions by their suffixes at the anchor, or by what lies before it, read backwards: a mergesort by hashes."""

    def compare(i: int, j: int) -> int:
        x, y = group[i], group[j]
        n = extension(x, y, up, right)
        a, b = (x.at + n, y.at + n) if right else (x.at - n - 1, y.at - n - 1)
        # Past its end a string has nothing, which comes first.
        one, two = x.data[a : a + 1] if a >= 0 else b"", y.data[b : b + 1] if b >= 0 else b""
        return (one > two) - (one < two)

    return sorted(range(len(group)), key=cmp_to_key(compare))


def repeated(group: list[_Region], width: int = WIDTH) -> list[np.ndarray]:
    """For each region, which of its starts begin a string that another region has.

    A start l bytes before the anchor is repeated if another region has l bytes
    before it in common, and width - l from it on.  In the order of suffixes, regions with
    r bytes in common are intervals, which grow as r falls; each keeps its regions
    in the order of what lies before the anchor, where the longest common part is
    that with a neighbour.  The smaller of two intervals that meet is put into the
    larger, so that n regions take some n log n comparisons, however alike they are.
    """
    marks = [np.zeros(r.starts, bool) for r in group]
    most = max(len(r.data) for r in group)
    up = _power(max(4 * width, most + 1))[0].tolist()
    order = _order(group, up, True)
    place = [0] * len(group)
    for n, i in enumerate(_order(group, up, False)):
        place[i] = n
    who = sorted(range(len(group)), key=place.__getitem__)
    shared = [extension(group[i], group[j], up, True) for i, j in zip(order, order[1:], strict=False)]
    # Of each interval, under its first and last member: the places of its regions, sorted.
    held: dict[int, list[int]] = {n: [place[i]] for n, i in enumerate(order)}
    ends = {n: n for n in range(len(order))}
    starts = dict(ends)
    for k in sorted(range(len(shared)), key=lambda k: -shared[k]):
        r, first, last = shared[k], starts[k], ends[k + 1]
        one, two = held.pop(first), held.pop(k + 1)
        small, large = (one, two) if len(one) < len(two) else (two, one)
        for p in small:
            at = bisect(large, p)
            for q in large[max(0, at - 1) : at + 1]:
                x, y = group[who[p]], group[who[q]]
                left = extension(x, y, up, False)
                if left + r >= width:
                    for z, i in ((x, who[p]), (y, who[q])):
                        marks[i][max(0, z.at - left) : max(0, z.at - max(0, width - r) + 1)] = True
            large.insert(at, p)
        held[first] = large
        starts[last], ends[first] = first, last
    return marks


def _starts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row for each string of fetched regions: how far before the anchor it starts, and two hashes of it."""
    names = ["anchor", "before", "code", "check", "_row", "start", "alone"]
    for batch in batches:
        for r in batch.to_pylist():
            data, n = r["data"], r["hi"] - r["lo"] + 1
            h = prefix_hashes(data)
            codes = (h[width : width + n] - h[:n]) * _power(n)[1]
            checks = np.fromiter((xxhash.xxh3_64_intdigest(data[i : i + width]) for i in range(n)), np.uint64, n)
            start = np.arange(r["lo"], r["hi"] + 1)
            cols = [np.full(n, r["anchor"]), r["at"] - start, codes.view(np.int64), checks.view(np.int64), np.full(n, r["_row"]), start, np.full(n, r["n"] == 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


def _counted(fetched: DataFrame, width: int) -> DataFrame:
    """(_row, begin, end) for the strings of ``fetched`` regions that another of its anchor has.

    Strings are equal if they are as far from equal anchors and both their
    hashes are, the polynomial and another.  Equal strings are counted before
    they are shuffled, and what marks them is a join that can be split.
    """
    found = materialize(fetched.mapInArrow(lambda it: _starts(it, width), "anchor long, before long, code long, check long, _row long, start long, alone boolean"), "starts")
    same = ["anchor", "before", "code", "check"]
    shared = found.groupBy(*same).count().where("count > 1").drop("count")
    return found.where("alone").join(shared, same, "left_semi").select("_row", F.col("start").alias("begin"), (F.col("start") + width).alias("end"))


def _sorted_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Marks of groups; rows come sorted by anchor."""
    group: list[_Region] = []
    key, out = None, []

    def close():
        if len(group) > 1 and any(r.alone for r in group):
            for r, m in zip(group, repeated(group, width), strict=True):
                if r.alone and m.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], m.astype(np.int8), [0]])))
                    out.extend((r.row, r.lo + a, r.lo + b - 1 + width) for a, b in edges.reshape(-1, 2).tolist())
        group.clear()

    def flush():
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["_row", "begin", "end"])

    for batch in batches:
        for r in batch.to_pylist():
            if r["anchor"] != key:
                close()
                key = r["anchor"]
            group.append(_Region(r["_row"], r["lo"], r["hi"], r["at"], r["n"], r["data"]))
        yield flush()
    close()
    yield flush()


def repeats(keyed: DataFrame, width: int = WIDTH, together: int = TOGETHER) -> DataFrame:
    """(_row, begin, end): byte ranges covered by strings of ``width`` bytes that start elsewhere too.

    Anchors with over ``together`` different regions are counted, others sorted; the ranges cover the same bytes.
    """
    docs = keyed.select("_row", "text")
    found = materialize(docs.mapInArrow(lambda it: _anchors(it, width), "_row long, anchor long, lo long, hi long, at long, region long"), "anchors")
    same = found.groupBy("anchor", "region").agg(F.count("*").alias("n"), F.min(F.struct("_row", "lo", "hi", "at")).alias("one"))
    several = same.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.min("n").alias("least")).where("total > 1")
    same = materialize(same.join(several, "anchor").select("anchor", "region", "n", "one", "kinds", "least"), "regions")
    release(docs.sparkSession)
    whole = found.join(same.where("n > 1").select("anchor", "region"), ["anchor", "region"], "left_semi")
    whole = whole.select("_row", F.col("lo").alias("begin"), (F.col("hi") + width).alias("end"))
    # One region of each content, where anchors are alike and contents differ.
    wanted = same.where("kinds > 1 and least = 1")
    crowded = F.col("kinds") > together

    def fetch(batches):
        for batch in batches:
            rows = []
            for row, text, want in zip(*(batch.column(c).to_pylist() for c in ("_row", "text", "wanted")), strict=True):
                data = text.encode()
                rows += [(w["anchor"], row, w["n"], w["lo"], w["hi"], w["at"], data[w["lo"] : w["hi"] + width]) for w in want]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], ["anchor", "_row", "n", "lo", "hi", "at", "data"])

    def fetched(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select("anchor", "n", "one.*").groupBy("_row").agg(F.collect_list(F.struct("anchor", "n", "lo", "hi", "at")).alias("wanted"))
        return docs.join(chosen, "_row").select("_row", "text", "wanted").mapInArrow(fetch, "anchor long, _row long, n long, lo long, hi long, at long, data binary")

    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = fetched(wanted.where(~crowded)).repartition(parts, "anchor").sortWithinPartitions("anchor")
    out = whole.union(grouped.mapInArrow(lambda it: _sorted_groups(it, width), "_row long, begin long, end long"))
    return out if wanted.where(crowded).isEmpty() else out.union(_counted(fetched(wanted.where(crowded)), width))


def _word_anchors(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each region of words and text: how many starts follow its first, and all places where the text has it."""
    names = ["_row", "anchor", "region", "more", "lows"]
    for batch in batches:
        cols: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for base, part, s, keys, lo, hi, at in _chosen(word_hashes((text or "").encode()), words, min(words, WORD_GRAM)):
                code = (s[hi + words] - s[lo]) * _power(len(part))[1][lo]
                code = (code ^ (code >> np.uint64(31))) * np.uint64(_BASE) + ((at - lo) * (words + 1) + hi - lo).view(np.uint64) * np.uint64(_INVERSE)
                for c, v in zip(cols, (np.full(len(lo), row), keys, code.view(np.int64), hi - lo, base + lo), strict=True):
                    c.append(v)
        row, anchor, region, more, lo = (np.concatenate(c) for c in cols)
        order = np.lexsort((lo, region, anchor, row))
        row, anchor, region, more, lo = row[order], anchor[order], region[order], more[order], lo[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(row)), bool), (np.diff(row) != 0) | (np.diff(anchor) != 0) | (np.diff(region) != 0)]))
        lows = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(lo, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(row[new]), pa.array(anchor[new]), pa.array(region[new]), pa.array(more[new], pa.int32()), lows], names)


def _word_codes(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each string of ``words`` words in the wanted regions, with a hash of it and the places where it starts."""
    names = ["anchor", "code", "_row", "whole", "starts"]
    for batch in batches:
        cols: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)] + [[np.zeros(0, bool)]]
        for row, text, want in zip(*(batch.column(c).to_pylist() for c in ("_row", "text", "wanted")), strict=True):
            hashes = word_hashes(text.encode())
            for w in want:
                n, lows = w["more"] + 1, np.array(w["lows"])
                h = prefix_hashes(hashes[lows[0] : lows[0] + n - 1 + words])
                codes = (h[words:] - h[:n]) * _power(n)[1]
                found = np.full(n, w["anchor"]), codes.view(np.int64), np.full(n, row), np.full(n, len(lows)), (np.arange(n)[:, None] + lows).ravel(), np.full(n, w["whole"])
                for c, v in zip(cols, found, strict=True):
                    c.append(v)
        anchor, code, row, many, start, whole = (np.concatenate(c) for c in cols)
        starts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(start, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(code), pa.array(row), pa.array(whole), starts], names)


def passages(keyed: DataFrame, words: int = WORDS) -> DataFrame:
    """(_row, begin, end): ranges of words covered by strings of ``words`` words that another row has too, copies included.

    Words are compared, not what is between them.  Regions that several rows
    have are passages as they are.  Where regions at one anchor differ, one of
    each content is fetched and its strings are compared start by start.
    Equal are strings whose 64-bit hashes and whose anchors' are.  A text has
    a row for each of its different regions, however often it repeats them.
    """
    docs = keyed.select("_row", "text")
    found = docs.mapInArrow(lambda it: _word_anchors(it, words), "_row long, anchor long, region long, more int, lows array<int>")
    anchor, region = Window.partitionBy("anchor"), Window.partitionBy("anchor", "region")
    first, last = F.min("_row"), F.max("_row")
    met = found.withColumn("met", first.over(anchor) < last.over(anchor)).where("met")
    met = met.withColumn("first", first.over(region)).withColumn("whole", F.col("first") < last.over(region))
    met = met.withColumn("fetch", F.max(~F.col("whole")).over(anchor) & (F.col("_row") == F.col("first")))
    met = materialize(met.where("whole or fetch").select("_row", "anchor", "more", "lows", "whole", "fetch"), "met")
    release(keyed.sparkSession)
    wanted = met.where("fetch").groupBy("_row").agg(F.collect_list(F.struct("anchor", "more", "lows", "whole")).alias("wanted"))
    strings = docs.join(wanted, "_row").select("_row", "text", "wanted").mapInArrow(lambda it: _word_codes(it, words), "anchor long, code long, _row long, whole boolean, starts array<int>")
    same = Window.partitionBy("code", "anchor")
    shared = strings.withColumn("shared", (first.over(same) < last.over(same)) | F.max("whole").over(same)).where("shared and not whole")
    ranges = met.where("whole").select("_row", F.explode("lows").alias("begin"), "more").union(shared.select("_row", F.explode("starts").alias("begin"), F.lit(0)))
    return ranges.select("_row", F.col("begin").cast("long").alias("begin"), (F.col("begin").cast("long") + F.col("more") + words).alias("end"))


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that do not touch, in order, for any ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def dedup(docs: DataFrame, width: int = WIDTH, together: int = TOGETHER, words: int = WORDS) -> DataFrame:
    """(doc_id, n_bytes, kept, spans, passages) for each row of ``docs``: the bytes left, the ranges removed and passages.

    A null text is empty.  Each byte goes that a string of ``width`` bytes
    covers which also starts elsewhere, in the same text or another; strings
    are those of the input.  Repeated rows lose all their long strings.
    Passages are the ranges, counted in words, of strings of ``words`` words
    that another row has too; nothing is removed for them.
    """
    keyed = keyed_rows(docs.select("doc_id", "text"))
    ranges = repeats(keyed, width, together).withColumn("passage", F.lit(False)).union(passages(keyed, words).withColumn("passage", F.lit(True)))
    ranges = materialize(ranges, "repeats")
    release(docs.sparkSession)
    lists = {"ranges": F.when(~F.col("passage"), F.struct("begin", "end")), "begins": F.when(F.col("passage"), F.col("begin")), "ends": F.when(F.col("passage"), F.col("end"))}
    ranges = ranges.groupBy("_row").agg(*(F.collect_list(c).alias(name) for name, c in lists.items()))

    def cut(batches):
        for batch in batches:
            ids, sizes, kept, spans, passages_ = batch.column("doc_id"), [], [], [], []
            for text, found, begins, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "ranges", "begins", "ends")), strict=True):
                data, at, left = (text or "").encode(), 0, []
                spans.append(merge([(r["begin"], r["end"]) for r in found or ()]))
                passages_.append(merge(list(zip(begins or (), ends or (), strict=True))))
                for a, b in spans[-1]:
                    left.append(data[at:a])
                    at = b
                sizes.append(len(data))
                kept.append(b"".join([*left, data[at:]]))
            pairs = [pa.array([[{"begin": a, "end": b} for a, b in s] for s in x], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))) for x in (spans, passages_)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), *pairs], ["doc_id", "n_bytes", "kept", "spans", "passages"])

    joined = keyed.join(ranges, "_row", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", *lists)
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>, passages array<struct<begin: long, end: long>>")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.length("kept")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.size("passages").cast("long").alias("n_passages"))


def brute_force(texts_: list[str], width: int = WIDTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, by a table of all strings."""
    datas, seen = [t.encode() for t in texts_], {}
    for d in datas:
        for i in range(len(d) - width + 1):
            seen[d[i : i + width]] = seen.get(d[i : i + width], 0) + 1
    out = []
    for d in datas:
        spans = merge([(i, i + width) for i in range(len(d) - width + 1) if seen[d[i : i + width]] > 1])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + d[at:a], b
        kept += d[at:]
        out.append((len(d), len(d) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def brute_force_passages(texts_: list[str], words: int = WORDS) -> list[list[tuple[int, int]]]:
    """Passages of each text, by a table of all strings of ``words`` words."""
    split, seen = [t.encode().split() for t in texts_], {}
    for i, w in enumerate(split):
        for k in range(len(w) - words + 1):
            seen.setdefault(tuple(w[k : k + words]), set()).add(i)
    return [merge([(k, k + words) for k in range(len(w) - words + 1) if len(seen[tuple(w[k : k + words])]) > 1]) for w in split]


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLE_SQL: dict[str, str] = {}
