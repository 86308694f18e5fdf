"""Shortest-pack-first packing over the length histogram (operator 3).

Documents are tokenised once and cut into whole sequences and a rest.  The
histogram of piece lengths, at most as many numbers as a sequence has tokens,
is packed: lengths are placed longest first, each into the open pattern that is
shortest so far, and patterns carry counts.  Pieces then find their place by
their rank within their length, with one range join against the patterns.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from pathlib import Path
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import give_back, materialize, table, texts

SEQUENCE = 2048
END = 1
#: Chunks whose ids a Python worker remembers, at most: some 5 MB, which it keeps when other tasks run in it.
REMEMBERED = 1 << 17
#: Bytes that are tokenised together, at most, but for one text; a row counts as ``ROW`` bytes more.
TOGETHER, ROW = 4_000_000, 64
#: The id that ends a chunk while it is tokenised, above all of a vocabulary's.
_CHUNK_END = 1 << 31

_known: dict[str, pa.Table] = {}
_encoders: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class _Encoder:
    """Ids of blank-separated chunks, as the tokenizer file defines them.

    Chunks of Latin letters and signs, nearly all, go through the file's merges
    in tiktoken, all in one call; all others, and chunks that may hold a special
    token, go to the tokenizer itself.  Tests hold both against it.
    """

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        model = json.loads(Path(path).read_text())
        special = {t["content"] for t in model["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {}
        for token, number in model["model"]["vocab"].items():
            if token not in special:
                word = token.removesuffix("</w>")
                ranks[bytes(map(byte.__getitem__, word)) + b" " * (word != token)] = number
        # Words hold no white space: a blank stands for the end of a word, a line end for that of a chunk.
        ranks[b"\n"] = _CHUNK_END
        self.merge = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        self.words = regex.compile(model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # White space that does not part chunks would look like an end of a word.
        self.odd = r"[^\x00-\x{24f}]|<\||[\s\x0b\x{85}\x{a0}]"

    def __call__(self, chunks: list[str]) -> dict[str, bytes]:
        return dict(zip(chunks, self.ids(pa.array(chunks, pa.large_string())).to_pylist(), strict=True))

    def ids(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of each chunk, as little-endian unsigned 32-bit numbers."""
        odd = pc.match_substring_regex(chunks, self.odd).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._merged(chunks)
        found = [self._merged(chunks.filter(pa.array(~odd)))]
        rest = chunks.filter(pa.array(odd))
        for i in range(0, len(rest), 20_000):
            encoded = self.slow.encode_batch_fast(rest[i : i + 20_000].to_pylist(), add_special_tokens=False)
            found.append(pa.array([np.array(e.ids, "<u4").tobytes() for e in encoded], pa.large_binary()))
        at = np.empty(len(chunks), np.int64)
        at[np.argsort(odd, kind="stable")] = np.arange(len(chunks))
        return pa.concat_arrays(found).take(pa.array(at))

    def _merged(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        if not len(chunks):
            return pa.array([], pa.large_binary())
        joined = _joined(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), "\n")[0].as_py()
        text = self.words.sub(r"\g<0> ", normalize("NFC", joined + "\n").lower())
        ids = self.merge(text, disallowed_special=()).astype("<u4")
        ends = np.flatnonzero(ids == _CHUNK_END)
        offsets = np.concatenate([[0], 4 * (ends - np.arange(len(ends)))]).astype(np.int64)
        data = ids[ids != _CHUNK_END].tobytes()
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _joined(lists: pa.ListArray, by: str | bytes) -> pa.Array:
    return pc.binary_join(lists, pa.scalar(by, lists.type.value_type))


def encode(texts_: list[str] | pa.LargeStringArray, path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers, without an end.

    The tokenizer drops white space and never joins what it separates, so the
    ids of a text are those of its blank-separated chunks in a row, and each
    distinct chunk is tokenised once.  Chunks stay in Arrow throughout; there is
    no Python object for each of them.
    """
    if path not in _encoders:
        _encoders[path], _known[path] = _Encoder(path), pa.table({"chunk": pa.array([], pa.large_string()), "ids": pa.array([], pa.large_binary())})
    known = _known[path]
    split = pc.ascii_split_whitespace(texts_ if isinstance(texts_, pa.Array) else pa.array(texts_, pa.large_string()))
    chunks = split.flatten().dictionary_encode()
    use = chunks.indices.to_numpy()
    at = pc.index_in(chunks.dictionary, value_set=known["chunk"]).fill_null(-1).to_numpy().astype(np.int64)
    new = at < 0
    found = pa.table({"chunk": chunks.dictionary.filter(pa.array(new))})
    found = found.append_column("ids", _encoders[path].ids(found["chunk"].combine_chunks()))
    at[new] = len(known) + np.arange(len(found))
    ids = pa.concat_arrays([*known["ids"].chunks, *found["ids"].chunks]).take(pa.array(at[use]))
    if len(known) < REMEMBERED:
        # Most chunks that come once among these never come again.
        often = found.filter(pa.array(np.bincount(use, minlength=len(at))[new] > 1))
        _known[path] = pa.concat_tables([known, often[: REMEMBERED - len(known)]]).combine_chunks()
    return _joined(pa.ListArray.from_arrays(split.offsets, ids), b"").to_pylist()


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of ``TOGETHER`` bytes, at most, but for one text."""
    held, size = [], 0
    for batch in batches:
        begin = 0
        for at, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            if size and size + n + ROW > TOGETHER:
                yield pa.Table.from_batches([*held, batch[begin:at]])
                held, size, begin = [], 0, at
            size += n + ROW
        held.append(batch[begin:])
    if size:
        yield pa.Table.from_batches(held)


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int, end: int) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
    last = np.array([end], "<u4").tobytes()
    for table_ in _together(batches):
        text = table_["text"].cast(pa.large_string()).combine_chunks()
        rows = []
        for doc, data in zip(table_["doc_id"].to_pylist(), encode(text, path), strict=True):
            data += last
            n = len(data) // 4
            for at in range(0, n, size):
                piece = data[at * 4 : (at + size) * 4]
                length = len(piece) // 4
                rows.append((doc, at, length, zlib.crc32(piece), n, part, int(seen[length])))
                seen[length] += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "seen"])
        del table_, text, rows
    give_back()  # the worker stays, for other tasks


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """(count, lengths) of each packing pattern, for ``histogram`` of length to pieces."""
    open_: list[list] = [[] for _ in range(size + 1)]  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []
        room = size
        while left and room >= length:
            if not open_[room]:
                room -= 1
                continue
            count, lengths = open_[room].pop()
            took = min(count, left)
            left -= took
            if took < count:
                open_[room].append((count - took, lengths))
            placed.append((room - length, (took, [*lengths, length])))
        # The rest opens patterns, each with as many of this length as fit.
        per = size // length
        if left >= per:
            placed.append((size - per * length, (left // per, [length] * per)))
        if left % per:
            placed.append((size - left % per * length, (1, [length] * (left % per))))
        for room, pattern in placed:
            open_[room].append(pattern)
    return [p for at in open_ for p in at]


def places(found: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first, offset) of each pattern's slots."""
    out, sequence, used = [], 0, {}
    for count, lengths in found:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            out.append((length, rank, rank + count, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end: int = END) -> DataFrame:
    """A row for each piece of each row of ``docs``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty and has only the end id.  Rows are packed as they
    come: repeated rows are packed each.  An empty table gives no row.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, seen long"
    pieces = materialize(texts(docs).mapInArrow(lambda it: _cut(it, path, size, end), fields), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = dict(pieces.groupBy("length").count().collect())  # at most ``size`` rows
    slots = spark.createDataFrame(places(patterns(histogram, size)), "length long, low long, high long, sequence long, offset long")
    ranked = pieces.join(counts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("seen"))
    # The slots depend on the histogram's lengths only, not on the documents.
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= low and rank < high")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op3_packing": op3_packing}
ORACLE_SQL: dict[str, str] = {}
