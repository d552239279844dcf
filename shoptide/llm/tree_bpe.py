"""Byte-level BPE by tree reduction.

A piece (one match of the splitting pattern) is cut in halves down to short leaves. Leaves are merged
directly; two encoded neighbours are joined by re-encoding a window around their boundary, which
grows on a side until the tokens outside it cannot change: a sequence of tokens is the encoding of
its bytes exactly when each two adjacent tokens are the encoding of their own bytes, so it is enough
that the window's first and last token stand this test against the tokens next to them. Decoding
concatenates halves up the same tree.

Ranks are read on the driver (a vocabulary has a fixed size, checked against ``MAX_RANK_BYTES``) and
sent with the tasks; texts stay in their partitions, so there is no shuffle, and a lost task is just
run again. Nulls and empty texts have no tokens. Repeated rows and any other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a piece that are merged without halving.
LEAF_BYTES = 32
#: Pieces, and pairs of tokens, that a worker remembers.
CACHED = 1 << 18
#: Longest rank file that is sent to the tasks.
MAX_RANK_BYTES = 64 << 20
#: UTF-8 bytes of text encoded before a worker hands rows back.
CHUNK_BYTES = 1 << 22


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token to rank from lines of base64 and decimal."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class TreeBpe:
    """Encoder and decoder of single pieces, and of texts by a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.stable: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) <= LEAF_BYTES:
            pairs = [ranks.get(a + b, 1 << 62) for a, b in zip(parts, parts[1:])]
            while pairs and (low := min(pairs)) != 1 << 62:
                at = pairs.index(low)
                joined = parts[at] + parts.pop(at + 1)
                parts[at] = joined
                # Only the pairs on both sides of what was joined are new.
                del pairs[at]
                if at:
                    pairs[at - 1] = ranks.get(parts[at - 1] + joined, 1 << 62)
                if at < len(pairs):
                    pairs[at] = ranks.get(joined + parts[at + 1], 1 << 62)
            return [ranks[p] for p in parts]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (rank := ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if len(parts[i]) != left or j >= len(parts) or len(parts[j]) != right:
                continue
            parts[i] += parts[j]
            parts[j] = b""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[p] for p in parts if p]

    def stands(self, a: int, b: int) -> bool:
        """Are two adjacent tokens the encoding of their own bytes?"""
        answer = self.stable.get((a, b))
        if answer is None:
            if len(self.stable) >= CACHED:
                self.stable.clear()
            answer = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            self.stable[a, b] = answer
        return answer

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours from theirs."""
        if not left or not right or self.stands(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(self.decode_ids(left[-i:]) + self.decode_ids(right[:j]))
            left_ok = i >= len(left) or self.stands(left[-i - 1], window[0])
            right_ok = j >= len(right) or self.stands(window[-1], right[j])
            if left_ok and right_ok:
                return left[: len(left) - i] + window + right[j:]
            i = i if left_ok else min(len(left), 2 * i)
            j = j if right_ok else min(len(right), 2 * j)

    def reduce(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def encode_piece(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            ids = [whole] if whole is not None else self.reduce(data)
            if len(piece) <= 64:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, encode = self.known, self.encode_piece
        for piece in self.find(text):
            ids = known.get(piece)
            out += encode(piece) if ids is None else ids
        return out

    def decode_ids(self, ids: list[int]) -> bytes:
        """Concatenate halves up the tree; short runs at once."""
        if len(ids) <= 1 << 16:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode_ids(ids[:half]) + self.decode_ids(ids[half:])


_CODECS: dict[tuple[int, str], TreeBpe] = {}


def codec(raw: bytes, pattern: str) -> TreeBpe:
    """The worker's codec for a vocabulary, built once per process."""
    key = (hash(raw), pattern)
    if key not in _CODECS:
        _CODECS[key] = TreeBpe(parse_ranks(raw), pattern)
    return _CODECS[key]


def read_ranks(path: str) -> bytes:
    raw = Path(path).read_bytes()
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError(f"{path}: {len(raw)} bytes of ranks, {MAX_RANK_BYTES} at most are sent")
    return raw


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _arrow_schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """The frame with the token ids of ``text``, an array of ints; a column of that name is replaced."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    schema = _arrow_schema(df, ids, T.ArrayType(T.IntegerType(), False))

    def run(batches):
        bpe = codec(raw.value, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            kept = [i for i, n in enumerate(batch.schema.names) if n != ids]
            sizes = column.cast("string").to_pandas().str.len().fillna(0).astype(int).tolist()
            for first, last in _slices(sizes, CHUNK_BYTES):
                part = column.slice(first, last - first).to_pylist()
                lists = [np.array(bpe.encode(t or ""), np.int32) for t in part]
                ends = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) for x in lists], out=ends[1:])
                values = pa.array(np.concatenate(lists), pa.int32())
                rows = [batch.column(i).slice(first, last - first) for i in kept]
                names = [batch.schema.names[i] for i in kept]
                yield pa.RecordBatch.from_arrays(
                    [*rows, pa.ListArray.from_arrays(pa.array(ends), values)], [*names, ids]
                )

    return df.mapInArrow(run, schema)


def decode(
    df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """The frame with the bytes of its token ids; bytes, as ids cut anywhere need not be UTF-8."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    schema = _arrow_schema(df, out, T.BinaryType())

    def run(batches):
        bpe = codec(raw.value, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            kept = [i for i, n in enumerate(batch.schema.names) if n != out]
            sizes = [len(x) if x.is_valid else 0 for x in column]
            for first, last in _slices(sizes, CHUNK_BYTES):
                part = column.slice(first, last - first)
                data = [bpe.decode_ids((x.values.to_numpy().tolist()) if x.is_valid else []) for x in part]
                rows = [batch.column(i).slice(first, last - first) for i in kept]
                names = [batch.schema.names[i] for i in kept]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(data, pa.binary())], [*names, out])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode ``text``, decode the ids, and reduce both to digests, one row per row."""
    both = decode(encode(df.select("doc_id", "text"), path, pattern).drop("text"), path, pattern)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
