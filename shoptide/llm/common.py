"""What several operators share: lineage cuts, words and their hashes, components of a graph.

Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]``, which is what ``bytes.split()``
gives for UTF-8. Hashes are 64 bits wide; whatever must not collide uses two of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words whose hash a Python worker remembers; beyond it the memory starts anew.
CACHED_WORDS = 1 << 20
#: Bits of the bitmap that tells which rows may be needed, before they are shuffled.
BITMAP_SLOTS = 1 << 27
#: Bytes of text that are tokenised at once in a Python worker.
CHUNK_BYTES = 1 << 22
#: Nodes of a graph that a task joins at once, about.
TASK_NODES = 1 << 20


def scratch(spark: SparkSession) -> str:
    """A fresh folder that all executors share: below ``spark.checkpoint.dir``, or, where a cluster
    names none, below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: a lost executor costs no recomputation."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession):
    """Steps that run inside hand rows to Python in batches of about ``CHUNK_BYTES``: an executor and its
    workers hold a batch several times."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(CHUNK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bitmap(wanted: DataFrame) -> DataFrame:
    slots = wanted.select((F.pmod(F.col(wanted.columns[0]), F.lit(BITMAP_SLOTS)) + 1).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")
    )


def _with_bits(df: DataFrame, key: str, wanted: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """The rows beside the part of the bitmap their key falls in, and whether its bit is set."""
    slot = F.pmod(F.col(key), F.lit(BITMAP_SLOTS)) + 1
    place = F.bitmap_bit_position(slot)
    byte = F.substring(F.col("_bits"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    bit = F.pow(F.lit(2), F.pmod(place, F.lit(8))).cast("int")
    known = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0
    beside = df.withColumn("_at", F.bitmap_bucket_number(slot)).join(
        F.broadcast(_bitmap(wanted)), F.col("_at") == F.col("_bucket"), how
    )
    return beside, known


def maybe_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose 64-bit ``key`` may be among ``wanted`` (one column of keys), found before a
    shuffle: every task knows a bitmap of ``BITMAP_SLOTS`` bits over the wanted keys, 16 MB at any
    size of the data. No wanted row is missing; rows that share a bit pass too, so a join follows."""
    beside, known = _with_bits(df, key, wanted, "inner")
    return beside.where(known).select(*df.columns)


def split_by_bitmap(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose 64-bit ``key`` is surely not among ``wanted``, and those that ``maybe_among``
    finds. Neither is shuffled; each reads ``df`` once."""
    beside, known = _with_bits(df, key, wanted, "left")
    return beside.where(~F.coalesce(known, F.lit(False))).select(*df.columns), maybe_among(df, key, wanted)


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of the words of a text; empty for null and for blank texts."""
    parts = F.split(F.coalesce(c, F.lit("")), f"{BLANK}+")
    return F.filter(parts, lambda w: w != "")


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembering a bounded number of words."""

    def __init__(self, most: int = CACHED_WORDS):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mix(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Hash of two neighbours; the order counts."""
    m1 = np.uint64((0x9E3779B97F4A7C15 + 2 * seed) & 0xFFFFFFFFFFFFFFFF)
    x = a * m1 + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` words, by doubling: two runs of a power of two that overlap."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    current, width = mix(hashes, hashes, seed + 1), 1
    while width * 2 <= size:
        current = mix(current[:-width], current[width:], seed)
        width *= 2
    if width < size:
        current = mix(current[: len(current) - (size - width)], current[size - width :], seed + 7)
    return current


def word_runs(
    texts: list[bytes], cache: WordHashes, lower: bool = False
) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray]]:
    """Texts in chunks of bounded size: index of the first text, words per text, the hashes of all
    their words in a row, and where each text starts in that row (one more entry at the end).
    ``lower`` reads A-Z in lower case."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK_BYTES):
            size += len(texts[last])
            last += 1
        split = [(t.lower() if lower else t).split() for t in texts[first:last]]
        starts = np.zeros(len(split) + 1, np.int64)
        np.cumsum([len(w) for w in split], out=starts[1:])
        hashes = np.empty(int(starts[-1]), np.uint64)
        for i, w in enumerate(split):
            hashes[starts[i] : starts[i + 1]] = np.fromiter(
                map(cache.__getitem__, w), np.uint64, len(w)
            )
        yield first, split, hashes, starts
        first = last


def text_bytes(column) -> list[bytes]:
    """UTF-8 of an Arrow column of texts; null is empty."""
    return [b"" if t is None else t for t in column.cast("binary").to_pylist()]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges (u, v) one from each node to the smallest that the task's edges join it with, over up to
    ``TASK_NODES`` nodes at once."""
    low: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := low.get(top, top)) != top:
            top = up
        while x != top:
            low[x], x = top, low[x]
        return top

    def out() -> pa.RecordBatch:
        ends = [root(u) for u in low]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int64()), pa.array(ends, pa.int64())], names=["u", "v"]
        )

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                low[max(u, v)] = min(u, v)
        if len(low) >= TASK_NODES:
            yield out()
            low.clear()
    if low:
        yield out()


def stars(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of the edges that is not itself the smallest: columns node,
    component.

    A round takes three steps, and none parts what the edges join. A task joins what its own edges
    join. What a node was joined with in several tasks goes, with it, to the smallest of them. An edge to
    a node that knows a smaller one leads there instead. The end is reached when every node has one
    smaller neighbour, and that one has none. A node with many neighbours is never gathered: a node comes
    once from each task, the rest are grouped minima. Rounds are written by a few tasks per core: their
    rows are two numbers.
    """
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    # Written: a round reads its edges twice, and must see the same.
    current = cut(pairs.where("u is not null and v is not null and u <> v"))
    files = max(32, 4 * edges.sparkSession.sparkContext.defaultParallelism)
    for _ in range(rounds):
        met = current.mapInArrow(_contracted, "u long, v long").groupBy("u").agg(
            F.min("v").alias("m"), F.collect_set("v").alias("met")
        )
        others = F.filter("met", lambda v: v != F.col("m"))
        arcs = met.select(F.explode(F.concat(F.array("u"), others)).alias("u"), F.col("m").alias("v"))
        low = arcs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), "m")
        led = arcs.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        current = cut(led.coalesce(files))
        none = F.lit(None).cast("long")
        ends = current.select(F.col("u").alias("node"), "v").union(current.select("v", none))
        apart = "low <> high or (low is not null and ups < n)"
        unsettled = ends.groupBy("node").agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("ups"), F.count("*").alias("n")
        ).where(apart)
        if not unsettled.count():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()


def components(
    edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60
) -> DataFrame:
    """Smallest node reachable from each node of the edges: columns node, component."""
    found = stars(edges, a, b, rounds)
    roots = found.select(F.col("component").alias("node")).distinct()
    return found.union(roots.select("node", F.col("node").alias("component")))
