"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits: language and source by hash, size by its logarithm. A
cell of that grid has one place on the Hilbert curve, taken from a table of all cells (4,096 longs,
computed from the rule of the curve on the driver). Rows are put in the order of the curve, and the
order is cut into runs whose counts differ by one at most (law ``rows``). Neighbours on the curve are
neighbours in every dimension, so a shard spans few values of each and a filter on any dimension
skips shards by their ranges.

The order is found without sorting all rows in one place: rows are counted per cell, a cell with many
rows is split into runs of about ``RUN_ROWS`` by a hash of its ids, runs are counted, and a row's
rank is its cell's first rank, plus its run's, plus its place in the run. Only the cells (a number
fixed by the grid) are summed in one task and broadcast; the largest group any task orders is a run.

Defined cases: a null text has size 1 and crc32 0 as an empty one; null language and source hash like
a value of their own. Rows that tie in everything get adjacent slots in either order. Fewer rows than
shards leave shards empty. An empty table gives no rows. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptide.llm.common import cut

SHARDS = 8
BITS = 4
DIMENSIONS = ("lang", "source", "size")
#: Rows that are ordered together within a cell, about.
RUN_ROWS = 50_000


def hilbert_index(point: tuple[int, ...], bits: int = BITS) -> int:
    """Place of a grid cell on the Hilbert curve: from the highest bit down, undo the turn and the
    exchange of axes that each sub-cube has, then read the Gray code of the interleaved bits."""
    x = list(point)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            if x[i] & bit:
                x[0] ^= below
            else:
                swap = (x[0] ^ x[i]) & below
                x[0] ^= swap
                x[i] ^= swap
    index, parity = 0, 0
    for level in range(bits - 1, -1, -1):
        for value in x:
            parity ^= value >> level & 1
            index = index << 1 | parity
    return index


def curve(bits: int = BITS, dimensions: int = len(DIMENSIONS)) -> list[int]:
    """Place on the curve of every cell, cells numbered with the first dimension highest."""
    side = 1 << bits
    cells = range(side**dimensions)
    return [
        hilbert_index(tuple(c // side**d % side for d in range(dimensions - 1, -1, -1)), bits)
        for c in cells
    ]


def quantised() -> dict[str, Column]:
    """Grid coordinate of each dimension."""
    side = 1 << BITS
    by_hash = lambda c: F.pmod(F.xxhash64(c), F.lit(side)).cast("int")
    size = F.floor(F.log2(F.col("size"))).cast("int") - 2
    return {
        "q_lang": by_hash("lang"),
        "q_source": by_hash("source"),
        "q_size": F.greatest(F.lit(0), F.least(F.lit(side - 1), size)),
    }


def measured(docs: DataFrame) -> DataFrame:
    """The keys of every row: doc_id, size, text_crc32, grid coordinates, curve."""
    column = lambda c: F.col(c) if c in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        column("lang").alias("lang"),
        column("source").alias("source"),
    ).withColumns(quantised())
    side = 1 << BITS
    cell = (F.col("q_lang") * side + F.col("q_source")) * side + F.col("q_size")
    places = F.array(*[F.lit(i) for i in curve()])
    return rows.withColumn("curve", F.get(places, cell))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row's keys with shard (0 to shards - 1) and slot (its place in the shard)."""
    rows = cut(measured(docs))
    cells = rows.groupBy("curve").agg(F.count("*").alias("n"))
    # As many rows as the grid has cells, at most.
    before = W.orderBy("curve").rowsBetween(W.unboundedPreceding, -1)
    starts = cut(
        cells.select(
            "curve",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"),
            F.ceil(F.col("n") / RUN_ROWS).alias("runs"),
            "n",
        )
    )
    total = starts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    split = rows.join(F.broadcast(starts.drop("n")), "curve").withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("runs"))
    )
    runs = split.groupBy("curve", "run").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("curve").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(
        "curve", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("run_start")
    )
    place = F.row_number().over(
        W.partitionBy("curve", "run").orderBy("doc_id", "text_crc32", "size")
    )
    ranked = split.withColumn("place", place).join(runs, ["curve", "run"])
    rank = (F.col("cell_start") + F.col("run_start") + F.col("place") - 1).alias("rank")
    ranked = ranked.select(
        "doc_id", "size", "text_crc32", "lang", "source", *quantised(), "curve", rank
    )
    shard = F.expr(f"(rank * {shards}) div {max(1, total)}")
    ranked = ranked.withColumn("shard", shard)
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ranked.withColumn("slot", F.col("rank") - first).withColumn(
        "shard", F.col("shard").cast("int")
    )


def shard_ranges(sharded: DataFrame) -> DataFrame:
    """What a reader skips shards by: rows, bytes, and the range of every grid coordinate."""
    ranges = [f(c).alias(f"{n}_{c}") for c in quantised() for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ranges
    )


def shard_digests(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
