"""N-gram Jaccard join over count vectors in R-trees.

A document is the set of its distinct shingles (five words, A-Z lower-cased; fewer words are one
shingle). Its shingles are hashed into ``GROUPS`` groups, and the counts per group are its point. Two
sets share at most the sum of the smaller count of every group, so a tree node, whose box bounds the
counts of the points below it, can be left when even that sum is too small for the threshold. Pairs
that survive are verified on their full sets. Nothing is lost: the bound never falls below the truth.

In that many dimensions boxes of unrelated documents overlap, and one tree over the corpus would be
searched almost whole by every query (README). So points are dealt to trees by a rule that loses
nothing either: two sets of Jaccard ``t`` must share one of their first ``n - ceil(t n) + 1`` shingles
in any order common to all documents. The order puts shingles that many documents hold last (their
counts come from a sketch of fixed size over all documents; it steers the work, not the result), then
goes by hash. All documents that have a shingle among their first form a bucket. Buckets with the
same least member are one, or, where that is too much for a tile, those with the same members.

Of a bucket only members stay that some other member's size allows: where the shingle of the bucket is
the first that two sets share, those before it in either order are not shared.

Only who is reachable matters, so no bucket is expanded into pairs. A task carries the 16-bit prints of
its members' shingles: the share of one set's prints found in another bounds the overlap far closer
than counts do; only members that the tree of counts leaves a partner get them. Long sets are
counted in more groups, about ``GROUP_SHINGLES`` shingles each: coarse counts of two long sets are alike
whatever they hold. Counts in fewer groups are sums of those in more, so points of any two sets compare.
Members that the tree finds and the prints confirm are joined in a forest that the task keeps over all its buckets, and only edges that join two trees are handed on, fewer than it has
members. Those edges are verified on the full sets. A second round repeats, on full sets, the buckets
where a join by prints was refuted, and buckets of more than one tile that hold several components:
there members outside the largest component, the strays, are dealt to blocks and meet every tile once,
again by their counts first: full sets follow only where a stray may reach another component.
After it no bucket holds a linked pair outside one component. Tiles and blocks are bounded in members
(``TILE_ROWS``) and in shingles (``TILE_SHINGLES``).

Defined cases: equal sets are one class from the start. Null, empty and blank texts have no shingle
and link with nothing. Rows that share a doc_id each have their own set; the id joins them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.common import (
    WordHashes,
    components,
    cut,
    maybe_among,
    small_batches,
    stars,
    text_bytes,
    window_hashes,
    word_runs,
)

SHINGLE_WORDS = 5
#: Jaccard similarity in hundredths from which two documents link.
THRESHOLD = 80
#: Groups of shingles: the dimensions of a point.
GROUPS = 64
#: Shingles of a group, at most about, in the points of long sets.
GROUP_SHINGLES = 4
#: Words whose hash a task remembers: frequent words come soon, the others are one in ten.
TASK_WORDS = 1 << 17
#: Slots of the sketch of shingle counts; a slot is heavy from this many deviations above the mean.
SLOTS, SLICES, HEAVY_DEVIATIONS, HEAVY_LEAST = 1 << 20, 64, 12, 64
#: Members of a bucket that one tree holds, about, and their shingles.
TILE_ROWS, TILE_SHINGLES = 4096, 1 << 22
#: Points of a leaf of the tree.
LEAF = 16
#: Candidates of a member that are tested at once, to begin with.
FIRST_TESTS = 8
#: Members whose trees a task remembers; beyond it the forest starts anew.
FOREST_ROWS = 1 << 20

FIRST_PASS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("slice", T.IntegerType()),
        T.StructField("counts", T.BinaryType()),
    ]
)
SECOND_PASS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("first", T.ArrayType(T.LongType())),
        T.StructField("point", T.BinaryType()),
        T.StructField("prints", T.BinaryType()),
    ]
)
SETS = "cid long, shingles binary"
EDGES = "a long, b long"
CELLS = "bucket long, tile int, block int, cid long, comp long, ask boolean"


def shingle_sets(texts: list[bytes], cache: WordHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of every text, in chunks of bounded size."""
    for first, split, hashes, starts in word_runs(texts, cache, lower=True):
        windows = window_hashes(hashes, SHINGLE_WORDS, 5)
        sets = []
        for i in range(len(split)):
            a, b = starts[i], starts[i + 1]
            if b - a >= SHINGLE_WORDS:
                sets.append(np.unique(windows[a : b - SHINGLE_WORDS + 1]))
            elif b > a:
                sets.append(window_hashes(hashes[a:b], int(b - a), 11))
            else:
                sets.append(np.empty(0, np.uint64))
        yield first, sets


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end of the task its counts of shingles per slot, by slices."""
    cache, counts = WordHashes(TASK_WORDS), np.zeros(SLOTS, np.uint32)
    for batch in batches:
        for first, sets in shingle_sets(text_bytes(batch.column(2)), cache):
            every = np.concatenate(sets)
            if len(every):
                counts += np.bincount(slots(every), minlength=SLOTS).astype(np.uint32)
            digest = np.frombuffer(
                b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8"
            ).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(sets)),
                    batch.column(1).slice(first, len(sets)),
                    pa.array(np.ascontiguousarray(digest[:, 0])),
                    pa.array(np.ascontiguousarray(digest[:, 1])),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                names=FIRST_PASS.names,
            )
    parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SLICES)]
    yield pa.RecordBatch.from_arrays(
        [
            *(pa.nulls(SLICES, pa.int64()) for _ in range(4)),
            pa.nulls(SLICES, pa.int32()),
            pa.array(range(SLICES), pa.int32()),
            pa.array(parts, pa.binary()),
        ],
        names=FIRST_PASS.names,
    )


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sums.setdefault(part, np.zeros(SLOTS // SLICES, np.uint64))
            own += np.frombuffer(zlib.decompress(counts), np.uint32)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([zlib.compress(c.tobytes(), 1) for c in sums.values()], pa.binary()),
        ],
        names=["slice", "counts"],
    )


def heavy_slots(first: DataFrame) -> np.ndarray:
    """Bits of the slots that many documents hit; a fixed number of slots comes to the driver."""
    parts = first.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    sums = parts.mapInArrow(_sum_counts, "slice int, counts binary").collect()
    counts = np.zeros(SLOTS, np.uint64)
    size = SLOTS // SLICES
    for part, packed in sums:
        counts[part * size : (part + 1) * size] += np.frombuffer(zlib.decompress(packed), np.uint64)
    mean = float(counts.mean())
    return np.packbits(counts > mean + max(HEAVY_LEAST, HEAVY_DEVIATIONS * mean**0.5))


def point_of(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts of shingles, or of their prints, per group; ``groups`` is a power of two."""
    return np.bincount((hashes & hashes.dtype.type(groups - 1)).astype(np.int64), minlength=groups)


def fine_point(hashes: np.ndarray) -> bytes:
    """Counts in as many groups as the set is long; the first byte is the width of a count."""
    groups = GROUPS
    while groups * GROUP_SHINGLES < len(hashes):
        groups *= 2
    point = point_of(hashes, groups)
    width = next(w for w in (1, 2, 4) if point.max() < 1 << 8 * w)
    return bytes([width]) + point.astype(f"<u{width}").tobytes()


def unpack_point(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1)


def fold(point: np.ndarray, groups: int) -> np.ndarray:
    """The counts in fewer groups."""
    return point if len(point) == groups else point.reshape(-1, groups).sum(0, dtype=np.int64)


def _second_pass(heavy: bytes):
    bits = np.unpackbits(np.frombuffer(heavy, np.uint8)).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes(TASK_WORDS)
        for batch in batches:
            for first, sets in shingle_sets(text_bytes(batch.column(2)), cache):
                heads, points, prints = [], [], []
                for s in sets:
                    want = len(s) - (THRESHOLD * len(s) + 99) // 100 + 1 if len(s) else 0
                    late = bits[slots(s)]
                    order = s[~late]
                    if len(order) < want:
                        order = np.concatenate([order, s[late]])
                    heads.append((order[:want] >> np.uint64(16)).astype(np.int64))
                    points.append(fine_point(s))
                    prints.append(s.astype("<u2").tobytes())
                ends = np.zeros(len(sets) + 1, np.int32)
                np.cumsum([len(h) for h in heads], out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        batch.column(1).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(heads))),
                        pa.array(points, pa.binary()),
                        pa.array(prints, pa.binary()),
                    ],
                    names=SECOND_PASS.names,
                )

    return run


class RTree:
    """Points packed by size into leaves, leaves into one level of nodes; boxes as upper corners."""

    def __init__(self, points: np.ndarray):
        self.sizes = points.sum(1)
        self.order = np.argsort(self.sizes, kind="stable")
        self.points = points[self.order]
        self.count = len(points)
        starts = np.arange(0, self.count, LEAF)
        self.upper = np.maximum.reduceat(self.points, starts)
        sizes = self.sizes[self.order]
        self.low = sizes[starts]
        self.high = sizes[np.minimum(starts + LEAF, self.count) - 1]
        self.ordered_sizes = sizes

    def within(self, point: np.ndarray) -> np.ndarray:
        """Indices of the points whose Jaccard similarity with ``point`` can reach the threshold."""
        size = int(point.sum())
        leaves = np.flatnonzero(
            (100 * self.high >= THRESHOLD * size) & (100 * size >= THRESHOLD * self.low)
        )
        if not len(leaves):
            return leaves
        # shared >= t (a + b - shared) for the smallest b of the leaf
        shared = np.minimum(self.upper[leaves], point).sum(1)
        least = np.maximum(self.low[leaves], (THRESHOLD * size + 99) // 100)
        leaves = leaves[(100 + THRESHOLD) * shared >= THRESHOLD * (size + least)]
        if not len(leaves):
            return leaves
        rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < self.count]
        shared = np.minimum(self.points[rows], point).sum(1)
        rows = rows[(100 + THRESHOLD) * shared >= THRESHOLD * (size + self.ordered_sizes[rows])]
        return self.order[rows]


class Forest:
    """Which numbers a task has joined so far."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (up := self.parent.get(top, top)) != top:
            top = up
        while x != top:
            self.parent[x], x = top, self.parent[x]
        return top

    def join(self, a: int, b: int) -> None:
        if len(self.parent) >= FOREST_ROWS:
            self.parent.clear()
        self.parent[max(a, b)] = min(a, b)


def shared_prints(own: np.ndarray, others: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Per other set how many of its shingles have a print that ``own`` has too."""
    starts = np.cumsum([0] + [len(o) for o in others[:-1]])
    table[own] = 1
    shared = np.add.reduceat(table[np.concatenate(others)], starts, dtype=np.int64)
    table[own] = 0
    return np.minimum(shared, len(own))


def shared_shingles(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Per other set how many shingles it shares with ``own``; both are sorted."""
    starts = np.cumsum([0] + [len(o) for o in others[:-1]])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, every), len(own) - 1)
    return np.add.reduceat(own[at] == every, starts, dtype=np.int64)


def search_cell(cids, comps, sets, asks, forest: Forest, shared) -> list[tuple[int, int]]:
    """Edges that join what ``forest`` holds apart: each member that asks meets the others of the cell,
    the likeliest first, and leaves out those it has come to be joined with."""
    labels = np.array([forest.root(c) for c in comps.tolist()], np.int64)
    if (labels == labels[0]).all():
        return []
    points = np.array([point_of(s) for s in sets])
    sizes = points.sum(1)
    tree = RTree(points) if len(cids) > LEAF else None
    edges = []
    for i in np.flatnonzero(asks):
        if tree is None:
            near = np.arange(len(cids))
        else:
            near = tree.within(points[i])
        # Of members that both ask, the later one does.
        near = near[(labels[near] != labels[i]) & ((near < i) | ~asks[near])]
        bound = np.minimum(points[near], points[i]).sum(1)
        may = (100 + THRESHOLD) * bound >= THRESHOLD * (sizes[near] + sizes[i])
        near = near[may][np.argsort(-bound[may] / (sizes[near[may]] + sizes[i]), kind="stable")]
        tests = FIRST_TESTS
        while len(near):
            batch, near = near[:tests], near[tests:]
            both = shared(sets[i], [sets[j] for j in batch])
            for j in batch[(100 + THRESHOLD) * both >= THRESHOLD * (sizes[batch] + sizes[i])]:
                if labels[i] != labels[j]:
                    edges.append((int(min(cids[i], cids[j])), int(max(cids[i], cids[j]))))
                    forest.join(int(labels[i]), int(labels[j]))
                    low, high = sorted((labels[i], labels[j]))
                    labels[labels == high] = low
            near = near[labels[near] != labels[i]]
            tests *= 2
        if (labels == labels[0]).all():
            break
    return edges


def reaching(comps: np.ndarray, asks: np.ndarray, fine: list[np.ndarray]) -> np.ndarray:
    """Indices of the members whose counts let them reach a member of another component, where one of
    the two asks."""
    points = np.array([fold(p, GROUPS) for p in fine], np.int64)
    sizes = points.sum(1)
    tree = RTree(points) if len(points) > 2 * LEAF else None
    known = np.zeros(len(points), bool)

    def within(i: int, others: np.ndarray) -> np.ndarray:
        hits = []
        # Of two points the finer one is folded.
        widths = np.array([min(len(fine[i]), len(fine[j])) for j in others])
        for groups in np.unique(widths):
            part, own = others[widths == groups], fold(fine[i], groups)
            bound = np.minimum(np.array([fold(fine[j], groups) for j in part]), own).sum(1, dtype=np.int64)
            hits.append(part[(100 + THRESHOLD) * bound >= THRESHOLD * (sizes[part] + sizes[i])])
        return np.concatenate(hits)

    for i in np.flatnonzero(asks):
        near = np.arange(len(points)) if tree is None else tree.within(points[i])
        near = near[comps[near] != comps[i]]
        # Those that do not ask are found by those that do; of the others one hit is enough.
        silent = ~asks[near] & ~known[near]
        rounds, rest, tests = [near[silent]], near[~silent], FIRST_TESTS
        while len(rest):
            rounds.append(rest[:tests])
            rest, tests = rest[tests:], tests * 2
        for at, others in enumerate(rounds):
            if at and known[i]:
                break
            if len(others):
                hits = within(i, others)
                known[hits] = True
                known[i] |= len(hits) > 0
    return np.flatnonzero(known)


def _reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket, tile and block (these, cid, comp, ask, point) those that ``reaching``
    finds in their cell, without the point."""

    def reached(cell: dict) -> list[tuple]:
        if len(cell) < 2:
            return []
        rows = list(cell.values())
        comps, asks = np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], bool)
        return [rows[i][:6] for i in reaching(comps, asks, [unpack_point(r[6]) for r in rows])]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            names=["bucket", "tile", "block", "cid", "comp", "ask"],
        )

    key, cell = None, {}
    for batch in batches:
        kept = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != key:
                kept += reached(cell)
                key, cell = row[:3], {}
            before = cell.get(row[3])
            cell[row[3]] = (*row[:5], row[5] or bool(before and before[5]), row[6])
        if kept:
            yield out(kept)
    kept = reached(cell)
    if kept:
        yield out(kept)


def _search(exact: bool):
    """Over rows sorted by bucket, tile and block: these, cid, comp, ask, and shingles or their prints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, table = Forest(), np.zeros(1 << 16, np.uint8)
        shared = shared_shingles if exact else lambda own, others: shared_prints(own, others, table)
        dtype = np.dtype("<u8" if exact else "<u2")

        def edges_of(cell: dict) -> list[tuple[int, int]]:
            if len(cell) < 2:
                return []
            cids = sorted(cell)
            return search_cell(
                np.array(cids, np.int64),
                np.array([cell[c][0] for c in cids], np.int64),
                [np.frombuffer(cell[c][2], dtype) for c in cids],
                np.array([cell[c][1] for c in cids], bool),
                forest, shared,
            )

        def out(edges):
            a, b = zip(*edges)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        key, cell = None, {}
        for batch in batches:
            edges = []
            for *place, cid, comp, ask, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    edges += edges_of(cell)
                    key, cell = place, {}
                before = cell.get(cid)
                cell[cid] = (comp, ask or bool(before and before[1]), shingles)
            if edges:
                yield out(edges)
        edges = edges_of(cell)
        if edges:
            yield out(edges)

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes(TASK_WORDS)
    for batch in batches:
        for first, sets in shingle_sets(text_bytes(batch.column(1)), cache):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(sets)),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["cid", "shingles"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges beside the texts of their ends (a, b, x, y) those whose full sets reach the threshold."""
    cache = WordHashes(TASK_WORDS)
    for batch in batches:
        kept = []
        for i, both in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = (s for _, sets in shingle_sets([t.as_buffer().to_pybytes() for t in both], cache) for s in sets)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * shared >= THRESHOLD * (len(x) + len(y) - shared):
                kept.append(i)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int32()))


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles and component (a number that linked rows share; null for rows
    without shingles)."""
    with small_batches(docs.sparkSession):
        return _classes(docs)


def _classes(docs: DataFrame) -> DataFrame:
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, "text")
    first = cut(keyed.mapInArrow(_first_pass, FIRST_PASS))
    rows = first.where("slice is null").select("doc_id", "text_key", "d1", "d2", "n")
    source = F.struct("doc_id", "text_key")
    own = rows.where("n > 0").groupBy("d1", "d2").agg(F.min(source).alias("source"))
    own = cut(
        own.select("d1", "d2", F.col("source.doc_id").alias("_doc"), F.col("source.text_key").alias("_key"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))

    # First shingles and points of one row per set; the join tells apart what a bitmap lets through.
    heavy = heavy_slots(first).tobytes()
    chosen = maybe_among(keyed, "text_key", own.select("_key"))
    heads = chosen.mapInArrow(_second_pass(heavy), SECOND_PASS)
    heads = cut(heads.withColumn("cid", F.monotonically_increasing_id()))
    named = heads.select("cid", "doc_id", "text_key").join(own, same)
    own = cut(
        named.groupBy("d1", "d2", "_doc", "_key").agg(F.min("cid").alias("cid"))
    )
    members = _members(heads, own)
    # Few members have a partner: only their prints are shuffled.
    marked = heads.select("cid", "prints", F.xxhash64("cid").alias("mark"))
    prints = maybe_among(marked, "mark", members.select(F.xxhash64("cid"))).select("cid", "prints")
    found = cut(_cells(_every_asks(members), prints).mapInArrow(_search(False), EDGES).distinct())
    links = reached = None
    if not found.isEmpty():
        texts = _texts_of(found.select(F.col("a").alias("cid")).union(found.select("b")).distinct(), keyed, own)
        side = lambda name, to: texts.select(F.col("cid").alias(name), F.col("text").alias(to))
        beside = found.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
        links = cut(beside.mapInArrow(_verify, EDGES))
        reached = _placed(links)
    left = cut(_open_buckets(members, found, links, reached))
    if not left.isEmpty():
        met = cut(_cells(_second_cells(left), heads.select("cid", "point")).mapInArrow(_reaching, CELLS))
        sets = _texts_of(met.select("cid").distinct(), keyed, own).mapInArrow(_sets, SETS)
        more = cut(_cells(met, sets).mapInArrow(_search(True), EDGES).distinct())
        reached = _joined_by(more, reached)

    named = own.select("d1", "d2", "cid")
    if reached is not None:
        named = named.join(reached, "cid", "left")
        named = named.select("d1", "d2", F.coalesce("component", "cid").alias("component"))
    else:
        named = named.withColumnRenamed("cid", "component")
    return rows.join(named, ["d1", "d2"], "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "component"
    )


def _placed(links: DataFrame) -> DataFrame:
    """cid and component of the members that are not the least of theirs."""
    return stars(links).select(F.col("node").alias("cid"), "component")


def _across(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """The edges between the components of their ends, without those inside one."""
    side = lambda end: reached.select(F.col("cid").alias(end), F.col("component").alias(f"_{end}"))
    beside = edges.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return beside.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b")


def _joined_by(links: DataFrame, reached: DataFrame | None) -> DataFrame:
    """The components when links join some of them: only these are searched anew."""
    if reached is None:
        return _placed(links)
    if links.isEmpty():
        return reached
    tops = _placed(_across(links, reached))
    above = tops.select(F.col("cid").alias("component"), F.col("component").alias("top"))
    moved = reached.join(above, "component", "left").select("cid", F.coalesce("top", "component").alias("component"))
    return moved.union(tops)


def _tiles(rows: str, shingles: str):
    return F.greatest(
        F.ceil(F.col(rows) / TILE_ROWS), F.ceil(F.col(shingles) / TILE_SHINGLES), F.lit(1)
    ).cast("int")


def _members(heads: DataFrame, own: DataFrame) -> DataFrame:
    """bucket, cid, n (shingles) and tiles of the buckets that may hold a pair."""
    dealt = heads.select("cid", "n", F.posexplode("first").alias("at", "bucket"))
    # Beside a set of ``most`` shingles at most n - at shared ones still reach the threshold.
    most = F.floor((100 + THRESHOLD) * (F.col("n") - F.col("at")) / THRESHOLD) - F.col("n")
    # The aggregate reads every column and the filter is that of the joins: they share one shuffle.
    dealt = dealt.select("bucket", "cid", "n", most.cast("int").alias("most"))
    known = "bucket is not null and cid is not null and n is not null and most is not null"
    dealt = dealt.where(known).repartition("bucket")
    shared = dealt.groupBy("bucket").agg(
        F.min("n").alias("least_n"), F.max("most").alias("most_n"),
        F.min("cid").alias("low"), F.max("cid").alias("high"),
    ).where("low < high").drop("low", "high")
    fit = (F.col("most") >= F.col("least_n")) & (F.col("n") <= F.col("most_n"))
    members = cut(
        dealt.join(shared, "bucket").where(fit).select("bucket", "cid", "n").join(own.select("cid"), "cid")
    )
    # The aggregate reads every column here too: one shuffle.
    rows = members.where("bucket is not null and cid is not null and n is not null").repartition("bucket")
    mark = lambda seed: F.sum(
        F.pmod(F.xxhash64(F.lit(seed), "cid"), F.lit(1 << 40))
    ).alias(f"s{seed}")
    sums = rows.groupBy("bucket").agg(
        F.count("*").alias("g"), F.min("cid").alias("hub"), F.sum("n").alias("shingles"), mark(1), mark(2)
    ).where("g >= 2 and shingles > 0")
    # Buckets of one least member are one, in which each member is once.
    joint = cut(rows.join(sums.select("bucket", "hub"), "bucket").select("hub", "cid", "n").distinct())
    sizes = cut(
        joint.groupBy("hub").agg(F.count("*").alias("g"), F.sum("n").alias("shingles"))
        .select("hub", "g", _tiles("g", "shingles").alias("tiles"))
    )
    one = joint.join(sizes.where("tiles = 1 and g >= 2").select("hub"), "hub")
    members = one.select((-1 - F.col("hub")).alias("bucket"), "cid", "n", F.lit(1).alias("tiles"))
    wide = sizes.where("tiles > 1").select("hub")
    if not wide.isEmpty():
        # Too many for a tile: only buckets with the same members are one.
        kept = sums.join(wide, "hub").groupBy("g", "hub", "shingles", "s1", "s2").agg(F.min("bucket").alias("bucket"))
        kept = kept.select("bucket", _tiles("g", "shingles").alias("tiles"))
        members = members.union(rows.join(kept, "bucket").select("bucket", "cid", "n", "tiles"))
    members = cut(members)
    # Prints are larger than points: only members that the tree leaves a partner get them.
    pointed = _cells(_every_asks(members.where("tiles = 1")), heads.select("cid", "point"))
    paired = pointed.mapInArrow(_reaching, CELLS).select("bucket", "cid").join(heads.select("cid", "n"), "cid")
    paired = paired.select("bucket", "cid", "n", F.lit(1).alias("tiles"))
    return cut(paired.union(members.where("tiles > 1").select("bucket", "cid", "n", "tiles")))


def _cells(rows: DataFrame, shingles: DataFrame) -> DataFrame:
    """Rows beside their shingles, one cell after the other."""
    rows = rows.join(shingles, "cid").select("bucket", "tile", "block", "cid", "comp", "ask", shingles.columns[1])
    place = ["bucket", "tile", "block"]
    return rows.repartition(*(F.col(c) for c in place)).sortWithinPartitions(*place)


def _every_asks(members: DataFrame) -> DataFrame:
    """Every member meets those of its tile."""
    return members.select(
        "bucket", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int").alias("tile"),
        F.lit(0).alias("block"), "cid", F.col("cid").alias("comp"), F.lit(True).alias("ask"),
    )


def _open_buckets(members, found, links, reached) -> DataFrame:
    """Members, beside their components, of buckets that may still hold a pair across components."""
    if reached is None:
        placed = members.withColumn("comp", F.col("cid"))
    else:
        placed = members.join(reached, "cid", "left").select(
            *members.columns, F.coalesce("component", "cid").alias("comp")
        )
    apart = F.min("comp") < F.max("comp")
    wide = placed.where("tiles > 1").groupBy("bucket").agg(apart.alias("apart")).where("apart").select("bucket")
    if links is not None:
        # What a refuted edge had joined was not searched further.
        refuted = cut(_across(found.join(links, ["a", "b"], "left_anti"), reached))
        if not refuted.isEmpty():
            joined = components(refuted).select(F.col("node").alias("comp"), F.col("component").alias("joined"))
            doubtful = placed.join(joined, "comp").groupBy("bucket", "joined").agg(apart.alias("apart"))
            wide = wide.union(doubtful.where("apart").select("bucket")).distinct()
    return placed.join(wide, "bucket")


def _second_cells(left: DataFrame) -> DataFrame:
    """Members outside the largest component of a bucket meet all of it, block by tile."""
    parts = left.groupBy("bucket", "comp").agg(
        F.count("*").alias("rows"), F.sum("n").alias("shingles")
    )
    size = F.struct("rows", "shingles", "comp")
    per = parts.groupBy("bucket").agg(
        F.max(size).alias("main"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles")
    ).select(
        "bucket", F.col("main.comp").alias("main"),
        (F.col("rows") - F.col("main.rows")).alias("rows"),
        (F.col("shingles") - F.col("main.shingles")).alias("shingles"),
    ).where("rows > 0").select("bucket", "main", _tiles("rows", "shingles").alias("blocks"))
    dealt = left.join(per, "bucket")
    number = lambda seed, of: F.pmod(F.xxhash64("cid", F.lit(seed)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    met = dealt.select(
        "bucket", number(1, "tiles").alias("tile"), every("blocks").alias("block"), "cid", "comp",
        F.lit(False).alias("ask"),
    )
    ask = dealt.where("comp <> main").select(
        "bucket", every("tiles").alias("tile"), number(2, "blocks").alias("block"), "cid", "comp",
        F.lit(True).alias("ask"),
    )
    return met.union(ask)


def _texts_of(wanted: DataFrame, keyed: DataFrame, own: DataFrame) -> DataFrame:
    """The texts of the wanted cids: shorter than their sets, which are made where they are compared."""
    sources = wanted.join(own.select("cid", "_doc", "_key"), "cid")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    texts = maybe_among(keyed, "text_key", sources.select("_key"))
    return cut(texts.join(sources, same).select("cid", "text").dropDuplicates(["cid"]))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) of every row."""
    rows = cut(classes(docs))
    lowest = rows.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")
    )
    return rows.join(lowest, "component", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group: that of the smallest doc_id, the smallest text key among ties.
    Of rows that agree with it in doc_id and text, any one stays. Documents without shingles all stay."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = cut(classes(docs))
    first = rows.where("component is not null").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("kept")
    )
    ours = rows.join(first, "component")
    kept = F.struct("doc_id", "text_key").eqNullSafe(F.col("kept"))
    named = [F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")]
    repeated = cut(
        ours.where(kept).groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    gone = ours.where(~kept).select(*named).distinct().unionByName(repeated)
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (key == F.col("_key"))
    stay = docs.join(gone, same, "left_anti")
    # Few rows, if any: the bitmap finds them before texts are shuffled.
    keyed = maybe_among(docs.withColumn("_text_key", key), "_text_key", repeated.select("_key"))
    again = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_key") == F.col("_key"))
    once = keyed.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "_text_key"])
    return stay.unionByName(once.select(*docs.columns))


def oracle() -> str:
    return r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ')
    ELSE len(w) || ' ' || array_to_string(w, ' ') END AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
    FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT a AS node, b AS other FROM links
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles,
  least(w.doc_id, coalesce(min(other), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.node = w.doc_id GROUP BY w.doc_id
"""
