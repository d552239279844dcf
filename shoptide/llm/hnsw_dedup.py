"""Embedding near-dedup with hierarchical navigable small-world graphs, one per shard.

Vectors are compared within a label. Equal vectors are one class first, so a vector that thousands
share is one point of the graph. The classes of a label are dealt over shards of ``SHARD_ROWS``; each
shard's graph is built in one task of that bounded size and written as a table. Every class then
queries every shard of its label, in chunks of ``CHUNK_ROWS``. A beam leads each query to its nearest
nodes, from where the graph is followed over all nodes that come near the threshold, so a crowd of near
copies is found whole at any size. Beams are widened until an audit of some queries against brute force
finds ``AUDIT_RECALL`` of the links; ``near_duplicates`` can write what each audit found. Shards of all
sizes answer through their graph. What is found is verified by cosine in double precision.

A task hands back a count per query and the edges of a spanning forest of the links it found, never
the pairs; the forests are joined to components.

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component, and
vectors of a null label, link with nothing and are kept. Vectors of another length than their
label's first are compared among their own length. Rows that share a vec_id are vectors of their own.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import components, cut

THRESHOLD = 0.93
SHARD_ROWS = 100_000
CHUNK_ROWS = 50_000
#: Neighbours of a node on a level; twice as many on the lowest.
M = 12
#: Beam of the build, and the first beam of the search.
BUILD_BEAM, FIRST_BEAM = 48, 64
AUDIT_QUERIES, AUDIT_RECALL = 64, 0.999
#: Nodes this far below the threshold still lead on to their neighbours.
SLACK = 0.05
#: Candidates among which a node chooses its neighbours.
CHOICE = 64
#: Nodes that choose at once.
CHOICE_ROWS = 1024
#: Queries that walk the graph in step.
STEP_ROWS = 512
#: Float rounding that a beam allows for before the exact check.
MARGIN = 1e-4
EMPTY = -1


class Hnsw:
    """Unit vectors, and per level the nodes on it and their neighbours (padded by -1)."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, neighbours: list[np.ndarray], entry: int):
        self.vectors, self.levels, self.neighbours, self.entry = vectors, levels, neighbours, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Hnsw:
        """Insert in batches that at most double the graph; a batch also sees itself."""
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum(8, (-np.log(rng.random(n)) / np.log(M)).astype(np.int64))
        order = np.argsort(-levels, kind="stable")  # high levels first: entry points are there early
        top = int(levels.max())
        # The lowest level has one more place, for bridges between parts.
        widths = [2 * M + 1] + [M] * top
        graph = cls(vectors, levels, [np.full((n, w), EMPTY, np.int32) for w in widths], int(order[0]))
        done = 1
        while done < n:
            batch = order[done : done + min(done, STEP_ROWS)]
            graph._insert(batch)
            done += len(batch)
        graph._bridge()
        return graph

    def _insert(self, batch: np.ndarray) -> None:
        queries = self.vectors[batch]
        own = queries @ queries.T
        at = np.full(len(batch), self.entry, np.int64)
        for level in range(len(self.neighbours) - 1, -1, -1):
            on = np.flatnonzero(self.levels[batch] >= level)
            ids, sims = self._walk(queries, at, level, BUILD_BEAM if len(on) else 1)
            at = ids[:, 0]
            if not len(on):
                continue
            width = 2 * M if level == 0 else M
            earlier = np.where(on[None, :] < on[:, None], own[np.ix_(on, on)], -np.inf)
            cand = np.concatenate([ids[on], np.broadcast_to(batch[on], earlier.shape)], 1)
            chosen = self._choose(cand, np.concatenate([sims[on], earlier], 1), width)
            self.neighbours[level][batch[on], :width] = chosen
            rows, cols = np.nonzero(chosen != EMPTY)
            self._link_back(chosen[rows, cols], batch[on][rows], level, width)

    def _choose(self, cand: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Per row the candidates that are nearer to the node than to each other, and some of the rest
        by nearness; candidates of similarity -inf are none. Padded by -1."""
        parts = np.array_split(np.arange(len(cand)), len(cand) // CHOICE_ROWS + 1)
        return np.concatenate([self._choose_some(cand[p], sims[p], width) for p in parts])

    def _choose_some(self, cand: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        best = np.argsort(-sims, 1, kind="stable")[:, : max(CHOICE, width)]
        cand, sims = np.take_along_axis(cand, best, 1), np.take_along_axis(sims, best, 1)
        valid = np.isfinite(sims)
        points = self.vectors[np.where(valid, cand, 0)]
        among = points @ points.transpose(0, 2, 1)
        shadow = np.full(sims.shape, -2.0, np.float32)
        kept = np.zeros(sims.shape, bool)
        count = np.zeros(len(cand), np.int64)
        for i in range(sims.shape[1]):
            take = valid[:, i] & (shadow[:, i] < sims[:, i]) & (count < width)
            kept[:, i] = take
            count += take
            shadow[take] = np.maximum(shadow[take], among[take, i])
        spare = valid & ~kept
        spare &= spare.cumsum(1) <= np.maximum(0, width // 2 - count)[:, None]
        rank = np.where(kept, 0, np.where(spare, 1, 2))
        first = np.argsort(rank, 1, kind="stable")[:, :width]
        out = np.where(
            np.take_along_axis(rank, first, 1) < 2, np.take_along_axis(cand, first, 1), EMPTY
        )
        padding = np.full((len(out), width - out.shape[1]), EMPTY, out.dtype)
        return np.concatenate([out, padding], 1)

    def _link_back(self, nodes: np.ndarray, news: np.ndarray, level: int, width: int) -> None:
        """Adds ``news`` to the neighbours of ``nodes``; full nodes choose anew, once per ``width``."""
        links = self.neighbours[level]
        order = np.argsort(nodes, kind="stable")
        nodes, news = nodes[order].astype(np.int64), news[order]
        starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        place = np.arange(len(nodes)) - np.repeat(starts, np.diff(np.r_[starts, len(nodes)]))
        for turn in range(int(place.max(initial=0)) // width + 1):
            now = place // width == turn
            targets, row = np.unique(nodes[now], return_inverse=True)
            cand = np.full((len(targets), 2 * width), EMPTY, np.int64)
            cand[:, :width] = links[targets, :width]
            cand[row, width + place[now] % width] = news[now]
            count = (cand != EMPTY).sum(1)
            fits = count <= width
            packed = np.take_along_axis(cand, np.argsort(cand == EMPTY, 1, kind="stable"), 1)
            links[targets[fits], :width] = packed[fits, :width]
            full = np.flatnonzero(~fits)
            for part in np.array_split(full, len(full) // CHOICE_ROWS + 1):
                if len(part):
                    sims = np.einsum("qd,qmd->qm", self.vectors[targets[part]], self.vectors[cand[part]])
                    sims[cand[part] == EMPTY] = -np.inf
                    links[targets[part], :width] = self._choose(cand[part], sims, width)

    def _bridge(self) -> None:
        """Makes every node reachable from the entry on the lowest level."""
        links = self.neighbours[0]
        seen = np.zeros(len(links), bool)
        front = np.array([self.entry])
        while True:
            while len(front):
                seen[front] = True
                front = np.unique(links[front])
                front = front[front != EMPTY]
                front = front[~seen[front]]
            left = np.flatnonzero(~seen)
            if not len(left):
                break
            free = np.flatnonzero(seen & (links[:, -1] == EMPTY))
            nearest = free[(self.vectors[free] @ self.vectors[left[0]]).argmax()]
            links[nearest, -1] = left[0]
            front = left[:1]

    def _walk(self, queries: np.ndarray, at: np.ndarray, level: int, beam: int):
        """Beam search of all queries in step: ids and similarities, best first."""
        q, links = len(queries), self.neighbours[level]
        ids = np.full((q, beam), EMPTY, np.int64)
        sims = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        ids[:, 0], open_[:, 0] = at, True
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.vectors[at])
        active = np.arange(q)
        while len(active):
            score = np.where(open_[active], sims[active], -np.inf)
            pick = score.argmax(1)
            going = np.isfinite(score[np.arange(len(active)), pick])
            active, pick = active[going], pick[going]
            if not len(active):
                break
            open_[active, pick] = False
            near = links[ids[active, pick]].astype(np.int64)
            known = (near[:, :, None] == ids[active][:, None, :]).any(2) | (near == EMPTY)
            sim = np.einsum("qd,qmd->qm", queries[active], self.vectors[near])
            sim[known] = -np.inf
            all_ids = np.concatenate([ids[active], near], 1)
            all_sims = np.concatenate([sims[active], sim], 1)
            all_open = np.concatenate([open_[active], np.isfinite(sim)], 1)
            best = np.argsort(-all_sims, 1, kind="stable")[:, :beam]
            rows = np.arange(len(active))[:, None]
            sims[active], open_[active] = all_sims[rows, best], all_open[rows, best]
            ids[active] = np.where(np.isfinite(sims[active]), all_ids[rows, best], EMPTY)
        return ids, sims

    def search(self, queries: np.ndarray, beam: int):
        at = np.full(len(queries), self.entry, np.int64)
        for level in range(len(self.neighbours) - 1, 0, -1):
            at = self._walk(queries, at, level, 4)[0][:, 0]
        return self._walk(queries, at, 0, beam)

    def near(self, queries: np.ndarray, beam: int, threshold: float) -> list[np.ndarray]:
        """Nodes of similarity ``threshold`` or more per query."""
        found: list[np.ndarray] = []
        seen = np.zeros(len(self.vectors), bool)
        beam = min(beam, len(self.vectors))
        step = max(1, STEP_ROWS * FIRST_BEAM // max(beam, FIRST_BEAM))
        for part in np.array_split(np.arange(len(queries)), len(queries) // step + 1):
            ids, sims = self.search(queries[part], beam)
            for i, own, sim in zip(part, ids, sims):
                found.append(self._follow(queries[i], own[sim >= threshold - SLACK], threshold, seen))
        return found

    def _follow(self, query: np.ndarray, front: np.ndarray, threshold: float, seen: np.ndarray) -> np.ndarray:
        """The nodes of the threshold among ``front`` and what the graph leads to from there over nodes
        less than ``SLACK`` below it. ``seen`` is all false before and after."""
        visited, hits = [front], []
        seen[front] = True
        while len(front):
            sims = self.vectors[front] @ query
            hits.append(front[sims >= threshold])
            near = self.neighbours[0][front[sims >= threshold - SLACK]].ravel()
            near = near[near != EMPTY]
            front = np.unique(near[~seen[near]]).astype(np.int64)
            seen[front] = True
            visited.append(front)
        seen[np.concatenate(visited)] = False
        return np.concatenate(hits) if hits else front

    def audited_beam(self, queries: np.ndarray, threshold: float) -> tuple[int, int, int]:
        """The beam at which the audited queries find nearly all that brute force finds, and how many
        links they found then, of how many."""
        queries = queries[:: max(1, len(queries) // AUDIT_QUERIES)]
        truth = [np.flatnonzero(row) for row in queries @ self.vectors.T >= threshold]
        wanted, beam = sum(map(len, truth)), FIRST_BEAM
        while True:
            found = self.near(queries, beam, threshold)
            hits = sum(len(np.intersect1d(a, b)) for a, b in zip(found, truth))
            if hits >= AUDIT_RECALL * wanted or beam >= len(self.vectors):
                return beam, hits, wanted
            beam *= 2

    def pack(self) -> bytes:
        out = io.BytesIO()
        parts = {f"n{i}": x for i, x in enumerate(self.neighbours)}
        np.savez(out, vectors=self.vectors, levels=self.levels, entry=self.entry, **parts)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Hnsw:
        f = np.load(io.BytesIO(data))
        parts = [f[f"n{i}"] for i in range(sum(k.startswith("n") for k in f.files))]
        return cls(f["vectors"], f["levels"], parts, int(f["entry"]))


def units(column) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision, and scaled to length one in single."""
    x = np.array([np.asarray(v, np.float64) for v in column])
    scaled = x / np.abs(x).max(1, keepdims=True)  # against overflow of the squares
    return scaled, (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("cid")
    graph = Hnsw.build(units(pdf["vector"])[1])
    return pd.DataFrame(
        {
            "space": [pdf["space"].iloc[0]],
            "shard": [pdf["shard"].iloc[0]],
            "cids": [pdf["cid"].to_numpy()],
            "copies": [pdf["copies"].to_numpy()],
            "exact": [units(pdf["vector"])[0].tobytes()],
            "graph": [graph.pack()],
        }
    )


def query_shard(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """Per query its number of links in the shard, edges of a spanning forest of the links, and what the
    audit found of what it wanted."""
    if not len(queries) or not len(shard):
        return pd.DataFrame({"cid": [], "links": [], "to": [], "hits": [], "wanted": []}).astype("int64")
    one = shard.iloc[0]
    graph = Hnsw.unpack(one["graph"])
    cids, copies = np.asarray(one["cids"]), np.asarray(one["copies"])
    exact = np.frombuffer(one["exact"]).reshape(len(cids), -1)
    own, unit = units(queries["vector"])
    beam, hits, wanted = graph.audited_beam(unit, THRESHOLD - MARGIN)
    lengths, own_lengths = np.linalg.norm(exact, axis=1), np.linalg.norm(own, axis=1)
    ids = queries["cid"].to_numpy()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out_cid, out_links, out_to = [], [], []
    for i, found in enumerate(graph.near(unit, beam, THRESHOLD - MARGIN)):
        cosine = exact[found] @ own[i] / (lengths[found] * own_lengths[i])
        found = found[(cosine >= THRESHOLD) & (cids[found] != ids[i])]
        out_cid.append(ids[i])
        out_links.append(int(copies[found].sum()))
        out_to.append(ids[i])
        for j in cids[found].tolist():
            a, b = root(int(ids[i])), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out_cid.append(ids[i])
                out_links.append(0)
                out_to.append(j)
    found = pd.DataFrame({"cid": out_cid, "links": out_links, "to": out_to}, dtype="int64")
    # The audit stands beside the first row.
    first = np.arange(len(found)) == 0
    return found.assign(hits=np.where(first, hits, 0), wanted=np.where(first, wanted, 0))


def near_duplicates(
    vectors: DataFrame, shard_rows: int = SHARD_ROWS, audit_path: str | None = None
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    ``audit_path`` takes a table of what the audits found (hits) of what brute force finds (wanted)."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists(values, lambda v: v != 0)
    rows = vectors.select(
        "vec_id", F.col("label").cast("string").alias("label"), values.alias("vector"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    space = F.concat_ws("/", F.size("vector").cast("string"), "label").alias("space")
    same = rows.where("usable").select("vec_id", space, "vector")
    classes = same.groupBy("space", "vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("lowest")
    )
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    sizes = classes.groupBy("space").agg(
        F.ceil(F.count("*") / shard_rows).alias("shards"), F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks")
    )
    dealt = classes.join(sizes, "space")
    shard = F.pmod(F.xxhash64("cid"), F.col("shards")).alias("shard")
    graphs = dealt.select("space", shard, "cid", "copies", "vector").groupBy("space", "shard").applyInPandas(
        build_shard,
        "space string, shard long, cids array<long>, copies array<long>, exact binary, graph binary",
    )
    graphs = cut(graphs)
    queries = dealt.select(
        "space", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("cid", F.lit(5)), F.col("chunks")).alias("chunk"), "cid", "vector",
    )
    asked = graphs.join(sizes, "space").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    ).drop("shards", "chunks")
    keys = ["space", "shard", "chunk"]
    found = queries.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        query_shard, "cid long, links long, to long, hits long, wanted long"
    )
    found = cut(found)
    if audit_path is not None:
        found.where("wanted > 0").select("hits", "wanted").write.parquet(audit_path)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    reached = components(found.where("cid <> to"), "cid", "to").select(
        F.col("node").alias("cid"), "component"
    )
    placed = classes.join(links, "cid", "left").join(reached, "cid", "left").select(
        "space", "vector", "lowest", F.coalesce("component", "cid").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    placed = cut(placed)
    lowest = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    placed = placed.join(lowest, "component").select(
        "space", F.col("vector").alias("_vector"), "n_links", "component_id"
    )
    judged = rows.withColumn("space", F.when(F.col("usable"), space)).join(
        placed.withColumnRenamed("space", "_space"),
        (F.col("space") == F.col("_space")) & (F.col("vector") == F.col("_vector")), "left",
    )
    component = F.coalesce("component_id", "vec_id")
    return judged.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def oracle() -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a
), reach AS (
  SELECT a AS node, b AS other FROM links
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a
), low AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON a = vec_id LEFT JOIN low ON node = vec_id
"""
