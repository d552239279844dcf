"""Operators on small frames against plain Python: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoptide.llm import (
    common,
    debruijn_spans,
    hilbert_shards,
    hnsw_dedup,
    line_runs,
    link_trust,
    mil_toxicity,
    minhash_containment,
    rtree_jaccard,
    secret_forest,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def documents(seed: int = 3) -> list[tuple[int, str | None]]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "ñ", "中文", "Zu"]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), "A common line that many pages hold."
    rows: list[str | None] = [None, "", "  \n\t ", "one two", "one  two", "ONE two", prose(6000)]
    rows += [f"{prose(40)} {passage} {prose(30)}" for _ in range(6)]
    base = prose(200)
    rows += [base] * 5 + [base.replace("w1 ", "x1 ", 1), base.upper(), base + " tail"]
    rows += [f"{prose(12)}\n  {line.upper()}\t\n{prose(9)}" for _ in range(4)] + [line]
    rows += ["again and again " * 40, prose(35), prose(34), " nbsp  is no blank " * 12]
    for _ in range(6):
        edited = base.split()
        for _ in range(rnd.randrange(1, 12)):
            edited[rnd.randrange(len(edited))] = "edit"
        rows.append(" ".join(edited))
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, "en" if i % 3 else None, "s0", 7) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# Substring dedup


def brute_spans(rows):
    places = defaultdict(list)
    for at, (_, text) in enumerate(rows):
        w = words(text)
        for i in range(len(w) - 34):
            places[tuple(w[i : i + 35])].append((at, i))
    gone = defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for at, i in found:
                gone[at].update(range(i, i + 35))
    out = []
    for at, (doc, text) in enumerate(rows):
        w = words(text)
        kept = [x for i, x in enumerate(w) if i not in gone[at]]
        out.append((doc, len(w), len(gone[at]), sha(" ".join(kept))))
    return Counter(out)


def test_spans_match_brute_force(docs, rows):
    got = debruijn_spans.span_digests(docs).collect()
    assert Counter(map(tuple, got)) == brute_spans(rows)


def test_spans_of_repeated_rows(spark, rows):
    twice = [*rows, rows[7], (7, "other " * 36), (None, rows[8][1])]
    frame = spark.createDataFrame(twice, "doc_id long, text string")
    assert Counter(map(tuple, debruijn_spans.span_digests(frame).collect())) == brute_spans(twice)


def test_spans_of_nothing(no_docs):
    assert debruijn_spans.span_digests(no_docs).collect() == []


# Line dedup


def brute_lines(rows):
    key = lambda line: line.encode().strip().lower().decode()
    held = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            held[k].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < 20 or len(held[key(x)]) < 3 or doc == max(held[key(x)])
        ]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return Counter(out)


@pytest.mark.parametrize("count", [1, 7])
def test_lines_match_brute_force(docs, rows, count, monkeypatch):
    monkeypatch.setattr(line_runs.batches, "__defaults__", (count,))
    kept = line_runs.dedup_lines(docs.withColumn("n_lines", common.F.lit("clash")), count)
    got = [(r.doc_id, r.n_lines, r.n_dropped, sha(r.text or "")) for r in kept.collect()]
    assert Counter(got) == brute_lines(rows)


def test_runs_are_compacted(docs):
    runs = line_runs.LineRuns(docs.sparkSession)
    for _ in range(4):
        runs.add(docs)
    assert [len(level) for level in runs.levels] == [1, 1]
    assert not runs.add(docs).where("is_new").count()


def test_documents_hold_a_line_and_not_rows(spark):
    """A row that comes twice holds its line once: two documents are not three."""
    line, extra = "this line is long enough to count", "and this one is in three documents"
    rows = [(1, line), (1, line), (2, line), (3, f"{extra}\nx"), (3, f"{extra}\nx"), (4, extra), (5, extra), (None, line), (None, extra)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS)
    found = sorted((tuple(r) for r in line_runs.line_dedup_digests(df).collect()), key=str)
    stays = lambda d, t, n=1: (d, n, 0, sha(t))
    assert found == sorted(
        [stays(1, line), stays(1, line), stays(2, line), (3, 2, 1, sha("x")), (3, 2, 1, sha("x")),
         (4, 1, 1, sha("")), stays(5, extra), stays(None, line), (None, 1, 1, sha(""))], key=str,
    )


def test_lines_of_nothing(no_docs):
    assert line_runs.line_dedup_digests(no_docs).collect() == []


# Jaccard join


def brute_classes(rows):
    sets = {}
    for doc, text in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n = max(1, len(w) - 4)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(n)} if w else set()
    lowest = {doc: doc for doc in sets}

    def root(x):
        while lowest[x] != x:
            x = lowest[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                lowest[high] = low
    return {(doc, len(sets[doc]), root(doc)) for doc in ids}


def test_join_matches_brute_force(docs, rows):
    assert {tuple(r) for r in rtree_jaccard.joined(docs).collect()} == brute_classes(rows)


def test_counts_leave_no_pair_out():
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    sets = [draw(int(n)) for n in rng.integers(900, 7000, 30)]
    for n in (40, 300, 1500, 6000):
        whole = draw(n)
        sets += [np.union1d(whole[rng.random(n) < 1 - 0.04 * k], draw(n // 30 * k)) for k in range(6)]
    fine = [rtree_jaccard.unpack_point(rtree_jaccard.fine_point(s)) for s in sets]
    every = np.arange(len(sets))
    for comps, share in ((every, 1.0), (every, 0.4), (rng.integers(0, 8, len(sets)), 0.4)):
        asks = rng.random(len(sets)) < share
        linked = set()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if comps[i] != comps[j] and (asks[i] or asks[j]) and 100 * both >= 80 * (len(a) + len(b) - both):
                    linked |= {i, j}
        found = set(rtree_jaccard.reaching(comps, asks, fine).tolist())
        assert linked and linked <= found
        assert len(found) < len(sets) / 2  # long unrelated sets are told apart


def test_join_over_tiles(spark, monkeypatch):
    monkeypatch.setattr(rtree_jaccard, "TILE_ROWS", 6)
    rnd = random.Random(5)
    base = [f"t{i}" for i in range(90)]
    rows = []
    for i in range(40):  # similar to the first to either side of the threshold
        edited = list(base)
        for _ in range(rnd.randrange(0, 5)):
            edited[rnd.randrange(90)] = f"e{rnd.randrange(3)}"
        rows.append((i, " ".join(edited)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in rtree_jaccard.joined(frame).collect()} == brute_classes(rows)


def test_buckets_of_one_least_member_are_one(spark, monkeypatch):
    """Near copies share most of their buckets, never all: each is sent to its group once."""
    seen, own = [], rtree_jaccard._every_asks
    monkeypatch.setattr(rtree_jaccard, "_every_asks", lambda members: seen.append(members) or own(members))
    rnd = random.Random(8)
    rows = []
    for family in range(3):
        base = [f"f{family}t{i}" for i in range(90)]
        for i in range(12):
            edited = list(base)
            for _ in range(rnd.randrange(0, 4)):
                edited[rnd.randrange(90)] = f"e{rnd.randrange(9)}"
            rows.append((100 * family + i, " ".join(edited)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in rtree_jaccard.joined(frame).collect()} == brute_classes(rows)
    groups = seen[0].groupBy("bucket").agg(
        F.min("cid").alias("least"), F.count("*").alias("rows"), F.countDistinct("cid").alias("members")
    ).collect()
    assert groups and len({g.least for g in groups}) == len(groups)
    assert all(g.rows == g.members for g in groups)


def test_join_remembers_few_words(monkeypatch):
    caches = []

    class Seen(common.WordHashes):
        def __init__(self, *most):
            super().__init__(*most)
            caches.append(self)

        def __missing__(self, word):
            value = super().__missing__(word)
            assert len(self) <= 8
            return value

    monkeypatch.setattr(rtree_jaccard, "WordHashes", Seen)
    monkeypatch.setattr(rtree_jaccard, "TASK_WORDS", 8, raising=False)
    texts = [" ".join(f"W{i * j}" for j in range(30)) for i in range(9)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text_key": list(range(9)), "text": texts})
    first = [r for b in rtree_jaccard._first_pass(iter([batch])) for r in b.to_pylist() if r["slice"] is None]
    assert caches and [(r["doc_id"], r["n"]) for r in first] == [(i, n) for i, n, _ in sorted(brute_classes(list(enumerate(texts))))]
    pairs = pa.RecordBatch.from_pydict(
        {"a": [0, 1], "b": [2, 3], "x": [texts[8], texts[1]], "y": [texts[8].lower(), texts[5]]}
    )
    assert [r for b in rtree_jaccard._verify(iter([pairs])) for r in b.to_pylist()] == [{"a": 0, "b": 2}]


def test_join_hands_on_small_batches(spark, monkeypatch):
    """The passes over the texts see batches of a few MB, and the session is as before."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, write = spark.conf.get(name), rtree_jaccard.cut
    monkeypatch.setattr(rtree_jaccard, "cut", lambda df: seen.append(spark.conf.get(name)) or write(df))
    frame = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    assert {r.component for r in rtree_jaccard.classes(frame).select("component").collect()} != {None}
    assert set(seen) == {str(common.CHUNK_BYTES)} and spark.conf.get(name) == before


def test_join_finds_components_once(spark, monkeypatch):
    """Prints confirm pairs that the sets refute: few tables are written, and no link is lost."""
    written, write, prints = [], common.cut, rtree_jaccard.shared_prints
    for module in (common, rtree_jaccard):
        monkeypatch.setattr(module, "cut", lambda df: written.append(df) or write(df))
    monkeypatch.setattr(rtree_jaccard, "TILE_ROWS", 6)
    monkeypatch.setattr(
        rtree_jaccard, "shared_prints", lambda own, others, table: np.minimum(prints(own, others, table) + 6, len(own))
    )
    rnd = random.Random(11)
    base = [f"t{i}" for i in range(90)]
    rows = []
    for i in range(40):
        edited = list(base)
        for _ in range(rnd.randrange(1, 6)):
            edited[rnd.randrange(90)] = f"e{rnd.randrange(3)}"
        rows.append((i, " ".join(edited)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in rtree_jaccard.joined(frame).collect()} == brute_classes(rows)
    assert len(written) <= 26


def test_one_of_each_group_stays(docs, rows):
    kept = {r.doc_id for r in rtree_jaccard.keep_first(docs).collect()}
    assert kept == {low for _, n, low in brute_classes(rows) if n} | {d for d, n, _ in brute_classes(rows) if not n}


def test_one_row_of_each_group_stays(spark):
    """Repeated rows of the kept document, repeated rows outside any group, and one id with two texts."""
    text, other, own = "a b c d e f g h", "p q r s t u v", "k l m n o p q r s"
    rows = [(1, text), (1, text), (1, text), (2, text), (3, other), (3, other), (4, None), (4, None), (None, own), (None, own), (1, own)]
    df = spark.createDataFrame([(d, t, "en", f"s{i}", 1) for i, (d, t) in enumerate(rows)], DOCS)
    kept = rtree_jaccard.keep_first(df)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert len(found) == 5
    assert found.count((1, text)) == 1 and found.count((3, other)) == 1 and found.count((4, None)) == 2
    assert sum(t == own for _, t in found) == 1


def test_join_of_nothing(no_docs):
    assert rtree_jaccard.joined(no_docs).collect() == []


# Decontamination


def brute_leaks(rows, items):
    def shingles(text):
        w = words((text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    found = set()
    for item, passage in items:
        wanted = shingles(passage)
        for doc, text in rows:
            shared = len(wanted & shingles(text))
            if wanted and 100 * shared >= 80 * len(wanted):
                found.add((doc, item, len(wanted), shared))
    return found


def test_leaks_match_brute_force(spark, docs, rows):
    long = rows[6][1].split()
    items = [
        (0, " ".join(long[100:140])), (1, " ".join(long[5000:5030]).upper()), (2, "one two"),
        (3, None), (4, "  "), (5, " ".join(long[10:30] + ["nowhere"] * 30)), (6, rows[7][1]),
        (7, " ".join(long[200:240][:-1] + ["else"])),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in minhash_containment.find_leaks(docs, bench).collect()}
    assert got == brute_leaks(rows, items)
    left = {r.doc_id for r in minhash_containment.drop_leaking(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {x[0] for x in got}


def test_leaks_of_nothing(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert minhash_containment.find_leaks(docs, none).collect() == []
    one = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert minhash_containment.find_leaks(no_docs, one).collect() == []


# Shards


def test_curve_visits_every_cell_by_steps():
    places = hilbert_shards.curve()
    assert sorted(places) == list(range(4096))
    at = {p: (c // 256, c // 16 % 16, c % 16) for c, p in enumerate(places)}
    assert all(sum(abs(x - y) for x, y in zip(at[i], at[i + 1])) == 1 for i in range(4095))


def test_shards_are_even_and_gapless(docs, rows, monkeypatch):
    monkeypatch.setattr(hilbert_shards, "RUN_ROWS", 3)
    got = hilbert_shards.shard_digests(docs).collect()
    data = {d: (t or "").encode() for d, t in rows}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (d, len(b) + 1, zlib.crc32(b)) for d, b in data.items()
    }
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(slots) == 8 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    curve = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)


def test_shards_of_few_rows(docs, no_docs):
    assert hilbert_shards.shard_digests(no_docs).collect() == []
    assert len({r.shard for r in hilbert_shards.shard_digests(docs.limit(3)).collect()}) == 3


# Urls


def test_trust_follows_links(spark):
    pages = [
        (0, "http://a.example.org/fr/1", '<a href="http://good.x/1">g</a>'),
        (1, "http://EVIL.example.com/de/1", None),
        (2, "http://linker.y/p?q#f", '<a class="c" href=\'//evil.example.com/\'>e</a>'),
        (3, "http://good.x/", ""), (4, None, "<a href='/x'>"), (5, "no scheme", ""),
        (6, "https://sub.example.net/en/", ""), (7, "https://sub.example.net", ""),
        (8, "https://net/?x", ""), (9, "http://lonely.z#x", ""), (1, "http://EVIL.example.com/de/1", None),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", common.F.lit("clash"))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in link_trust.url_verdicts(frame).collect()}
    assert got == {
        (0, "a.example.org", "/fr/1", "org/fr/", "allow"),
        (1, "evil.example.com", "/de/1", "example.com/de/", "block"),
        (2, "linker.y", "/p", None, "block"), (3, "good.x", "/", None, "allow"),
        (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "sub.example.net", "/en/", "example.net/en/", "allow"),
        (7, "sub.example.net", "", None, "allow"), (8, "net", "/", "net/", "block"),
        (9, "lonely.z", "", None, "allow"),
    }


def test_propagated_blocks_do_not_depend_on_the_number_of_pages(spark):
    """A host that links to a blocked one is blocked, among however many blocked pages."""
    from pyspark.sql import functions as F

    rows = [
        (-1, "http://evil.example.com/de/1", ""),
        (-2, "http://linker.y/", '<a href="http://evil.example.com/x">'),
    ]
    rows += [(-10 - i, f"http://other{i}.y/", '<a href="http://evil.example.com/x">') for i in range(99)]
    few = spark.createDataFrame(rows, "page_id long, url string, html string")
    for n in (1_000, 10_000_000):
        blocked = spark.range(n).select(
            F.col("id").alias("page_id"), F.lit("http://many.net/").alias("url"), F.lit("").alias("html")
        )
        got = link_trust.url_verdicts(few.union(blocked)).where("page_id = -2").first()
        assert got.verdict == "block", n


def test_trust_reaches_its_fixed_point(spark):
    """A chain of more than ten hosts, a cycle and links of a host to itself, against the solution."""
    import numpy as np

    damping = link_trust.DAMPING
    links = [(f"h{i + 1}", f"h{i}", 1) for i in range(14)]
    links += [("h3", "h3", 2), ("c0", "c1", 1), ("c1", "c0", 1), ("c0", "h0", 9), ("c1", "c2", 9)]
    links += [("d", "c0", 9), ("d", "c1", 9)]
    hosts = sorted({h for a, b, _ in links for h in (a, b)})
    place = {h: i for i, h in enumerate(hosts)}
    edges = spark.createDataFrame(links, "src string, dst string, n long")
    seed = {"trust": {"h14": 0.25, "c1": 0.75}, "distrust": {"h0": 1.0}}
    start = spark.createDataFrame(
        [(k, h, x) for k, of in seed.items() for h, x in of.items()], "kind string, host string, seed double"
    )
    ways = link_trust.arcs(edges)
    got = {(r.kind, r.host): r.score for r in link_trust.propagate(start, ways).collect()}
    for kind, of in seed.items():
        flow = np.zeros((len(hosts), len(hosts)))
        for a, b, n in links:
            x, y = (a, b) if kind == "trust" else (b, a)
            flow[place[y], place[x]] += n
        flow /= np.maximum(flow.sum(axis=0), 1)
        first = np.array([of.get(h, 0.0) for h in hosts])
        solved = np.linalg.solve(np.eye(len(hosts)) - damping * flow, (1 - damping) * first)
        for h, x in zip(hosts, solved):
            assert got.get((kind, h), 0.0) == pytest.approx(x, rel=1e-9, abs=0), (kind, h)
    with pytest.raises(RuntimeError):
        link_trust.propagate(start, ways, 5)
    pages = [(0, "http://h0.example.com/de/1", "")]
    pages += [(i, f"http://h{i}.y/", f"<a href='http://h{i - 1}.{'y' if i > 1 else 'example.com'}/'>") for i in range(1, 13)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.verdict for r in link_trust.url_verdicts(frame).collect()} == {"block"}


# Embeddings


def test_embeddings_match_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.12 * (i % 5)).tolist(), i % 2) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 1), (2003, rows[0][1], None), (2004, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = {i: np.array(v) for i, v, y in rows if i < 2000}
    label = {i: y for i, v, y in rows}
    links = defaultdict(set)
    for i in x:
        for j in x:
            if i != j and label[i] == label[j] and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93:
                links[i].add(j)

    def lowest(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    want = {(i, len(links[i]), lowest(i), lowest(i) == i) for i, _, _ in rows}
    assert {tuple(r) for r in hnsw_dedup.near_duplicates(frame, shard_rows=60).collect()} == want


def test_links_come_through_the_graph(spark, tmp_path):
    """5,000 vectors of one label: pairs, groups, and a crowd larger than any beam."""
    import numpy as np

    rng = np.random.default_rng(8)
    centres = rng.normal(size=(2400, 32))
    of = np.r_[np.repeat(np.arange(2000), 2), np.arange(2000, 2400), np.full(600, 0)]
    x = centres[of] + rng.normal(size=(len(of), 32)) * 0.18
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    audit = str(tmp_path / "audit")
    got = {r.vec_id: r.n_links for r in hnsw_dedup.near_duplicates(frame, audit_path=audit).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    assert want.max() > 64
    assert all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.99 * want.sum()
    (seen,) = spark.read.parquet(audit).collect()
    assert seen.hits >= hnsw_dedup.AUDIT_RECALL * seen.wanted > 0


def test_embeddings_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert hnsw_dedup.near_duplicates(frame).collect() == []


def test_graph_reaches_every_node():
    import numpy as np

    rng = np.random.default_rng(3)
    x = (rng.normal(size=(40, 8))[np.repeat(np.arange(40), 50)] + rng.normal(size=(2000, 8)) * 1e-3).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw_dedup.Hnsw.build(x)
    ids, _ = graph.search(x[:3], len(x))
    assert all(set(row.tolist()) == set(range(len(x))) for row in ids)


def test_graph_recall():
    import numpy as np

    x = np.random.default_rng(4).normal(size=(3000, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw_dedup.Hnsw.build(x)
    graph = hnsw_dedup.Hnsw.unpack(graph.pack())
    ids, _ = graph.search(x[:200], 64)
    truth = np.argsort(-(x[:200] @ x.T), 1)[:, :10]
    assert np.mean([len(np.intersect1d(a, b)) / 10 for a, b in zip(ids, truth)]) > 0.9


# Toxicity


def test_toxicity_learns_from_labels(spark):
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdef") for _ in range(5)) for _ in range(80)]
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(rnd.choice(vocabulary) for _ in range(8)) for _ in range(rnd.randrange(1, 9))]
        if i % 4 == 0:
            sentences.insert(rnd.randrange(len(sentences) + 1), f"you {rnd.choice(vocabulary)} zorgling {rnd.choice(vocabulary)}")
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, "..!"), (902, "zorgling zorgling")]
    labels += [(5, 1, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mil_toxicity.toxicity_scores(docs, marks).collect()
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held) > 20
    assert all(r.score == 0 for r in got if r.doc_id in (900, 901))
    none = mil_toxicity.toxicity_scores(docs, marks.limit(0)).collect()
    assert {r.predicted for r in none} == {0} and len(none) == len(rows)
    model = mil_toxicity.train(docs, marks)
    spans = mil_toxicity.score(docs.where("doc_id = 0"), model).first().offending
    assert len(spans) == 1 and "zorgling" in rows[0][1][spans[0]["first"] : spans[0]["last"]]


# Secrets


def test_secrets_are_told_from_numbers(spark, no_docs):
    rnd = random.Random(9)
    text = lambda: " ".join("".join(rnd.choice("aeioulnst") for _ in range(6)) for _ in range(30))
    rows = [(None, None, None), (1, "", "a"), (2, "  ", "a")]
    secrets, others = {}, {}
    for i in range(10, 90):
        key = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
        number = "4" + "".join(rnd.choice("0123456789") for _ in range(15))
        name = rnd.choice(["token = ", "password=", "api_key: "])
        rows.append((i, f'{text()} {name}"{key}" {text()} {number}, {text()}', f"s{i % 3}"))
        secrets[i], others[i] = sha(key), sha(number)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = secret_forest.secret_findings(docs).collect()
    assert {(r.doc_id, r.value_sha256) for r in got if r.is_secret} == set(secrets.items())
    assert {(r.doc_id, r.value_sha256) for r in got if not r.is_secret} == set(others.items())
    assert secret_forest.secret_findings(no_docs).collect() == []
    alone = secret_forest.secret_findings(docs.where("doc_id < 3").drop("source"))
    assert alone.collect() == []


def test_secrets_in_a_session_that_observed_rows(spark):
    """A forest straight from its fit drags the session along, and that cannot be sent any more then."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rnd = random.Random(4)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'token = "{key()}" and {rnd.randrange(10**15, 10**16)}') for i in range(60)]
    got = secret_forest.secret_findings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 120 and sum(r.is_secret for r in got) == 60


def test_secrets_anywhere_in_a_word(spark):
    """Whatever follows a value, padding, several values in a word, and values without a digit."""
    rnd = random.Random(4)
    draw = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    prose = lambda: " ".join(draw(6, "aeioulnst") for _ in range(20))
    hexes, base64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, secrets, others = [], set(), set()
    for i in range(0, 400, 8):
        key, padded, issued, plain = draw(40, hexes), draw(42, base64) + "==", "AKIA" + draw(16, base64[:26]), draw(20, base64[:52])
        number = "4" + draw(15, "0123456789")
        texts = [
            f'token = "{key}"### {prose()}',
            f'password="{padded}" {prose()}',
            f'{{"token":"{key}","id":"x1","password":"{padded}"}}',
            f"http://a.example/p?token={key}&page=2",
            f"aws_secret_access_key={padded}",
            f"{issued}, {prose()} {issued}### ",
            f"password={plain}; {prose()}",
            f"{prose()} {number}, internationalization {prose()}",
        ]
        wanted = [{key}, {padded}, {key, padded}, {key}, {padded}, {issued}, {plain}, set()]
        for j, (text, values) in enumerate(zip(texts, wanted)):
            rows.append((i + j, text, "s"))
            secrets |= {(i + j, sha(v)) for v in values}
        others |= {(i + 7, sha(number)), (i + 7, sha("internationalization"))}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = secret_forest.secret_findings(docs).collect()
    assert {(r.doc_id, r.value_sha256) for r in got if r.is_secret} == secrets
    assert {(r.doc_id, r.value_sha256) for r in got if not r.is_secret} >= others
    issued = [r for r in got if r.is_secret and r.doc_id % 8 == 5]
    assert len(issued) == 2 * 50


# Components


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 99), (99, 98), (7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in common.components(frame).collect()}
    assert got == {i: 0 for i in range(51)} | {98: 98, 99: 98, 100: 98}


def test_components_of_many_graphs_in_few_steps(spark, monkeypatch):
    """Groups whose edges lie in many tasks, against plain Python; repeated and turned edges too."""
    written, write = [], common.cut
    monkeypatch.setattr(common, "cut", lambda df: written.append(df) or write(df))
    monkeypatch.setattr(common, "TASK_NODES", 64, raising=False)
    rnd = random.Random(4)
    edges, lowest = [], {}
    for group, size in enumerate([2, 3, 40, 400, 1500]):
        ids = [10_000 * group + x for x in rnd.sample(range(5000), size)]
        lowest |= dict.fromkeys(ids, min(ids))
        for i in range(1, size):
            other = ids[i - 1] if group % 2 else ids[rnd.randrange(i)]
            edges += [(ids[i], other)] * rnd.randrange(1, 3) + [(other, ids[i])] * (i % 7 == 0)
    rnd.shuffle(edges)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(16)
    got = common.components(frame).collect()
    assert len(got) == len(lowest) and {r.node: r.component for r in got} == lowest
    assert len(written) <= 5
