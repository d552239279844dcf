"""The filter audit against filters applied one after the other, and its defined cases."""

from __future__ import annotations

import itertools
import re

import pytest

from shoptide.llm import filter_audit

DOCS = "doc_id BIGINT, text STRING, lang STRING, n BIGINT, good INT, part STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT, n INT"

MANY = " ".join(f"w{i}" for i in range(120))
TEXTS = {
    "fine": MANY, "short": "a few words", "again": "same word " * 80, "capitals": MANY.upper(),
    "symbols": f"{MANY} 5 % more", "all": "LOUD & LOUD & LOUD", "none": None, "empty": "",
    "blank": " \t\n\x0b ", "wide": f"{MANY} x y É", "edge": " ".join(["x"] * 21 + [f"v{i}" for i in range(79)]),
}


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any((t or "") == text and doc is not None and d is not None and d < doc for d, t, _ in docs)
        fails.append(
            (
                doc, lang or "",
                {
                    "A": len(words) < 100,
                    "B": 100 * len(set(words)) < 80 * len(words),
                    "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                    "D": bool(re.search(r"[#$%&*|]", text)),
                    "E": smaller,
                },
            )
        )
    rows, sums = {}, {}
    for part in {p for _, p, _ in fails}:
        mine = [(d, f) for d, p, f in fails if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[name]]
                left = [(d, f) for d, f in left if not f[name]]
                rows[part, "".join(order), step] = (
                    len(left), len(gone), sum(f[name] for _, f in mine) - len(gone),
                    sum(f[name] and sum(f.values()) == 1 for _, f in mine),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                )
                sums[part, name] = sums.get((part, name), 0) + len(gone)
    return {(*k, *v, sums[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def run(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, 1, "x") for r in docs], DOCS).repartition(4)
    return {tuple(r) for r in filter_audit.filter_audit(d, spark.createDataFrame([(*r, 0) for r in labels], LABELS)).collect()}


def test_equals_filters_in_turn(spark):
    langs = ["en", "de", None, "", "en"]
    docs = [(i, t, langs[i % 5]) for i, t in enumerate(list(TEXTS.values()) * 4)]
    docs += [(3, docs[3][1], "de"), (3, docs[3][1], "en"), (None, MANY, "en"), (None, "a few words", "fr")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 40, 2)] + [(4, 1, 1), (None, 1, 1), (7, None, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_a_text_of_many_copies_in_all_parts(spark):
    docs = [(i, MANY, f"l{i % 3}") for i in range(300)] + [(1000 + i, f"{MANY} {i}", "l0") for i in range(20)]
    assert run(spark, docs, [(0, 1, 0)]) == brute(docs, [(0, 1, 0)])


def test_one_row_per_part_order_and_step(spark):
    found = run(spark, [(1, "x", "en")], [])
    assert len(found) == 600 and {r[0] for r in found} == {"en"}
    assert all(r[9] == 120 if r[1][r[2] - 1] == "A" else r[9] == 0 for r in found)


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == set()


@pytest.mark.parametrize("text", ["É" * 5 + "AB", "x" * 1_000_000 + "#"])
def test_failures_of_a_text(text):
    bits = filter_audit.failures(text.encode())
    assert bool(bits & 2) == (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
    assert bool(bits & 1) == ("#" in text) and bits & 8
