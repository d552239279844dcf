"""WARC archives: what is written is read back, whatever the payload; offsets; odd and broken files."""

from __future__ import annotations

import gzip
import hashlib
import json
from pathlib import Path

import pytest

from shoptide.llm import common, warc_members

PAGES = "page_id BIGINT, url STRING, html STRING, record_type STRING, key BIGINT"
LONG = "<p>" + "long page " * 20 + "</p>"
HEAD = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(3)


def brute(rows):
    first = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(html)
        revisit = refers is not None and refers != page
        out.append(
            (page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", refers if revisit else None)
        )
    return sorted(out, key=str)


ROWS = [
    (1, "https://a.example/x", "<html>one</html>"), (2, None, None), (3, "https://a.example/ y\r\nX: 1", ""),
    (4, "u", "é" * 50), (5, "u", LONG), (6, "u", LONG), (-7, "u", LONG), (8, "u", "x" * 99), (9, "u", "x" * 99),
    (10, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (11, "u", "\r\n\r\n" * 40), (12, "u", "a\x00b " * 60),
    (None, "u", LONG), (None, "u", "alone " * 30), (5, "u", LONG), (-7, "u", LONG), (13, "u", "b" * 100), (14, "u", "b" * 100),
    (15, "u", "\U0001f600" * 25), (16, "u", " " * 3_000_000 + "end"),
]


def test_round_trip(spark):
    found = warc_members.page_records(frame(spark, ROWS)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(ROWS)


def test_many_copies_of_one_page(spark):
    rows = [(i, "u", LONG if i % 3 else f"{LONG}{i}") for i in range(400)]
    found = warc_members.page_records(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_empty_table(spark):
    found = warc_members.page_records(frame(spark, []))
    assert found.collect() == [] and "refers_to" in found.columns


def archived(spark, rows):
    root = common.scratch(spark)
    warc_members.write_monolithic(frame(spark, rows), f"{root}/whole")
    return root, warc_members.normalise(spark, f"{root}/whole", f"{root}/members")


def test_every_record_is_a_member_at_its_offset(spark):
    root, index = archived(spark, ROWS)
    seen, ends = [], {}
    for r in index.orderBy("archive", "offset").collect():
        data = Path(r.archive.removeprefix("file:")).read_bytes()
        assert r.offset == ends.get(r.archive, 0)
        ends[r.archive] = r.offset + r.length
        member = gzip.decompress(data[r.offset : r.offset + r.length])
        head, _, body = member.partition(b"\r\n\r\n")
        named = warc_members.fields(head)
        assert member.endswith(b"\r\n\r\n") and len(body) - 4 == int(named["content-length"])
        assert named["warc-record-id"] == r.record_id and named["warc-type"] == r.record_type
        seen.append(r.record_id)
        assert len(data) >= ends[r.archive]
    for archive, end in ends.items():
        assert Path(archive.removeprefix("file:")).stat().st_size == end
    whole = [gzip.decompress(p.read_bytes()) for p in Path(root.removeprefix("file:"), "whole").glob("*.gz")]
    again = [gzip.decompress(p.read_bytes()) for p in Path(root.removeprefix("file:"), "members").glob("*.gz")]
    assert len(seen) == len(ROWS) and sorted(whole) == sorted(again)
    assert not any("\n" in r.target or " " in r.target for r in index.collect())


def test_payloads_come_back(spark):
    _, index = archived(spark, ROWS)
    kept = warc_members.read_records(index, keep_payload=True).where("record_type = 'response'")
    payloads = sorted((str(r.page_id), bytes(r.payload)) for r in kept.collect())
    wanted = sorted((str(p), (h or "").encode()) for (p, _, h), b in zip(ROWS, map(lambda r: brute_type(r), ROWS)) if b)
    assert payloads == wanted


def brute_type(row):
    first = {LONG: -7, "b" * 100: 13}
    return row[2] not in first or row[0] == first[row[2]]


def test_a_filter_on_the_index_reads_only_those_records(spark):
    _, index = archived(spark, ROWS)
    picked = warc_members.read_records(index.where("record_id in ('<urn:page:4>', '<urn:page:15>')")).collect()
    assert {r.page_id for r in picked} == {4, 15}


def test_normalising_twice_gives_the_same_bytes(spark, tmp_path):
    source = tmp_path / "a.warc.gz"
    # Already a member per record, with more blank lines than there should be.
    records = [(HEAD.format(i, len(b)) + b).encode() for i, b in enumerate(["x", "", "y" * 2_000_000])]
    source.write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n\r\n") for r in records))
    folder = f"{common.scratch(spark)}/members"
    first = warc_members.normalise(spark, str(source), folder)
    assert {(r.page_id, r.payload_bytes) for r in warc_members.read_records(first).collect()} == {(0, 1), (1, 0), (2, 2_000_000)}
    out = Path(folder.removeprefix("file:"), "a.warc.gz")
    before = out.read_bytes()
    warc_members.normalise(spark, str(source), folder)
    assert out.read_bytes() == before and not list(out.parent.glob("*.part"))


@pytest.mark.parametrize("harm", ["cut", "digest", "head"])
def test_broken_archives_are_errors(spark, tmp_path, harm):
    root, index = archived(spark, [(1, "u", "x" * 5000 + "y")])
    whole = next(p for p in Path(root.removeprefix("file:"), "whole").glob("*.gz") if len(gzip.decompress(p.read_bytes())))
    data = gzip.decompress(whole.read_bytes())
    bad = tmp_path / "bad.warc.gz"
    if harm == "cut":
        bad.write_bytes(whole.read_bytes()[:-20])
    elif harm == "head":
        bad.write_bytes(gzip.compress(b"no record\r\n\r\n"))
    else:
        bad.write_bytes(gzip.compress(data.replace(b"xxxy", b"xxyx")))
    with pytest.raises(Exception, match="PythonException|ValueError|early|digest|WARC"):
        warc_members.read_records(warc_members.normalise(spark, str(bad), f"{root}/bad")).collect()


def test_sidecar_is_json_lines(spark):
    root, _ = archived(spark, ROWS[:3])
    lines = [json.loads(x) for p in Path(root.removeprefix("file:"), "members").glob("*.cdxj") for x in p.read_text().splitlines()]
    assert {x["record_id"] for x in lines} == {"<urn:page:1>", "<urn:page:2>", "<urn:page:3>"}
