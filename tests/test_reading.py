import hashlib

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import binary_corpus, corpus, rows


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_decoding_of_bytes(spark):
    control = bytes([1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 14, 0x41])
    c = binary_corpus(spark, {
        "ok.txt": "héllo\r\nwörld".encode(), "bom.txt": b"\xef\xbb\xbfhi", "bad.txt": b"\xc3\x28", "nul.txt": b"a\x00b",
        "ctl.txt": control, "few.txt": b"\x01" * 8, "sparse.txt": b"\x01" * 9 + b"a" * 200, "empty.txt": b"",
    })
    got = {r.path: (r.refusal, r.encoding, r.text) for r in tl.decode(c).collect()}
    assert got["ok.txt"] == (None, "utf-8", "héllo\r\nwörld")
    assert got["bom.txt"] == (None, "utf-8-bom", "hi")
    assert got["bad.txt"] == ("malformed-utf8", None, None)
    assert got["nul.txt"][0] == "binary"
    assert got["ctl.txt"][0] == "control-heavy"
    assert got["few.txt"][0] is None
    assert got["sparse.txt"][0] is None
    assert got["empty.txt"] == (None, "utf-8", "")
    hashes = dict(tl.content_hashes(c).select("path", "sha256").collect())
    assert hashes["bom.txt"] == sha(b"\xef\xbb\xbfhi") and "bad.txt" not in hashes


def test_lines(spark):
    c = corpus(spark, {"a": "x\r\ny\nz\rq\n", "b": "", "c": "\r\r\n"})
    assert rows(tl.file_lines(c), "path", "line_no", "line") == [
        ("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z\rq"), ("a", 4, ""), ("b", 1, ""), ("c", 1, "\r"), ("c", 2, "")]
    assert dict(tl.file_facts(c).select("path", "total_lines").collect()) == {"a": 4, "b": 1, "c": 2}


REQ = "request_id bigint, tree_id string, path string, start_line int, max_lines int, expected_sha256 string"


def test_ranges_and_statuses(spark):
    c = binary_corpus(spark, {"safe.txt": b"hello\nworld\n", "bin.txt": b"a\x00b", ".env": b"x", "node_modules/a.js": b"x"})
    asked = [
        (1, "t", "safe.txt", None, 1, None), (2, "t", "./x/../safe.txt", 2, None, None), (3, "t", "safe.txt", 99, 9, None),
        (4, "t", "safe.txt", 1, 1, "0" * 64), (5, "t", "bin.txt", 1, 1, "0" * 64), (6, "t", ".env", None, None, None),
        (7, "t", "node_modules/a.js", None, None, None), (8, "t", "none", None, None, None), (9, "t", "/safe.txt", None, None, None),
        (10, "t", "../safe.txt", None, None, None), (11, "u", "safe.txt", None, None, None), (12, "t", "safe.txt", None, None, sha("hello\nworld\n").upper()),
    ]
    got = {r.request_id: r for r in tl.read_ranges(c, spark.createDataFrame(asked, REQ)).collect()}
    assert len(got) == 12
    assert (got[1].text, got[1].total_lines, got[1].start_line, got[1].end_line) == ("1: hello", 3, 1, 1)
    assert got[1].truncated_after and not got[1].truncated_before
    assert got[2].text == "2: world\n3: " and got[2].truncated_before and not got[2].truncated_after
    assert (got[3].start_line, got[3].text) == (3, "3: ")
    assert (got[4].status, got[4].text, got[4].sha256) == ("hash-mismatch", None, sha("hello\nworld\n"))
    assert [got[i].status for i in (5, 6, 7, 8, 9, 10, 11, 12)] == [
        "binary", "refused-secret", "refused-generated", "not-readable", "absolute-path", "outside-tree", "not-readable", "ok"]
    small = tl.read_ranges(c, spark.createDataFrame(asked[:1], REQ), max_bytes_per_file=5).first()
    assert small.status == "byte-limit-reached"


def test_range_limits(spark):
    c = corpus(spark, {"a": "\n".join(str(i) for i in range(700))})
    asked = [(1, "t", "a", 1, None, None), (2, "t", "a", 1, 9999, None)]
    for limit, shown in ((500, 500), (None, 700)):
        got = tl.read_ranges(c, spark.createDataFrame(asked, REQ), max_range_lines=limit).collect()
        assert {r.request_id: r.end_line for r in got} == {1: 160, 2: shown}


BATCH = "batch_id string, seq bigint, request_id bigint, tree_id string, path string, start_line int, max_lines int, expected_sha256 string"


def _batch(spark, c, asked, **limits):
    requests = spark.createDataFrame([("b", i, i, "t", *a) for i, a in enumerate(asked)], BATCH)
    return {r.seq: r for r in tl.read_batch(c, requests, **limits).collect()}


def test_batch_line_budget(spark):
    c = corpus(spark, {"a.txt": "a1\na2\na3\na4\n", "b.txt": "b1\nb2\nb3\n", ".env": "x"})
    got = _batch(spark, c, [("a.txt", 2, 3, None), (".env", None, 1, None), ("b.txt", None, 3, None), ("a.txt", 1, 1, None)], max_total_lines=4)
    assert got[0].text == "2: a2\n3: a3\n4: a4" and not got[0].line_limit_reached
    assert got[1].status == "refused-secret"
    assert got[2].text == "1: b1" and got[2].line_limit_reached
    assert got[3].status == "line-limit-reached"


def test_batch_byte_budget_counts_mismatches(spark):
    c = corpus(spark, {"a": "a" * 1000, "b": "b" * 1000, "c": "c" * 400})
    got = _batch(spark, c, [("a", None, None, "0" * 64), ("b", None, None, None), ("c", None, None, None)], max_total_bytes=1500)
    assert [got[i].status for i in range(3)] == ["hash-mismatch", "byte-limit-reached", "ok"]


def test_batch_size_limit(spark):
    c = corpus(spark, {"a": "x"})
    got = _batch(spark, c, [("a", None, None, None)] * 3, max_ranges=2)
    assert sorted(got) == [0, 1] and got[0].result_limit_reached
    exact = _batch(spark, c, [("a", None, None, None)] * 2, max_ranges=2)
    assert not exact[0].result_limit_reached


def test_batches_may_share_request_ids_and_ask_for_long_ranges(spark):
    c = corpus(spark, {"a.txt": "\n".join(f"a{i}" for i in range(900)), "b.txt": "b"})
    asked = [("x", 1, 1, "t", "a.txt", 1, 900), ("y", 1, 1, "t", "b.txt", 1, 5)]
    requests = spark.createDataFrame(asked, "batch_id string, seq long, request_id long, tree_id string, path string, start_line long, max_lines long")
    got = {r.batch_id: r for r in tl.read_batch(c, requests).collect()}
    assert len(got) == 2 and (got["x"].start_line, got["x"].end_line) == (1, 900) and got["y"].end_line == 1
    one = tl.read_ranges(c, requests.drop("batch_id", "seq").limit(1), max_range_lines=500).first()
    assert one.end_line == 500
