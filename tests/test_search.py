import random

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import binary_corpus, corpus, rows


def test_case_and_excerpt(spark):
    long = "a" * 400 + "Needle" + "b" * 400
    c = corpus(spark, {"a.txt": f"Alpha\nalpha\n{long}"})
    assert rows(tl.search(c, "alpha"), "line") == [(1,), (2,)]
    assert rows(tl.search(c, "alpha", case_sensitive=True), "line") == [(2,)]
    hit = tl.search(c, "needle").first()
    assert hit.text_truncated and len(hit.text) == 326 and "Needle" in hit.text
    assert hit.text.startswith("...") and hit.text.endswith("...")


def _model(line, query):
    if len(line) <= 320:
        return line
    half = max(0, 320 - len(query)) // 2
    start = max(0, line.lower().index(query.lower()) - half)
    if start + 320 > len(line):
        start = max(0, len(line) - 320)
    end = min(len(line), start + 320)
    return ("..." if start else "") + line[start:end] + ("..." if end < len(line) else "")


def test_excerpt_window_positions(spark):
    cases = {f"f{i}": "x" * pos + "KEY" + "y" * rest for i, (pos, rest) in enumerate(
        [(0, 317), (0, 318), (0, 500), (100, 500), (158, 400), (159, 400), (500, 0), (500, 10), (500, 200), (317, 0), (318, 0)])}
    got = dict(tl.search(corpus(spark, cases), "key").select("path", "text").collect())
    assert got == {k: _model(v, "key") for k, v in cases.items()}


def test_literal_queries_and_bad_queries(spark):
    c = corpus(spark, {"a": "f(x) [a-z]*\nfx"})
    assert rows(tl.search(c, "[a-z]*"), "line") == [(1,)]
    for bad in ("", "a\nb", "a\r"):
        with pytest.raises(ValueError):
            tl.search(c, bad)


def test_filters_and_context(spark):
    c = corpus(spark, {"aaa.txt": "hit", "src/app.ts": "one\ntwo\nhit\nfour\nfive", "docs/app.md": "hit", "src/app.js": "hit"})
    found = tl.search(c, "hit", path="src", extensions=[".TS"], context=1).collect()
    assert [(r.path, r.line) for r in found] == [("src/app.ts", 3)]
    assert [tuple(x) for x in found[0].context_before] == [(2, "two", False)]
    assert [tuple(x) for x in found[0].context_after] == [(4, "four", False)]
    edges = tl.search(corpus(spark, {"a": "hit\nhit\nz"}), "hit", context=9).orderBy("line").collect()
    assert [len(r.context_before) for r in edges] == [0, 1] and [len(r.context_after) for r in edges] == [2, 1]


def test_match_cap_flags_only_real_overflow(spark):
    c = corpus(spark, {"a": "hit", "b": "hit"})
    two = tl.search(c, "hit", max_matches=2).collect()
    assert len(two) == 2 and not any(r.match_limit_reached for r in two)
    one = tl.search(c, "hit", max_matches=1).collect()
    assert [(r.path, r.match_limit_reached) for r in one] == [("a", True)]


def test_refused_files_and_coverage(spark):
    c = binary_corpus(spark, {"text.txt": b"nothing", "binary.txt": b"needle\x00", "big.txt": b"needle" * 10})
    plan = tl.scan_plan(c, "needle", max_bytes_per_file=50)
    matches = tl.budgeted_search(c, "needle", plan, max_matches=5)
    report = tl.search_coverage(c, plan, matches).first()
    assert matches.count() == 0
    assert (report.skipped_unreadable, report.skipped_large, report.scanned_files, report.partial) == (1, 1, 1, True)
    assert report.byte_limit_reached and report.reasons == ["maxBytesPerFile"]


def test_line_budget_cuts_a_file(spark):
    c = corpus(spark, {"a": "one\ntwo\nneedle\nfour\n"})
    plan = tl.scan_plan(c, "needle", max_total_lines=1)
    assert tl.budgeted_search(c, "needle", plan).count() == 0
    report = tl.search_coverage(c, plan, tl.budgeted_search(c, "needle", plan)).first()
    assert report.line_limit_reached and report.partial


def _simulate(files, query, per_file, total_bytes, total_lines, max_matches):
    """Sequential scan of one tree: the rules the budgeted search must equal."""
    used, lines_used, matches, flags = 0, 0, [], set()
    scanned, large = [], 0
    for path in sorted(files):
        text = files[path]
        if len(text) > per_file:
            large += 1
            continue
        if used + len(text) > total_bytes:
            flags.add("bytes")
            break
        if lines_used >= total_lines:
            flags.add("lines")
            break
        used += len(text)
        scanned.append(path)
        every = text.split("\n")
        got = every[: total_lines - lines_used]
        lines_used += len(got)
        if len(got) < len(every):
            flags.add("lines")
        over = False
        for i, line in enumerate(got):
            if query in line:
                if len(matches) >= max_matches:
                    flags.add("matches")
                    over = True
                    break
                matches.append((path, i + 1))
        if over or len(got) < len(every):
            break
    return matches, scanned, large, flags


def test_budgeted_search_equals_a_sequential_scan(spark):
    rng = random.Random(5)
    trees, limits = {}, dict(per_file=60, total_bytes=120, total_lines=25, max_matches=6)
    for t in range(40):
        words = rng.choice([["hit", "x", "", "hit hit"], ["xxxxxxxx", "hit", "yyyyyyyy"], ["x", "", "y"]])
        trees[f"t{t}"] = {
            f"f{i:02d}": "\n".join(rng.choice(words) for _ in range(rng.randint(0, 14))) for i in range(rng.randint(1, 14))
        }
    data = [(t, p, c, len(c)) for t, fs in trees.items() for p, c in fs.items()]
    c = spark.createDataFrame(data, "tree_id string, path string, content string, size bigint")
    plan = tl.scan_plan(c, "hit", max_bytes_per_file=60, max_total_bytes=120, max_total_lines=25, max_matches=6)
    matches = tl.budgeted_search(c, "hit", plan, max_matches=6).collect()
    reports = {r.tree_id: r for r in tl.search_coverage(c, plan, tl.budgeted_search(c, "hit", plan, max_matches=6)).collect()}
    reasons = set()
    for tree, files in trees.items():
        want, scanned, large, flags = _simulate(files, "hit", **limits)
        assert sorted((r.path, r.line) for r in matches if r.tree_id == tree) == sorted(want), tree
        report = reports[tree]
        assert (report.scanned_files, report.skipped_large) == (len(scanned), large), tree
        assert report.line_limit_reached == ("lines" in flags), (tree, flags)
        assert report.byte_limit_reached == ("bytes" in flags or large > 0), (tree, flags)
        assert report.match_limit_reached == ("matches" in flags), (tree, flags)
        reasons |= flags
    assert reasons == {"lines", "bytes", "matches"}


def test_matched_files(spark):
    c = corpus(spark, {"a": "hit\nhit\nx", "b": "hit"})
    assert rows(tl.matched_files(tl.search(c, "hit")), "path", "matches", "bytes") == [("a", 2, 9), ("b", 1, 3)]


def test_expected_fingerprints(spark):
    c = corpus(spark, {"a": "hit"}).unionByName(corpus(spark, {"a": "hit"}, "u"))
    prints = tl.metadata_fingerprint(tl.inventory(c)).select("tree_id", "fingerprint")
    stale = prints.withColumn("fingerprint", F.when(F.col("tree_id") == "u", "0").otherwise(F.col("fingerprint")))
    assert rows(tl.snapshot_check(stale, prints), "tree_id", "status") == [("t", "ok"), ("u", "snapshot-mismatch")]
    assert rows(tl.search(c, "hit", expected=stale, fingerprints=prints), "tree_id") == [("t",)]
