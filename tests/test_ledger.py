"""Coverage of scans that stop, against plain sequential models."""

import random

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import BINARY, corpus

SUPPORTED = {".ts", ".js", ".py", ".java"}
SCRIPTS = {".ts", ".js"}


def ext(path):
    return "." + path.rsplit(".", 1)[1]


def language(path):
    return {".ts": "typescript", ".js": "javascript", ".py": "python", ".java": "java", ".md": "markdown", ".css": "css"}[ext(path)]


def trees(spark, seed=3):
    rng = random.Random(seed)
    files = {}
    for t in ("one", "two", "three"):
        for i in range(40):
            kind = rng.choice([".ts", ".ts", ".js", ".py", ".md", ".css"])
            body = "".join(rng.choice([f"class K{i}\n", f"const k{i} = 1\n", "plain\n"] if kind != ".py" else [f"class K{i}:\n", "x\n"]) for _ in range(rng.randint(0, 6)))
            files[t, f"{rng.choice('abc')}/f{i:02}{kind}"] = (b"\0" if rng.random() < 0.1 else b"") + body.encode()
    rows = [(t, p, bytearray(x), len(x)) for (t, p), x in files.items()]
    return files, spark.createDataFrame(rows, BINARY)


def n_symbols(path, lines):
    word = ("class ",) if ext(path) == ".py" else ("class ", "const ")
    return sum(line.startswith(word) for line in lines)


def scan(files, tree, wanted, per_file, total_bytes, total_lines, target=None, most=None):
    """One pass as a loop over the files of a tree."""
    out = dict(scanned=0, bytes=0, unreadable=0, large=False, over=False, lines=False, many=False, other={})
    used_bytes = used_lines = found = 0
    order = sorted(p for t, p in files if t == tree)
    for path in ([target] if target else []) + [p for p in order if p != target]:
        data = files[tree, path]
        if ext(path) not in wanted:
            if path == target:
                used_bytes += len(data) if len(data) <= total_bytes else 0
            else:
                out["other"][language(path)] = out["other"].get(language(path), 0) + 1
            continue
        if used_lines >= total_lines:
            out["lines"] = True
            break
        if len(data) > per_file:
            out["large"] = True
            continue
        if used_bytes + len(data) > total_bytes:
            out["over"] = True
            continue
        used_bytes += len(data)
        if b"\0" in data:
            out["unreadable"] += 1
            continue
        out["scanned"] += 1
        out["bytes"] += len(data)
        lines = data.decode().split("\n")
        taken = lines[: total_lines - used_lines]
        used_lines += len(taken)
        found += n_symbols(path, taken)
        if most is not None and found > most:
            out["many"] = True
        if len(taken) < len(lines):
            out["lines"] = True
        if out["many"] or len(taken) < len(lines):
            break
    return out


def reasons(out, many):
    names = {"large": "maxBytesPerFile", "many": many, "over": "maxTotalBytes", "lines": "maxTotalLines"}
    return sorted(v for k, v in names.items() if out[k])


NONE = 10**9


@pytest.mark.parametrize("limits", [(NONE, NONE, NONE, NONE), (40, NONE, NONE, NONE), (NONE, 200, NONE, NONE), (NONE, NONE, 30, NONE), (NONE, NONE, NONE, 6), (40, 300, 40, 9), (45, 500, 60, 30)])
def test_symbols_coverage_equals_a_loop(spark, limits):
    files, c = trees(spark)
    per_file, total_bytes, total_lines, most = limits
    got = {r.tree_id: r for r in tl.symbols_coverage(c, max_bytes_per_file=per_file, max_total_bytes=total_bytes, max_total_lines=total_lines, max_symbols=most).collect()}
    for tree in ("one", "two", "three"):
        want, r = scan(files, tree, SUPPORTED, per_file, total_bytes, total_lines, most=most), got[tree]
        assert (r.candidate_files, r.scanned_files, r.bytes_scanned, r.skipped_unreadable, r.skipped_large) == (40, want["scanned"], want["bytes"], want["unreadable"], 0)
        assert (r.byte_limit_reached, r.line_limit_reached, r.symbol_limit_reached) == (want["large"] or want["over"], want["lines"], want["many"])
        assert r.reasons == reasons(want, "maxSymbols") and r.unsupported_languages == want["other"]
        assert r.partial == (bool(r.reasons) or want["unreadable"] > 0) == r.coverage_partial


@pytest.mark.parametrize("limits", [(NONE, NONE, NONE), (NONE, 150, NONE), (NONE, NONE, 20), (45, 300, 40), (NONE, NONE, 1)])
def test_related_coverage_equals_a_loop(spark, limits):
    files, c = trees(spark, 4)
    per_file, total_bytes, total_lines = limits
    script = max(p for t, p in files if t == "one" and ext(p) == ".ts" and b"\0" not in files[t, p] and len(files[t, p]) <= 45)
    other = max(p for t, p in files if t == "two" and ext(p) == ".md" and b"\0" not in files[t, p] and len(files[t, p]) <= 45)
    targets = spark.createDataFrame([("one", script), ("two", other)], "tree_id string, path string")
    got = {r.tree_id: r for r in tl.related_coverage(c, targets, max_bytes_per_file=per_file, max_total_bytes=total_bytes, max_total_lines=total_lines, max_relationships=5).collect()}
    for tree, target in (("one", script), ("two", other), ("three", None)):
        want, r = scan(files, tree, SCRIPTS, per_file, total_bytes, total_lines, target), got[tree]
        assert (r.scanned_files, r.scanned_import_files, r.bytes_scanned, r.skipped_unreadable) == (want["scanned"], want["scanned"], want["bytes"], want["unreadable"])
        assert (r.byte_limit_reached, r.line_limit_reached) == (want["large"] or want["over"], want["lines"])
        want["many"] = bool(target) and sum(t == tree and p != target and p[:2] == target[:2] for t, p in files) > 5  # siblings
        assert r.relationship_limit_reached == want["many"] and r.reasons == reasons(want, "maxRelationships")


def test_symbols_coverage_filters_and_inventory(spark):
    c = corpus(spark, {"a/x.ts": "class A\nconst b = 1\n", "a/y.ts": "class B\n", "b/z.py": "class C:\n", "b/s.css": "x\n"})
    one = tl.symbols_coverage(c, max_symbols=1, kind="class", path="a").first()
    assert (one.scanned_files, one.symbol_limit_reached, one.reasons, one.unsupported_languages) == (2, True, ["maxSymbols"], {})
    capped = tl.symbols_coverage(c, max_files=2).first()
    assert (capped.scanned_files, capped.inventory_limit_reached, capped.candidate_files) == (2, True, 3)
    assert tl.symbols_coverage(c.limit(0)).count() == 0


def test_symbol_limit_only_for_one_more(spark):
    c = corpus(spark, {"a.ts": "class A\n"})
    assert not tl.symbols_coverage(c, max_symbols=1).first().symbol_limit_reached
    assert not tl.symbols_coverage(c, max_total_lines=2).first().line_limit_reached
    assert tl.symbols_coverage(c, max_total_lines=1).first().line_limit_reached


def test_batch_coverage(spark):
    c = corpus(spark, {"a.txt": "1\n2\n3\n4", "b.txt": "x" * 50, ".env": "s", "bin.txt": "a\0b"})
    asked = [("a.txt", 2), ("b.txt", 1), (".env", 1), ("bin.txt", 1), ("/x", 1), ("gone", 1), ("a.txt", 3), ("a.txt", 1)]
    rows = [(i, "t", p, 1, n, "k", i) for i, (p, n) in enumerate(asked)] + [(99, "t", "a.txt", 1, 9, "other", 0)]
    requests = spark.createDataFrame(rows, "request_id long, tree_id string, path string, start_line long, max_lines long, batch_id string, seq long")
    free = {r.batch_id: r for r in tl.batch_coverage(c, requests).collect()}
    assert (free["k"].scanned_files, free["k"].bytes_scanned, free["k"].skipped_unreadable, free["k"].reasons, free["k"].partial) == (4, 71, 4, [], True)
    assert (free["other"].scanned_files, free["other"].partial) == (1, False)
    tight = {r.batch_id: r for r in tl.batch_coverage(c, requests, max_ranges=7, max_total_lines=4, max_bytes_per_file=40).collect()}
    k = tight["k"]
    assert (k.scanned_files, k.skipped_unreadable, k.result_limit_reached, k.line_limit_reached, k.byte_limit_reached) == (2, 4, True, True, True)
    assert k.reasons == ["maxBatchRanges", "maxBytesPerFile", "maxTotalLines"]
    spent = {r.batch_id: r for r in tl.batch_coverage(c, requests, max_total_bytes=10).collect()}["k"]
    assert (spent.scanned_files, spent.reasons) == (1, ["maxTotalBytes"])
    wrong = requests.filter("batch_id = 'other'").withColumn("expected_sha256", F.lit("0" * 64))
    assert [(r.scanned_files, r.partial) for r in tl.batch_coverage(c, wrong).collect()] == [(0, False)]


def test_long_batches_are_served_in_order(spark):
    """Budgets over a batch of any length equal a loop; no list of a batch is made."""
    rng = random.Random(5)
    files = {f"f{i}.txt": "line\n" * rng.randint(0, 9) for i in range(30)}
    c = corpus(spark, files)
    asked = [(i, rng.choice(list(files)), rng.randint(1, 6), rng.randint(1, 5)) for i in range(400)]
    requests = spark.createDataFrame([(i, "t", p, s, n, "k", i) for i, p, s, n in asked], "request_id long, tree_id string, path string, start_line long, max_lines long, batch_id string, seq long")
    got = {r.seq: (r.status, r.end_line and r.end_line - r.start_line + 1) for r in tl.read_batch(c, requests, max_total_bytes=2000, max_total_lines=150).collect()}
    lines = spent = 0
    for i, p, s, n in asked:
        size, total = len(files[p]), files[p].count("\n") + 1
        if lines >= 150:
            want = ("line-limit-reached", None)
        elif spent + size > 2000:
            want = ("byte-limit-reached", None)
        else:
            spent += size
            start = min(s, total)
            shown = min(n, 150 - lines, total - start + 1)
            lines += shown
            want = ("ok", shown)
        assert got[i] == want, i
