"""Hot keys, capped joins, listing in rounds, directory fingerprints and stored snapshots."""

import hashlib
import os
import re
import statistics

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import corpus, rows
from treelens.plans import materialize
from treelens.plans.ordered import top_per_group
from treelens.plans.skew import left_join_spread


@pytest.fixture
def plain_shuffles(spark, monkeypatch):
    """No broadcast, no skew join, no coalescing: what a plan does by itself."""
    monkeypatch.setattr(materialize, "BROADCAST_BYTES", 0)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_path_that_most_files_import(spark, plain_shuffles):
    files = {f"src/f{i}.ts": f'import a from "./hub"\nimport b from "./f{i + 1}"\n' + ('import c from "../../out"\n' if i % 2 else "") for i in range(2000)}
    c = corpus(spark, {**files, "src/hub.ts": "x"})
    edges = tl.import_edges(c)
    sizes = [r.n for r in edges.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * statistics.median(sizes)
    got = sorted((r.from_path, r.specifier, r.to_path) for r in edges.collect())
    want = [(p, "./hub", "src/hub.ts") for p in files] + [(f"src/f{i}.ts", f"./f{i + 1}", f"src/f{i + 1}.ts" if i < 1999 else None) for i in range(2000)]
    want += [(f"src/f{i}.ts", "../../out", None) for i in range(1, 2000, 2)]
    assert got == sorted(want)


def test_spread_join_equals_a_left_join(spark):
    left = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    index = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(spark.createDataFrame([(7, 70)], "k long, w long"))
    got = left_join_spread(left, index, ["k"], ["v"])
    assert rows(got) == rows(left.join(index, "k", "left").select(*got.columns))
    assert left_join_spread(left.limit(0), index, ["k"], ["v"]).count() == 0


def test_capped_names_grow_with_the_targets(spark):
    """A tree in which all files share one name."""
    n, k = 400, 3
    files = {f"d{i:03}/index.ts": "" for i in range(n)} | {f"t{i:03}/index.test.ts": "" for i in range(n)}
    c = corpus(spark, files)
    targets = c.filter("path LIKE 'd%'").select("tree_id", "path")
    for find, there in ((tl.same_basename, "d"), (tl.likely_tests, "t")):
        got = find(c, targets, max_per_target=k).collect()
        assert len(got) == n * k and all(r.relationship_limit_reached for r in got)
        by_target = {}
        for r in got:
            by_target.setdefault(r.target_path, []).append((r["rank"], r.path))
        names = sorted(p for p in files if p.startswith(there))
        for target, found in by_target.items():
            assert [p for _, p in sorted(found)] == [p for p in names if p != target][:k]
    some = tl.same_basename(c, targets, max_per_target=n - 1).collect()
    assert len(some) == n * (n - 1) and not any(r.relationship_limit_reached for r in some)
    # Rows that reach the targets, before the cap of each target.
    plan = tl.same_basename(c, targets, max_per_target=k)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan


def test_large_k_has_no_window_over_the_group(spark):
    df = spark.range(100_001).select(F.lit("g").alias("g"), F.col("id"))
    for n, more in ((100_000, True), (100_001, False)):
        top = top_per_group(df, ["g"], [F.col("id").desc()], n, ["id"], "rank", "more")
        windows = re.findall(r"windowspecdefinition\(([^)]*)", top._jdf.queryExecution().optimizedPlan().toString())
        assert all("_range" in w or w.startswith("g#") and "_range" in w for w in windows)
        facts = top.agg(F.count("*"), F.min("rank"), F.max("rank"), F.bool_or("more"), F.bool_and("more"), F.max("id"), F.min("id")).first()
        assert tuple(facts) == (n, 1, n, more, more, 100_000, 100_001 - n)


def test_listing_of_wide_and_deep_trees(spark, tmp_path):
    wide, flat, deep = tmp_path / "wide", tmp_path / "flat", tmp_path / "deep"
    for root in (wide, flat, deep):
        root.mkdir()
    n = 20_000
    for i in range(n):
        os.mkdir(f"{wide}/d{i}")
        os.close(os.open(f"{flat}/f{i}", os.O_CREAT))
    for i in range(0, n, 1000):
        (wide / f"d{i}" / ".x").write_text("a")
    here = deep
    for i in range(40):
        here = here / f"s{i}"
        here.mkdir()
        (here / "f").write_text("b")
    (deep / "link").symlink_to(flat)
    roots = {"wide": str(wide), "flat": str(flat), "deep": str(deep)}
    for slices, limit in ((4, 1500), (8, 10**6)):
        listed = tl.list_tree(spark, roots, slices, entries_per_task=limit)
        got = {r.tree_id: r.n for r in listed.groupBy("tree_id").agg(F.count("*").alias("n")).collect()}
        assert got == {"wide": n // 1000, "flat": n, "deep": 41}
        assert listed.select("tree_id", "path").distinct().count() == sum(got.values())
        assert listed.filter("unread = 'link'").count() == 1 and listed.filter("path like '%.x' and size = 1").count() == n // 1000


def nested(files):
    """Directory fingerprints as the definition says."""
    tree = {}
    for path, sha in files.items():
        at = tree
        *dirs, name = path.split("/")
        for d in dirs:
            at = at.setdefault(d, {})
        at[name] = sha
    out = {}

    def walk(node, place):
        entries = []
        for name, x in node.items():
            entries.append(f"{name}\tdirectory\t{walk(x, f'{place}/{name}' if place != '.' else name)}" if isinstance(x, dict) else f"{name}\tfile\t{x}")
        out[place] = hashlib.sha256("".join(e + "\0" for e in sorted(entries, key=str.encode)).encode()).hexdigest()
        return out[place]

    walk(tree, ".")
    return out


def frame(spark, trees):
    return spark.createDataFrame([(t, p, s) for t, files in trees.items() for p, s in files.items()], "tree_id string, path string, sha256 string")


OLD = {"one": {"a/b/c/x": "1", "a/b/y": "2", "a/z": "3", "q/r": "4", "top": "5", "é/ü": "6"}, "two": {"only/deep/er/f": "1"}, "three": {"k/x": "1"}}
NEW = {"one": {**OLD["one"], "a/b/y": "changed"}, "two": OLD["two"], "three": {"k/x": "1", "n/new": "2"}, "four": {"x": "1"}}


def test_directory_fingerprints(spark):
    for trees in (OLD, NEW):
        got = {(r.tree_id, r.directory): r.fingerprint for r in tl.directory_fingerprint(frame(spark, trees)).collect()}
        assert got == {(t, d): f for t, files in trees.items() for d, f in nested(files).items()}
    assert tl.directory_fingerprint(frame(spark, OLD).limit(0)).count() == 0


def test_equal_sub_trees_are_left_out(spark):
    old, new = frame(spark, OLD), frame(spark, NEW)
    changed = tl.changed_directories(tl.directory_fingerprint(old), tl.directory_fingerprint(new))
    assert rows(changed, "tree_id", "directory") == [("four", "."), ("one", "."), ("one", "a"), ("one", "a/b"), ("three", "."), ("three", "n")]
    every = {(r.tree_id, r.path): r.status for r in tl.diff_files(old, new).collect()}
    pruned = {(r.tree_id, r.path): r.status for r in tl.diff_files(old, new, changed).collect()}
    assert pruned == {k: v for k, v in every.items() if v != "same" or k in {("one", "top"), ("one", "a/z")}}


def test_only_changed_trees_of_a_stored_snapshot_are_read(spark, tmp_path):
    old = tl.write_snapshot(frame(spark, OLD), str(tmp_path / "old"))
    new = tl.write_snapshot(frame(spark, NEW), str(tmp_path / "new"))
    got = tl.diff_changed_trees(old, new, tl.fingerprint_of_hashes(old), tl.fingerprint_of_hashes(new))
    scans = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("dynamicpruning" in s for s in scans)
    every = {(r.tree_id, r.path): r.status for r in tl.diff_files(frame(spark, OLD), frame(spark, NEW)).collect()}
    assert {(r.tree_id, r.path): r.status for r in got.collect()} == {k: v for k, v in every.items() if k[0] != "two"}


def test_scopes_that_are_named(spark):
    c = corpus(spark, {"src/a.ts": "", "node_modules/x/y.js": "", ".env": ""})
    asked = ["src", "src/a.ts", "src/b", "", ".", "node_modules/x", ".env", "../up", "/abs", "src/../src"]
    scopes = spark.createDataFrame([("t", p) for p in asked] + [("gone", ".")], "tree_id string, path string")
    got = {(r.tree_id, r.path): r.status for r in tl.scope_status(c, scopes).collect()}
    want = ["ok", "ok", "missing", "ok", "ok", "refused-generated", "refused-secret", "outside-tree", "absolute-path", "ok"]
    assert got == {("t", p): s for p, s in zip(asked, want)} | {("gone", "."): "missing"}


def test_limits_of_a_search_are_ranked_on_narrow_rows(spark):
    c = corpus(spark, {f"f{i}.txt": "the\n" * 5 + "x" * 400 + " the\n" for i in range(6)})
    got = tl.search(c, "the", max_matches=8, context=1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window" in line and ("content" in line or "text" in line)]
    found = [(r.path, r.line, r["rank"], r.match_limit_reached, len(r.context_before), len(r.context_after)) for r in got.orderBy("rank").collect()]
    assert found == [("f0.txt", n, n, True, int(n > 1), 1) for n in range(1, 7)] + [("f1.txt", n, n + 6, True, int(n > 1), 1) for n in (1, 2)]
    every = tl.search(c, "the", context=1).drop("x")
    assert rows(tl.search(c, "the", max_matches=10**6, context=1).drop("rank", "match_limit_reached")) == rows(every)
