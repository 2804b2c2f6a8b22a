import hashlib
import random

from pyspark.sql import functions as F

import treelens as tl
from helpers import corpus, rows
from treelens.plans.ordered import greedy_fill, running_totals, top_per_group
from treelens.sources.tree import list_tree, read_tree, write_table

SCHEMA = "tree_id string, path string, size bigint"


def _random_files(seed, trees=6, n=60, top=200):
    rng = random.Random(seed)
    return {f"t{t}": [(f"f{i:04d}", rng.choice([0, 1, rng.randint(0, top), rng.randint(0, top // 8)])) for i in range(n)] for t in range(trees)}


def _frame(spark, data):
    flat = [(t, p, s) for t, fs in data.items() for p, s in fs]
    random.Random(0).shuffle(flat)
    return spark.createDataFrame(flat, SCHEMA).repartition(5)


def test_running_totals_across_ranges(spark):
    data = _random_files(1) | {"hot": [(f"h{i:05d}", i % 7) for i in range(3000)]}
    got = running_totals(_frame(spark, data), ["tree_id"], [F.col("path")], {"upto": F.col("size"), "pos": F.lit(1)})
    totals = {(r.tree_id, r.path): (r.upto, r.pos) for r in got.collect()}
    for tree, files in data.items():
        run = 0
        for i, (path, size) in enumerate(files, 1):
            run += size
            assert totals[tree, path] == (run, i)


def test_top_per_group_both_ways(spark, monkeypatch):
    data = _random_files(2)
    df = _frame(spark, data)
    order = [F.col("size"), F.col("path")]
    want = {t: sorted((s, p) for p, s in fs)[:7] for t, fs in data.items()}
    for limit in (100_000, 1):
        monkeypatch.setattr("treelens.plans.ordered.TOP_LIMIT", limit)
        got = top_per_group(df, ["tree_id"], order, 7, ["path"], "rank", "more").collect()
        for tree, expected in want.items():
            mine = sorted((r.rank, r["size"], r.path) for r in got if r.tree_id == tree)
            assert [(s, p) for _, s, p in mine] == expected and [k for k, _, _ in mine] == list(range(1, 8))
        assert all(r.more for r in got)
        whole = top_per_group(df, ["tree_id"], order, 60, ["path"], "rank", "more").collect()
        assert len(whole) == 360 and not any(r.more for r in whole)


def test_top_per_group_limits_before_the_shuffle(spark):
    df = _frame(spark, _random_files(2))
    plan = top_per_group(df, ["tree_id"], [F.col("path")], 5, ["path"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _greedy(files, budget):
    room, out = budget, []
    for path, size in sorted(files):
        if size <= room:
            room -= size
            out.append(path)
    return out


def test_greedy_fill_equals_the_sequential_rule(spark):
    data = _random_files(3) | {"tight": [(f"x{i:03d}", 64 - i % 3) for i in range(40)], "zeros": [(f"z{i}", 0) for i in range(9)]}
    df = _frame(spark, data)
    for budget, group_rows in ((300, 10_000), (300, 3), (1, 0), (0, 0), (1000, 10)):
        got = greedy_fill(df, "tree_id", [F.col("path")], "size", budget, group_rows).collect()
        for tree, files in data.items():
            assert sorted(r.path for r in got if r.tree_id == tree) == sorted(_greedy(files, budget)), (tree, budget, group_rows)


def test_byte_and_line_prefix(spark):
    c = corpus(spark, {"a": "x" * 10, "b": "y" * 10, "c": "z", "A/one": "1\n2\n3"})
    assert rows(tl.byte_prefix(tl.inventory(c), 16), "path") == [("A/one",), ("a",)]
    assert rows(tl.byte_greedy(tl.inventory(c), 16), "path") == [("A/one",), ("a",), ("c",)]
    # locale order: 'a' before 'A/one' before 'b'
    assert rows(tl.line_prefix(tl.file_facts(c), 3), "path", "granted_lines") == [("A/one", 2), ("a", 1)]


def _print(entries):
    digest = hashlib.sha256()
    for e in sorted(entries):
        digest.update(e.encode() + b"\0")
    return digest.hexdigest()


def test_fingerprints_equal_hashlib(spark):
    files = {f"d{i % 5}/f{i}.txt": "x" * (i % 17) for i in range(950)}
    c = corpus(spark, files)
    got = tl.metadata_fingerprint(tl.inventory(c)).first()
    assert got.fingerprint == _print(f"{p}\tfile\t{len(t)}\t\t\t" for p, t in files.items()) and got.entries == 950
    content = tl.content_fingerprint(c.repartition(7)).first()
    assert content.fingerprint == _print(f"{p}\t{hashlib.sha256(t.encode()).hexdigest()}\t" for p, t in files.items())
    stamped = tl.inventory(c).withColumn("mtime", F.timestamp_micros(F.lit(1700000000123456)))
    with_time = tl.metadata_fingerprint(stamped.withColumn("dev", F.lit("7"))).first()
    assert with_time.fingerprint == _print(f"{p}\tfile\t{len(t)}\t1700000000123.456\t7\t" for p, t in files.items())


def test_layered_fingerprint_sees_every_change(spark):
    files = {f"d{i % 5}/f{i}.txt": str(i) for i in range(300)}
    hashes = tl.content_hashes(corpus(spark, files))
    base = tl.layered_fingerprint(hashes).first()
    assert base.entries == 300
    assert tl.layered_fingerprint(hashes.repartition(9)).first() == base
    for change in ({**files, "new": ""}, {**files, "d0/f0.txt": "x"}, {k: v for k, v in files.items() if k != "d1/f1.txt"}):
        assert tl.layered_fingerprint(tl.content_hashes(corpus(spark, change))).first().fingerprint != base.fingerprint


def test_trees_are_isolated(spark):
    one, two = {"a.ts": "import './b'\nconst x = 1", "b.ts": "hit"}, {"a.ts": "hit", "c.ts": "class C {}"}
    both = corpus(spark, one, "p").unionByName(corpus(spark, two, "q"))
    alone = [corpus(spark, one, "p"), corpus(spark, two, "q")]
    target = spark.createDataFrame([("p", "a.ts"), ("q", "a.ts")], "tree_id string, path string")
    jobs = [
        lambda c: tl.search(c, "hit", max_matches=3), lambda c: tl.symbols(c, max_per_tree=1), tl.import_edges, tl.content_fingerprint,
        lambda c: tl.related(c, target.join(c.select("tree_id").distinct(), "tree_id")), tl.dir_rollup, lambda c: tl.files_coverage(c, max_files=1),
        lambda c: tl.read_coverage(c), lambda c: tl.byte_greedy(tl.inventory(c), 20), tl.corpus_map,
    ]
    for job in jobs:
        together = sorted(map(str, job(both).collect()))
        assert together == sorted(str(r) for c in alone for r in job(c).collect())
    prints = dict(tl.content_fingerprint(both).select("tree_id", "fingerprint").collect())
    assert prints["p"] != prints["q"]


def test_snapshot_and_comparison(spark):
    before, after = corpus(spark, {"a": "1", "b": "2", "c": "3"}), corpus(spark, {"a": "1", "b": "x", "d": "4"})
    diff = tl.diff_files(tl.content_hashes(before), tl.content_hashes(after))
    assert rows(diff, "path", "status") == [("a", "same"), ("b", "modified"), ("c", "removed"), ("d", "added")]
    changed = tl.compare_snapshots(tl.content_fingerprint(before), tl.content_fingerprint(after)).first()
    assert changed.changed
    same = tl.compare_snapshots(tl.content_fingerprint(before), tl.content_fingerprint(before)).first()
    assert not same.changed
    snap = tl.snapshot(tl.content_fingerprint(before), tl.read_coverage(before), "content").first()
    assert (snap.fingerprint_kind, snap.complete, snap.fingerprint_scope) == ("content", True, ".")
    small = tl.read_coverage(before, max_bytes_per_file=0)
    part = tl.snapshot(tl.content_fingerprint(tl.within_size(before, 0)), small, "content").first()
    assert (part.fingerprint_kind, part.complete) == ("partial-content", False)


def test_merge_coverage(spark):
    c = corpus(spark, {"a": "1", "b": "22", ".env": ""})
    merged = tl.merge_coverage(tl.files_coverage(c, max_files=1), tl.read_coverage(c, max_bytes_per_file=1)).first()
    assert merged.candidate_files == 4 and merged.inventory_limit_reached and merged.skipped_large == 1
    assert merged.reasons == ["maxBytesPerFile", "maxFiles"] and merged.partial


def test_merge_coverage_adds_language_maps(spark):
    c = corpus(spark, {"a.css": "1", "b.css": "2", "c.sh": "3"})
    report = tl.with_unsupported(tl.files_coverage(c), c)
    counted = report.first().unsupported_languages
    merged = tl.merge_coverage(report, tl.read_coverage(c), report).first()
    assert counted["css"] == 2 and merged.unsupported_languages == {k: 2 * v for k, v in counted.items()}
    assert "unsupported_languages" not in tl.merge_coverage(tl.files_coverage(c), tl.read_coverage(c)).columns


def test_map_outline_and_guidance(spark):
    c = corpus(spark, {
        "WORKFLOW.md": "x", "pyproject.toml": "[a]", ".github/workflows/nightly.yml": "on: push", "CHANGES.md": "y", ".agents/skills/lint.md": "",
        "pkg/core.py": "class Engine:\n  def start(self):\n", "tests/test_core.py": "def test_it():\n", "pkg/deep/er/util.py": "",
    })
    m = tl.corpus_map(c).first()
    assert [x.path for x in m.manifests] == ["pyproject.toml"] and [x.path for x in m.ci] == [".github/workflows/nightly.yml"]
    assert "tests/test_core.py" in [x.path for x in m.tests] and "CHANGES.md" in [x.path for x in m.docs]
    assert m.languages["python"] == 3 and m.total_files == 8 and ".agents/skills" in m.guidance
    assert [(s.kind, s.name) for s in m.symbols] == [("class", "Engine"), ("function", "start"), ("function", "test_it")]
    assert not (m.files_limit_reached or m.symbols_limit_reached or m.directories_limit_reached)
    cut = tl.corpus_map(c, max_listed_files=2, max_listed_symbols=1, max_listed_directories=1).first()
    assert (len(cut.files), len(cut.symbols), len(cut.directories), cut.total_files) == (2, 1, 1, 8)
    assert cut.files_limit_reached and cut.symbols_limit_reached and cut.directories_limit_reached
    o = tl.outline(c, max_files=2, sample=1).first()
    assert o.inventory_limit_reached and len(o.files_sample) == 1 and o.guidance == m.guidance
    deep = rows(tl.dir_roles(corpus(spark, {"a/b/c/d.ts": "", "a/x.ts": "", "top.ts": ""}), 2), "directory", "files")
    assert deep == [("a", 1), ("a/b", 1)]
    assert rows(tl.dir_roles(corpus(spark, {"a/b/c/d/e/f/g/h.ts": ""}), 7), "directory") == [("a/b/c/d/e/f/g",)]


def test_trees_without_kept_files_have_reports(spark):
    c = corpus(spark, {".env": "S=1"}, tree="shut").union(corpus(spark, {"a.py": "x"}, tree="open"))
    assert rows(tl.outline(c), "tree_id") == [("open",), ("shut",)]
    maps = {r.tree_id: r for r in tl.corpus_map(c).collect()}
    assert (maps["shut"].total_files, maps["shut"].files, maps["shut"].languages) == (0, [], {})


def test_read_coverage_honours_filters(spark):
    report = tl.read_coverage(corpus(spark, {"src/a.py": "1", "src/b.py": "2", "x.py": "3"}), path="src").first()
    assert (report.candidate_files, report.scanned_files) == (2, 2)


def test_unsupported_in_coverage(spark):
    c = corpus(spark, {"a.css": "", "b.css": "", "c.ts": ""})
    report = tl.with_unsupported(tl.files_coverage(c), c).first()
    assert report.unsupported_languages == {"css": 2}


def test_read_tree_sees_hidden_names(spark, tmp_path):
    content = {
        ".env": "SECRET", "_u.py": "def f():\n", ".ssh/id_rsa": "k", ".github/workflows/ci.yml": "name: x", "src/__tests__/t.ts": "t",
        "src/a.ts": "class A {}", "deep/er/and/deeper/x.md": "# x", "node_modules/p/i.js": "x",
    }
    for path, text in content.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    (tmp_path / "link.txt").symlink_to(tmp_path / "src/a.ts")
    for slices in (1, 4, 64):
        listed = list_tree(spark, {"t": str(tmp_path)}, slices)
        assert sorted(r.path for r in listed.select("path").collect()) == sorted([*content, "link.txt"])
    c = read_tree(spark, {"t": str(tmp_path), "u": str(tmp_path / "src")})
    got = {(r.tree_id, r.path): r.content for r in c.select("tree_id", "path", "content").collect()}
    assert got["t", ".env"] is None and got["t", ".ssh/id_rsa"] is None and got["t", "node_modules/p/i.js"] is None
    assert bytes(got["t", "_u.py"]) == b"def f():\n" and bytes(got["u", "a.ts"]) == b"class A {}"
    assert got["t", "link.txt"] is None
    assert rows(tl.symbols(c), "tree_id", "name") == [("t", "A"), ("t", "f"), ("u", "A")]
    report = {r.tree_id: r for r in tl.read_coverage(c).collect()}["t"]
    assert (report.skipped_secret, report.skipped_generated, report.skipped_unreadable) == (2, 1, 1)
    assert "link.txt" not in [r.path for r in tl.inventory(c).collect()] and report.candidate_files == 5
    small = read_tree(spark, {"t": str(tmp_path)}, max_bytes=3)
    why = {r.path: r.unread for r in small.collect()}
    assert (why[".env"], why["link.txt"], why["src/a.ts"], why["src/__tests__/t.ts"]) == ("refused", "link", "too-large", None)
    report = tl.read_coverage(small).first()
    assert (report.scanned_files, report.skipped_large, report.skipped_unreadable, report.byte_limit_reached) == (2, 3, 1, True)
    assert {r.path for r in small.filter("content is not null").collect()} == {"src/__tests__/t.ts", "deep/er/and/deeper/x.md"}


def test_tree_ids_keep_their_case(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.md").write_text(name)
    c = read_tree(spark, {"Repo": str(tmp_path / "x"), "repo": str(tmp_path / "y")})
    assert rows(c, "tree_id", "path") == [("Repo", "x.md"), ("repo", "y.md")]


def test_sinks(spark, tmp_path):
    c = corpus(spark, {"a.ts": "class A {}"})
    for kind in ("parquet", "json"):
        write_table(tl.symbols(c), str(tmp_path / kind), kind)
        assert spark.read.format(kind).load(str(tmp_path / kind)).count() == 1


def test_inventory_does_not_read_content(spark, tmp_path):
    write_table(corpus(spark, {"a.ts": "class A {}"}), str(tmp_path / "c"))
    c = tl.read_corpus(spark, str(tmp_path / "c"))
    for df in (tl.inventory(c), tl.policy_counts(c), tl.dir_rollup(c), tl.resolve_imports(tl.relative_imports(c), tl.kept(c).select("tree_id", "path"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        reads = [line for line in plan.splitlines() if "ReadSchema" in line]
        assert reads
    plan = tl.within_size(tl.inventory(c), 5)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1] and "LessThanOrEqual(size,5)" in plan
