import itertools
import posixpath
import random
import re

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import corpus, rows


def found(spark, path, text):
    return rows(tl.symbols(corpus(spark, {path: text})), "line", "kind", "name")


def test_script_symbols(spark):
    text = "\n".join([
        "export async function run ( x ) {}", "export abstract class App {}", "interface Cfg {}", "import type Foo from 'x'", "enum E {}",
        "const a = 1, b = 2", "const re: RegExp = /x/", "// function no() {}", "# class No", "* class Doc", "const {a} = b", "class Foo$ {", "class Fooé {",
        "  class Nb {", "function* gen() {}", "const fn = function named() {}", "class A extends class B {}",
    ])
    got = found(spark, "a.ts", text)
    assert got == sorted([
        (1, "function", "run"), (2, "class", "App"), (3, "interface", "Cfg"), (4, "type", "Foo"), (5, "enum", "E"), (6, "constant", "a"),
        (7, "constant", "re"), (10, "class", "Doc"), (12, "class", "Foo"), (13, "class", "Foo"), (14, "class", "Nb"), (16, "constant", "fn"), (16, "function", "named"),
        (17, "class", "A"),
    ], key=lambda r: tuple(map(str, r)))


def test_python_symbols(spark):
    text = "class Job:\n    def run(self):\n  async def go ():\n# def no():\nx = class_y\nclass A.b\nundef z()\ndef bad"
    assert found(spark, "a.py", text) == [(1, "class", "Job"), (2, "function", "run"), (3, "function", "go"), (6, "class", "A")]


def test_java_symbols(spark):
    text = "\n".join([
        "public final class App {", "public record P(int x) {}", "  public static void main(String[] a) {", "return new Foo(x);", "if (x) for (;;) {}",
        "private Map<String, List<Integer>> get (int a) {", "else if (y) {", "interface I { void f(); }", "  x.call(y);",
    ])
    got = found(spark, "A.java", text)
    assert (1, "class", "App") in got and (2, "record", "P") in got and (3, "method", "main") in got
    assert (4, "method", "Foo") in got and (6, "method", "get") in got and (8, "interface", "I") in got
    assert not any(name in ("if", "for") for _, _, name in got)


def test_java_method_pattern_equals_the_long_form(spark):
    """The library pattern starts with one modifier or space, the definition with many."""
    long_form = re.compile(r"(?:public|protected|private|static|final|synchronized|abstract|\s)+[\w<>\[\], ?]+\s+([A-Za-z_]\w*)\s*\(")
    rng = random.Random(3)
    parts = ["public", "static", "final", " ", "  ", "\t", "\t", "int", "List<X>", "foo", "bar", "(", ")", ",", ".", "[]", "?", "x1", "new"]
    lines = {"".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(3, 12))).strip() for _ in range(3000)}
    lines = sorted(line for line in lines if line and not line.startswith(("//", "#")))
    skip = {"catch", "for", "if", "new", "switch", "while"}
    expected = []
    for i, line in enumerate(lines, 1):
        m = long_form.search(line)
        if m and m.group(1) not in skip:
            expected.append((i, m.group(1)))
    got = tl.symbols(corpus(spark, {"A.java": "\n".join(lines)})).select("line", "name").collect()
    assert sorted((r.line, r.name) for r in got) == expected and len(expected) > 100


def test_symbol_filters_cap_and_unsupported(spark):
    c = corpus(spark, {
        "web/Router.ts": "export class Router {}\nexport enum routeKind { A }\nfunction other() {}\n", "jobs/sync.py": "def sync_routes():\n  class Local:\n",
        "web/routes.java": "final class Routes {\n  private int countRoutes(int x) {}\n}\n", "skin/main.css": "b {}\n", "blob.zzz": "",
    })
    assert rows(tl.symbols(c, query="ROUTE"), "kind", "name") == sorted(
        [("class", "Router"), ("enum", "routeKind"), ("function", "sync_routes"), ("class", "Routes"), ("method", "countRoutes")])
    assert rows(tl.symbols(c, kind="class", path="jobs"), "name") == [("Local",)]
    assert rows(tl.unsupported_languages(c), "language", "files") == [("css", 1), ("unknown", 1)]
    first = tl.symbols(c, max_per_tree=3).collect()
    assert sorted(r.name for r in first) == ["Local", "Router", "sync_routes"] and all(r.symbol_limit_reached for r in first)


def test_import_patterns(spark):
    text = "\n".join([
        "import a from './a'", "import type { B } from \"../b\"", "import './side'", "import {\n  c,\n  d\n} from './multi'", "export * from './e'",
        "export { f } from \"./f\"", "const g = require( './g' )", "const h = await import('./h')", "import x from 'pkg'", "import '.'", "import '..'",
        "reimport './no'", "// import './comment'", "import a from './a'", "export default 1; const z = 'q'",
    ])
    got = rows(tl.relative_imports(corpus(spark, {"src/x.ts": text, "y.py": "import './no'"})), "specifier")
    assert [g[0] for g in got] == sorted(["./a", "../b", "./side", "./multi", "./e", "./f", "./g", "./h", "./comment"])


def _resolve(from_path, spec, files):
    """Plain model of the resolution order."""
    base = posixpath.dirname(from_path)
    norm = posixpath.normpath(posixpath.join(base, spec))
    if norm == ".." or norm.startswith("../"):
        return None
    slash = "/" if spec.endswith("/") else ""
    exts = [".ts", ".tsx", ".js", ".jsx", ".mjs", ".cjs", ".json"]
    candidates = [norm + slash] + [norm + slash + e for e in exts] + [posixpath.normpath(posixpath.join(norm, "index" + e)) for e in exts]
    return next((c for c in candidates if c in files), None)


def test_import_resolution_equals_the_model(spark):
    files = ["index.ts", "a.ts", "a.js", "a/index.js", "a/b.tsx", "a/b/index.json", "a/b", "c/index.ts", "c/index.mjs", "c.json", "c.d.ts", "x/y/z.cjs", "x/.ts", "x/y.ts"]
    specs = ["./a", "./a/", "./a/b", "./a/b/", "../a", "../../a", "./c", "./c.json", "./c/", "./c/../a", "./x/..", "./", "./x/", "./x/y", "../x/y/z", "./c.d", "./none", "./a/./b", "../c/index"]
    froms = ["main.ts", "x/main.ts", "x/y/main.ts"]
    text = "\n".join(f"import '{s}'" for s in specs)
    c = corpus(spark, {**{f: "" for f in files}, **{f: text for f in froms}})
    every = set(files) | set(froms)
    got = {(r.from_path, r.specifier): r.to_path for r in tl.import_edges(c).collect()}
    # './' alone names no path after the slash, so the patterns do not report it
    expected = {(f, s): _resolve(f, s, every) for f in froms for s in specs if s != "./"}
    assert got == expected


def test_related_end_to_end(spark):
    c = corpus(spark, {
        "lib/queue.js": "const b = require('../core/clock')\n", "core/clock.js": "module.exports = 0\n", "lib/queue.css": "a {}\n",
        "spec/queue.spec.js": "import q from '../lib/queue.js'\n", "lib/zip.js": "",
    })
    target = spark.createDataFrame([("t", "lib/queue.js")], "tree_id string, path string")
    every = [
        ("direct-import", "core/clock.js", "../core/clock", "high"), ("imported-by", "spec/queue.spec.js", "../lib/queue.js", "high"),
        ("likely-test", "spec/queue.spec.js", "test naming convention", "medium"), ("same-basename", "lib/queue.css", "same basename as queue.js", "low"),
        ("sibling", "lib/queue.css", "same directory lib", "low"), ("sibling", "lib/zip.js", "same directory lib", "low"),
    ]
    assert rows(tl.related(c, target), "relationship", "path", "evidence", "confidence") == sorted(every)
    assert rows(tl.related(c, target, include_low=False), "relationship") == [("direct-import",), ("imported-by",), ("likely-test",)]
    assert tl.related(c, target, kinds=["direct-import"], include_low=False).count() == 1
    first = tl.related(c, target, max_per_target=1).first()
    assert (first.relationship, first.relationship_limit_reached) == ("direct-import", True)
    ranked = sorted(tl.related(c, target, max_per_target=len(every)).collect(), key=lambda r: r.rank)
    assert not any(r.relationship_limit_reached for r in ranked)
    # the cap keeps discovery order: imports first, then file by file
    assert [(r.relationship, r.path) for r in ranked] == [
        ("direct-import", "core/clock.js"), ("same-basename", "lib/queue.css"), ("sibling", "lib/queue.css"), ("sibling", "lib/zip.js"),
        ("likely-test", "spec/queue.spec.js"), ("imported-by", "spec/queue.spec.js")]
    assert rows(tl.related(c, target, path_prefix="lib/z", extensions=["js"]), "path") == [("lib/zip.js",)]
    grouped = {r.relationship: r for r in tl.grouped_related(tl.related(c, target), 1).collect()}
    assert (grouped["sibling"].relations, grouped["sibling"].paths, grouped["sibling"].paths_limit_reached) == (2, ["lib/queue.css"], True)
    assert not grouped["likely-test"].paths_limit_reached
    with pytest.raises(ValueError):
        tl.related(c, target, kinds=["cousin"])


def test_path_prefix_is_plain_text(spark):
    c = corpus(spark, {"src/a.ts": "", "src2/a.md": "", "lib/a.md": ""})
    target = spark.createDataFrame([("t", "src/a.ts")], "tree_id string, path string")
    assert rows(tl.related(c, target, path_prefix="src/"), "path") == [("src2/a.md",)]


def _is_test_for(target, candidate):
    def split(p):
        name = p.rsplit("/", 1)[-1].lower()
        m = re.search(r"(?s)^.+?(\.[^.]*)$", name)
        ext = m.group(1) if m else ""
        return name, name[: len(name) - len(ext)], ext
    tname, tstem, text = split(target)
    cname, cstem, _ = split(candidate)
    return target != candidate and (
        re.sub(r"(\.test|\.spec|test|spec)$", "", cstem) == tstem or f"{tstem}.test" in cname or f"{tstem}.spec" in cname or cname == f"{tstem}test{text}")


def test_likely_tests_equal_the_substring_rule(spark):
    rng = random.Random(11)
    parts = ["a", "b", "test", "spec", ".", "Test", "-", "x.test", ".ts", ".js", "ab"]
    names = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(260)} | {"foo..x", "foo.test.x", "foo", "footest", "foo.spec"}
    names = {n for n in names if n.strip(".") and not n.endswith("/")}
    paths = sorted({f"{d}{n}" for n, d in zip(sorted(names), itertools.cycle(["", "src/", "tests/"]))})
    c = corpus(spark, {p: "" for p in paths})
    files = tl.kept(c)
    role = dict(tl.classify_files(files).select("path", "role").collect())
    expected = sorted((t, p) for t in role for p in role if role[p] == "test" and _is_test_for(t, p))
    got = sorted((r.target_path, r.path) for r in tl.likely_tests(files, files).select("target_path", "path").collect())
    assert got == expected and len(expected) > 50
    plan = tl.likely_tests(files, files)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_name_groups_count_without_pairs(spark):
    c = corpus(spark, {"a/x.ts": "", "a/y.ts": "", "b/X.md": "", "z": ""})
    assert rows(tl.name_groups(tl.kept(c)), "path", "siblings", "same_basename") == [("a/x.ts", 1, 1), ("a/y.ts", 1, 0), ("b/X.md", 0, 1), ("z", 0, 0)]


def test_granted_lines_limit_symbols_and_imports(spark):
    c = corpus(spark, {"a.ts": "const a = 1\nconst b = 2", "b.ts": "import './a'\nimport './c'", "c.ts": ""})
    facts = tl.file_facts(c)
    granted = tl.scan_budget(facts, max_total_lines=3)
    limited = c.join(granted, ["tree_id", "path"])
    assert rows(tl.symbols(limited, granted="granted_lines"), "name") == [("a",), ("b",)]
    assert rows(tl.relative_imports(limited, granted="granted_lines"), "specifier") == [("./a",)]


def test_tight_line_budget_keeps_the_imports_of_the_target(spark):
    c = corpus(spark, {"m/aa.js": "require('./low')\n1\n", "m/low.js": "2\n", "m/main.js": "import './low'\n3\n4\n"})
    target = spark.createDataFrame([("t", "m/main.js")], "tree_id string, path string")
    tight = tl.budgeted_imports(c, target, max_total_lines=1)
    assert rows(tight, "from_path", "to_path") == [("m/main.js", "m/low.js")]
    assert rows(tl.related(c, target, kinds=["direct-import"], edges=tight), "path", "evidence") == [("m/low.js", "./low")]
    assert rows(tl.budgeted_imports(c, target, max_total_bytes=9_999), "from_path") == [("m/aa.js",), ("m/main.js",)]


def test_target_of_another_language_spends_its_bytes_but_no_lines(spark):
    c = corpus(spark, {"big.py": "x" * 100, "other.py": "y" * 100, "one.ts": "import './b'", "b.ts": ""})
    target = spark.createDataFrame([("t", "big.py")], "tree_id string, path string")
    assert rows(tl.budgeted_imports(c, target, max_total_bytes=105), "from_path") == []
    assert rows(tl.budgeted_imports(c, target, max_total_bytes=112), "from_path", "to_path") == [("one.ts", "b.ts")]
    assert rows(tl.budgeted_imports(c, target, max_total_lines=2), "from_path") == [("one.ts",)]


def test_grouped_sides_above_the_broadcast_limit_give_the_same_rows(spark, monkeypatch):
    c = corpus(spark, {f"m/f{i}.ts": "import './hub'\n" for i in range(60)} | {"m/hub.ts": "", "n/hub.ts": "import '../m/hub'"})
    files = c.select("tree_id", "path")
    expected = rows(tl.import_edges(c), "from_path", "to_path"), rows(tl.name_groups(files))
    monkeypatch.setattr("treelens.plans.materialize.BROADCAST_BYTES", -1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert (rows(tl.import_edges(c), "from_path", "to_path"), rows(tl.name_groups(files))) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_budgeted_symbols_skip_large_files(spark):
    c = corpus(spark, {"a.py": "class A:\n" + "x" * 50, "b.py": "class B:\nclass C:", "c.py": "class D:", "d.css": "y" * 900})
    assert rows(tl.budgeted_symbols(c, max_total_bytes=30), "name") == [("B",), ("C",), ("D",)]
    assert rows(tl.budgeted_symbols(c, max_total_bytes=30, max_total_lines=1), "name") == [("B",)]


def test_display_order_is_locale_order(spark):
    paths = ["_x", "a-b", "a.ts", "A.ts", "a/b", "ab", "B"]
    shown = tl.display_order(corpus(spark, {p: "" for p in reversed(paths)}), "path")
    assert [r.path for r in shown.collect()] == paths
