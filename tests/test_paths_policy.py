import posixpath

import pytest
from pyspark.sql import functions as F

import treelens as tl
from helpers import corpus, rows, values
from treelens.functions import paths as P


def _eval(spark, paths, column):
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return dict(df.select("path", column.alias("v")).collect())


def test_extension_and_stem_edges(spark):
    names = ["a.ts", ".gitignore", "a.", ".a.b", "..a", "x/y.test.ts", "x.y/z", "Dockerfile", "dir.d/.env"]
    ext = _eval(spark, names, P.extension("path"))
    assert ext == {"a.ts": ".ts", ".gitignore": "", "a.": ".", ".a.b": ".b", "..a": ".a", "x/y.test.ts": ".ts",
                   "x.y/z": "", "Dockerfile": "", "dir.d/.env": ""}
    stems = _eval(spark, names, P.stem("path"))
    assert stems == {"a.ts": "a", ".gitignore": ".gitignore", "a.": "a", ".a.b": ".a", "..a": ".", "x/y.test.ts": "y.test",
                     "x.y/z": "z", "Dockerfile": "Dockerfile", "dir.d/.env": ".env"}
    assert _eval(spark, ["a", "b/c", "b/c/d"], P.dirname("path")) == {"a": ".", "b/c": "b", "b/c/d": "b/c"}
    assert _eval(spark, ["fooTest.java", "a.spec.ts", "test.py", "latest.md"], P.test_stem("path")) == {
        "fooTest.java": "foo", "a.spec.ts": "a", "test.py": "", "latest.md": "la"}


@pytest.mark.parametrize(
    "path,role",
    [
        (".github/workflows/ci.yml", "ci"), ("x/.github/workflows/ci.yml", "config"), ("a/.gitlab-ci.yml", "ci"),
        ("package.json", "manifest"), ("a/Dockerfile", "manifest"), ("tests/a.py", "test"), ("a/spec", "test"),
        ("latest.txt", "test"), ("contest.md", "test"), ("a.test.d/b.ts", "source"), ("my-test-file.ts", "test"),
        ("README.md", "doc"), ("docs/app.ts", "doc"), ("a/docs/app.ts", "source"), ("a.json", "config"),
        (".editorconfig", "config"), ("eslint.config.js", "config"), ("a.go", "source"), ("a.bin", "other"), ("x/.md", "other"),
    ],
)
def test_roles(spark, path, role):
    assert _eval(spark, [path], P.role("path")) == {path: role}


def test_languages(spark):
    got = _eval(spark, ["a.TSX", "dockerfile", "x/Dockerfile", "a.kts", "a.unknown", ".js", "b.mjs"], P.language("path"))
    assert got == {"a.TSX": "typescript", "dockerfile": "dockerfile", "x/Dockerfile": "dockerfile", "a.kts": "kotlin",
                   "a.unknown": "unknown", ".js": "unknown", "b.mjs": "javascript"}


def test_policy_classes(spark):
    expected = {
        "src/app.ts": None, ".env": "secret", ".env.local": "secret", ".env.example": None, ".env.example.bak": "secret",
        "a/.env.example/b.ts": None, ".ssh/id_rsa": "secret", "x/.AWS/y": "secret", "certs/a.PEM": "secret", ".pem": None,
        "a/my-private_key.txt": "secret", "a/privatekeys.txt": None, "service.account.json": "secret", "Credentials.yml": "secret",
        "secret.toml": "secret", "secrets.md": None, "node_modules/a.js": "generated", "a/Build/x": "generated", "src/build": None,
        "build": None, "node_modules/.env": "secret", "pods/x": "generated", "a/b.key/c": "secret",
    }
    assert _eval(spark, list(expected), tl.DEFAULT_POLICY.classify("path")) == expected


def test_policy_only_adds(spark):
    c = corpus(spark, {"vendor/pkg.txt": "", "src/app.ts": "", "config/private-token.txt": "", "a.tar.gz": "", "x.gz": "", ".env": ""})
    policy = tl.Policy(ignore_dirs=(" Vendor ",), secret_path_parts=("PRIVATE-token",), secret_extensions=("gz", ".tar.gz"))
    assert values(tl.kept(c, policy), "path") == ["src/app.ts"]


def test_prune_counts_are_topmost_paths(spark):
    c = corpus(spark, {
        "src/app.ts": "", "docs/readme.md": "", ".env": "", ".ssh/id_rsa": "", ".ssh/config": "", "node_modules/pkg/index.js": "",
        "node_modules/other/.env": "", "a/dist/x.js": "", "a/dist/y.js": "", "a/dist.js": "",
    })
    assert rows(tl.policy_counts(c), "policy_class", "skipped") == [("generated", 2), ("secret", 2)]
    report = tl.files_coverage(c).first()
    assert (report.candidate_files, report.skipped_secret, report.skipped_generated, report.partial) == (3, 2, 2, False)


def test_scope_is_a_subtree(spark):
    c = corpus(spark, {"src/a.ts": "", "src2/b.ts": "", "src.ts": "", "src/x/c.md": ""})
    assert values(tl.inventory(c, path="src/"), "path") == ["src/a.ts", "src/x/c.md"]
    assert values(tl.inventory(c, path="src/x/../a.ts"), "path") == ["src/a.ts"]
    assert tl.inventory(c, path="missing").count() == 0
    assert tl.inventory(c, path=".").count() == 4
    assert values(tl.inventory(c, contains="SRC/", extensions=["md"]), "path") == ["src/x/c.md"]
    for bad in ("/etc", "../x", "a/../../b"):
        with pytest.raises(ValueError):
            tl.inventory(c, path=bad)


def test_path_normalisation_equals_posixpath(spark):
    shapes = ["a", "./a", "a/./b", "a//b", "a/../b", "a/b/../../c", "..", "../a", "a/../..", "a/../../b", "x/y/..", ".", "a/", "./"]
    got = _eval(spark, shapes, P.clean_path("path"))
    for shape in shapes:
        norm = posixpath.normpath(shape)
        assert got[shape] == (None if norm == ".." or norm.startswith("../") else norm), shape
    errors = _eval(spark, ["/a", "../a", "a"], P.path_error("path"))
    assert errors == {"/a": "absolute-path", "../a": "outside-tree", "a": None}


def test_walk_caps_and_off_by_one(spark):
    c = corpus(spark, {"a.txt": "1", "b.txt": "2", "c.txt": "3", "z/.env": ""})
    assert values(tl.cap_files(c, 1), "path") == ["a.txt"]
    report = tl.files_coverage(c, max_files=1).first()
    assert report.inventory_limit_reached and report.partial and report.candidate_files == 2 and report.skipped_secret == 0
    assert report.reasons == ["maxFiles"]
    exact = tl.files_coverage(c, max_files=3).first()
    assert not exact.inventory_limit_reached and exact.skipped_secret == 1
    # src/... is walked before src.txt although plain string order is the reverse
    d = corpus(spark, {"src/z.ts": "", "src.txt": "", "src-a": ""})
    assert values(tl.cap_files(d, 1), "path") == ["src/z.ts"]


def test_directory_cap_stops_the_walk(spark):
    c = corpus(spark, {"a/x": "", "b/c/y": "", "d/z": "", "top": "", "node_modules/q/r": ""})
    assert values(tl.directories(c), "directory") == [".", "a", "b", "b/c", "d", "node_modules", "node_modules/q"]
    assert values(tl.directories(c, tl.DEFAULT_POLICY), "directory") == [".", "a", "b", "b/c", "d"]
    assert values(tl.cap_dirs(c, 2), "path") == ["a/x"]
    assert values(tl.cap_dirs(c, 4), "path") == ["a/x", "b/c/y"]
    assert values(tl.cap_dirs(c, 5), "path") == ["a/x", "b/c/y", "d/z", "top"]


def test_caps_nest(spark):
    c = corpus(spark, {f"d{i % 3}/f{i}.txt": "" for i in range(20)})
    seen = [set(values(tl.cap_files(c, n), "path")) for n in (1, 5, 6, 20, 30)]
    assert [len(s) for s in seen] == [1, 5, 6, 20, 20]
    assert all(a <= b for a, b in zip(seen, seen[1:]))


def test_relativize(spark):
    df = spark.createDataFrame([("/r/a", "/r/a/b/c"), ("/r/a/", "/r/a"), ("/r/a", "/r/ab")], "root string, path string")
    assert [r[0] for r in df.select(P.relativize("path", "root")).collect()] == ["b/c", ".", None]
