"""Plans that leave file contents where they are scanned, and the same rows on every path."""

import re

import pytest
from pyspark.sql import functions as F

import treelens as tl
from treelens.plans import keyset, materialize

FILES = {
    **{f"src/mod{i}.ts": f'import {{ u }} from "./mod{i + 1}"\nexport const mod{i} = 1\nthe {i}\nlast the\n' for i in range(30)},
    **{f"lib/job{i}.py": f"class Job{i}:\n    def run(self):\n        the\n" + "x\n" * i for i in range(30)},
    "docs/a.md": "the doc\n", "conf/.env": "the secret\n", "node_modules/x/index.js": "the\n", "bin.dat": "a\0the",
}


def plain(spark):
    rows = [(t, p, x, len(x.encode())) for t in ("one", "two") for p, x in FILES.items() if t == "one" or "1" not in p]
    return spark.createDataFrame(rows, "tree_id string, path string, content string, size bigint")


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    c = tl.write_corpus(plain(spark), "exchange_free_corpus", 4, location=str(tmp_path_factory.mktemp("corpus") / "t"))
    yield c
    spark.sql("DROP TABLE exchange_free_corpus")


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(materialize, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def content_exchanges(df):
    """Exchanges above a scan that reads contents, and the number of such scans in the plan."""
    above, found, scans = [], [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        body = line.lstrip(" :+-")
        depth = len(line) - len(body)
        body = re.sub(r"^\*?\(\d+\) ", "", body)
        while above and above[-1][0] >= depth:
            above.pop()
        if "Scan" in body and re.search(r"ReadSchema: struct<[^>]*content", body) or ("Scan ExistingRDD" in body and "content#" in body):
            scans += 1
            found += [b for _, b in above if b.startswith("Exchange") or b.startswith("BroadcastExchange")]
        above.append((depth, body))
    return found, scans


def requests(spark):
    rows = [(i, t, p, i % 4, 2, None) for i, (t, p) in enumerate((t, p) for t in ("one", "two") for p in FILES)]
    rows += [(1000, "one", "/etc/x", 1, 1, None), (1001, "one", "../x", 1, 1, None), (1002, "one", "gone.ts", 1, 1, None), (1003, None, "src/mod0.ts", 1, 1, None)]
    rows += [(1004, "one", "./src/../src/mod3.ts", 2, None, "0" * 64), (1005, "three", "src/mod0.ts", 1, 1, None)]
    return spark.createDataFrame(rows, "request_id bigint, tree_id string, path string, start_line bigint, max_lines bigint, expected_sha256 string")


def batches(spark):
    return requests(spark).withColumn("batch_id", F.col("request_id") % 3).withColumn("seq", F.col("request_id") * 7 % 5003)


LIMITS = dict(max_total_bytes=900, max_total_lines=25)
BATCH = dict(max_ranges=15, max_total_bytes=500, max_total_lines=12, max_bytes_per_file=80)


def targets(spark):
    return spark.createDataFrame([("one", "src/mod7.ts"), ("two", "src/mod20.ts")], "tree_id string, path string")


def plan(c):
    return tl.scan_plan(c, "the", max_bytes_per_file=90, max_total_bytes=1500, max_total_lines=60)


WAYS = {
    "read_ranges": lambda s, c: tl.read_ranges(c, requests(s)),
    "read_batch": lambda s, c: tl.read_batch(c, batches(s), **BATCH),
    "range_fingerprint": lambda s, c: tl.fingerprint_of_hashes(tl.read_ranges(c, requests(s)).filter("status = 'ok'").select("tree_id", "path", "sha256", F.concat_ws("-", "start_line", "end_line").alias("range"))),
    "search_budgeted": lambda s, c: tl.budgeted_search(c, "the", tl.plan_cuts(plan(c))),
    "symbols_budgeted": lambda s, c: tl.budgeted_symbols(c, **LIMITS),
    "budgeted_imports": lambda s, c: tl.budgeted_imports(c, targets(s), **LIMITS).drop("to_path"),
}


def rows(df):
    return sorted(map(repr, (r.asDict(True) for r in df.collect())))


@pytest.mark.parametrize("name", sorted(WAYS))
def test_same_rows_without_an_exchange_of_contents(spark, bucketed, no_broadcast, monkeypatch, name):
    got = WAYS[name](spark, bucketed)
    found, _ = content_exchanges(got)
    assert not found
    shuffled = rows(got)
    assert rows(WAYS[name](spark, plain(spark))) == shuffled  # contents are shuffled, rows are the same
    monkeypatch.undo()
    small = WAYS[name](spark, bucketed)
    assert not content_exchanges(small)[0]
    assert rows(small) == shuffled and len(shuffled) > 1


def test_plans_are_read_right(spark, bucketed, no_broadcast):
    found, scans = content_exchanges(bucketed.groupBy("tree_id").agg(F.max("content")))
    assert scans == 1 and len(found) == 1
    joined = bucketed.join(requests(spark).select("tree_id", "path"), ["tree_id", "path"])
    assert content_exchanges(joined) == ([], 1)


def test_cuts_of_many_files_are_small(spark, bucketed, monkeypatch):
    """Rows per file would not be broadcast, one row per tree is; no bucket is needed."""
    want = rows(tl.budgeted_symbols(bucketed, max_total_lines=150))
    monkeypatch.setattr(materialize, "BROADCAST_BYTES", 600)
    got = tl.budgeted_symbols(plain(spark), max_total_lines=150)
    assert not content_exchanges(got)[0] and rows(got) == want


def test_key_filter(spark):
    keys = spark.range(500).select((F.col("id") * 3).alias("k"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("s"))
    every = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    maybe = keyset.key_filter(keys, "k", "s", bits=16)
    left = {r.k for r in every.filter(maybe("k", "s")).collect()}
    assert left >= {3 * i for i in range(0, 500, 2)} and len(left) < 1500
    assert every.filter(keyset.key_filter(keys.limit(0), "k", bits=10)("k")).count() == 0
