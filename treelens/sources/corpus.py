"""Corpus frames: ``(tree_id, path, content, size[, mtime, dev, ino, unread])``, one row per file.

``unread`` (null: read) says why a file has no content; rows with 'link' are links, not files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from treelens.functions.text import byte_length


def corpus(df: DataFrame, tree_id="tree_id", path="path", content="content", *extra: str) -> DataFrame:
    """Shape any table into a corpus; ``size`` is the byte length when absent."""
    size = F.col("size").cast("bigint") if "size" in df.columns else byte_length(F.col(content))
    optional = [c for c in ("mtime", "dev", "ino", "unread") if c in df.columns and c not in extra]
    return df.select(
        F.col(tree_id).cast("string").alias("tree_id"),
        F.col(path).alias("path"),
        F.col(content).alias("content"),
        size.alias("size"),
        *optional,
        *extra,
    )


def read_corpus(spark: SparkSession, location: str, **columns: str) -> DataFrame:
    """Corpus from a Parquet table."""
    return corpus(spark.read.parquet(location), **columns)


def write_corpus(c: DataFrame, table: str, buckets: int, location: str | None = None, mode: str = "error") -> DataFrame:
    """Write a corpus as a table bucketed and sorted by ``(tree_id, path)``, and read it back.

    Joins on these keys shuffle their other side only: requests, budgets and hashes come to
    the bucket of a file, and contents stay where they are written. Choose ``buckets`` so
    that one of them fits a task (about 1 GB). Contents are shuffled once, here.
    """
    keyed = c.repartition(buckets, "tree_id", "path")  # the hash of the buckets: one file each
    writer = keyed.write.format("parquet").bucketBy(buckets, "tree_id", "path").sortBy("tree_id", "path").mode(mode)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return read_corpus_table(c.sparkSession, table)


def read_corpus_table(spark: SparkSession, table: str, *extra: str) -> DataFrame:
    """Corpus from a table that ``write_corpus`` wrote; its buckets are known to the optimizer."""
    return corpus(spark.table(table), "tree_id", "path", "content", *extra)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree per source, one text file per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt"))
    return corpus(docs.select(F.col("source").alias("tree_id"), path.alias("path"), F.col("text").alias("content")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree per host, one file per page."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    path = F.concat(F.lit("pages/"), "page_id", F.lit(".html"))
    return corpus(rows.select(host.alias("tree_id"), path.alias("path"), F.col("html").alias("content")))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree per conversation, one file per turn."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    path = F.concat("role", F.lit("/"), "turn", F.lit(".txt"))
    return corpus(
        rows.select(F.col("conv_id").cast("string").alias("tree_id"), path.alias("path"), F.col("text").alias("content"))
    )


# Shape of the derived code files, by n % 10 with n = doc_id div 20.
_CODE_PATH = """CASE n % 10
  WHEN 0 THEN concat('src/mod', n, '.ts')
  WHEN 1 THEN concat('src/mod', n - 1, '.test.ts')
  WHEN 2 THEN concat('lib/util', n, '.js')
  WHEN 3 THEN concat('tools/job', n, '.py')
  WHEN 4 THEN concat('app/Main', n, '.java')
  WHEN 5 THEN concat('docs/mod', n - 5, '.md')
  WHEN 6 THEN concat('node_modules/pkg', n, '/index.js')
  WHEN 7 THEN concat('conf/env', n, '/.env')
  WHEN 8 THEN concat('.github/workflows/ci', n, '.yml')
  ELSE concat('pkg', n, '/package.json') END"""
_CODE_HEAD = """CASE kind
  WHEN 0 THEN concat('import { u } from "../lib/util', n + 2, '"\\nexport const mod', n, ' = 1\\nexport class Mod', n, ' {}\\n')
  WHEN 1 THEN concat('import { m } from "./mod', n - 1, '"\\n')
  WHEN 2 THEN concat('export function util', n, '(a) {\\n')
  WHEN 3 THEN concat('class Job', n, ':\\n    def run(self):\\n')
  WHEN 4 THEN concat('public class Main', n, ' {\\n  public void start() {}\\n')
  ELSE '' END"""


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code-shaped files derived from every row of ``documents``.

    Ten kinds of files take turns within each source: TypeScript, its tests,
    JavaScript, Python, Java, docs, generated and secret files, CI and manifests.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "doc_id", "source AS tree_id", "doc_id div 20 AS n", "text"
    )
    # The one-element inline keeps path a plain column, as in a stored corpus:
    # path predicates do not repeat the CASE, and run before any content predicate.
    rows = docs.selectExpr("*", f"inline(array(struct({_CODE_PATH} AS path, n % 10 AS kind)))")
    rows = rows.selectExpr("doc_id", "tree_id", "path", f"concat({_CODE_HEAD}, text) AS content")
    return rows.selectExpr("tree_id", "path", "content", "cast(octet_length(content) AS bigint) AS size", "doc_id")


# Shape of the varied files, by n % 10 with n = doc_id div 20.
_VARIED_PATH = """CASE n % 10
  WHEN 0 THEN concat('web/a', n, '/index.ts')
  WHEN 1 THEN concat('web/a', n - 1, '/part.ts')
  WHEN 2 THEN concat('lib/k', n, '/index.js')
  WHEN 3 THEN concat('svc/Main', n, '.java')
  WHEN 4 THEN concat('bin/blob', n, '.ts')
  WHEN 5 THEN concat('bin/ctrl', n, '.TXT')
  WHEN 6 THEN concat('Notes/Bom', n, '.MD')
  WHEN 7 THEN concat('src/contest', n, '.py')
  WHEN 8 THEN concat('.GitHub/workflows/x', n, '.YML')
  ELSE concat('test/a', n - 9, '/index.test.ts') END"""
_VARIED_HEAD = """CASE kind
  WHEN 0 THEN concat('export interface Shape', n, ' {}\r\nexport type Alias', n, ' = string\r\nexport enum Color', n, ' { A }\r\n',
    'import type x from "./part"\r\nexport { y } from "../a', n, '/part"\r\nimport a,\r\n  { b } from "./part.ts"\r\n')
  WHEN 1 THEN concat('const z = require( "./index" )\nimport("../missing")\nimport w from "./"\nabstract class Part', n, ' {}\n')
  WHEN 2 THEN concat('import q from "../../web/a', n - 2, '"\nexport * from "../../../outside"\nasync function go', n, ' () {}\n')
  WHEN 3 THEN concat('public record Point', n, '(int x) {}\nenum Kind', n, ' { A }\ninterface Api', n, ' {}\n  protected static int go', n,
    ' (int a) { return new Foo(a); }\n// class Hidden\n')
  WHEN 4 THEN concat('class Gone', n, ' {}\nimport g from "./gone"\n', char(0), '\n')
  WHEN 5 THEN concat(repeat(char(1), 20), substr(text, 1, 100), '\n\n')
  WHEN 6 THEN concat('\uFEFF', '# title\r\nlone\rreturn\r\n')
  WHEN 7 THEN concat('async  def run', n, ' (self):\n# class Comment\n\u00A0class Wide', n, ':\n')
  WHEN 9 THEN concat('import i from "../../web/a', n - 9, '/index"\nimport "./index.test"\n')
  ELSE '' END"""


def varied_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every branch, one per row of ``documents``: all symbol kinds, import forms, line ends, BOM, binary and control-heavy content, repeated names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("source AS tree_id", "doc_id div 20 AS n", "text")
    rows = docs.selectExpr("*", f"inline(array(struct({_VARIED_PATH} AS path, n % 10 AS kind)))")
    body = "CASE WHEN kind = 5 THEN '' ELSE text END"
    return corpus(rows.selectExpr("tree_id", "path", f"concat({_VARIED_HEAD}, {body}) AS content"))


def moderated_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later snapshot of ``code_files``: toxic files removed, low quality ones edited."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    files = code_files(spark, sf_dir).join(labels, "doc_id", "left")
    files = files.filter(F.coalesce("toxic", F.lit(0)) == 0)
    edited = F.when(F.col("quality") == 0, F.concat("content", F.lit("edited"))).otherwise(F.col("content"))
    rows = files.select("doc_id", "tree_id", "path", edited.alias("content"))
    return corpus(rows, "tree_id", "path", "content", "doc_id")
