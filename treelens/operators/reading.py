"""Reading files: decoding, hashes, lines, and batches of line ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P, text as T
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.inventory import KEY, fits, kept
from treelens.plans.keyset import key_filter
from treelens.plans.materialize import materialize, measured, small_side
from treelens.plans.ordered import greedy_fill, running_totals, top_per_group


def decode(c: DataFrame) -> DataFrame:
    """Adds ``refusal``, ``encoding`` and ``text`` (null when refused)."""
    refusal = T.refusal("content", T.is_binary(c))
    return c.select(
        "*",
        refusal.alias("refusal"),
        F.when(refusal.isNull(), T.encoding("content")).alias("encoding"),
        F.when(refusal.isNull(), T.decoded("content")).alias("text"),
    )


def readable(c: DataFrame, policy: Policy = DEFAULT_POLICY, max_bytes_per_file: int | None = None) -> DataFrame:
    """Files that pass policy, size cap and decoding, with ``text`` for ``content``.

    Path and size conditions come first, so they reach the scan and spare the
    content checks for files that are out anyway.
    """
    files = kept(c, policy)
    if max_bytes_per_file is not None:
        files = within_size(files, max_bytes_per_file)
    binary = T.is_binary(c)
    ok = files.filter(T.refusal("content", binary).isNull())
    return ok.withColumn("text", T.decoded("content"))


def within_size(c: DataFrame, max_bytes: int) -> DataFrame:
    return c.filter(F.col("size") <= max_bytes)


def file_facts(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """One narrow row per kept file: size, SHA-256, line count, refusal, encoding."""
    binary = T.is_binary(c)
    refusal = T.refusal("content", binary)
    ok = refusal.isNull()
    return kept(c, policy).select(
        *KEY,
        "size",
        T.content_sha256(F.col("content")).alias("sha256"),
        F.when(ok, T.line_count(F.col("content").cast("string"))).alias("total_lines"),
        refusal.alias("refusal"),
        F.when(ok, T.encoding("content")).alias("encoding"),
    )


def content_hashes(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Full-content SHA-256 of readable files."""
    files = readable(c, policy)
    return files.select(*KEY, "size", T.content_sha256(F.col("content")).alias("sha256"))


def file_lines(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """One row per line, numbered from 1."""
    files = readable(c, policy)
    rows = files.select(*KEY, F.posexplode(T.split_lines(F.col("text"))).alias("pos", "line"))
    return rows.select(*KEY, (F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def validate_paths(requests: DataFrame) -> DataFrame:
    """Requests with ``clean_path`` and ``path_error`` (absolute or escaping paths)."""
    return requests.withColumn("clean_path", P.clean_path("path")).withColumn("path_error", P.path_error("path"))


def read_ranges(
    c: DataFrame,
    requests: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_bytes_per_file: int | None = None,
    max_range_lines: int | None = None,
) -> DataFrame:
    """Answer independent range requests ``(request_id, tree_id, path, start_line,
    max_lines, expected_sha256)``; every request gets one row with a ``status``.

    ``request_id`` must be unique. ``max_range_lines`` bounds what one request may ask for.
    Contents stay where they are scanned if the requests are few or the corpus is a table of
    ``write_corpus``; of another corpus the requested files are shuffled.
    """
    return _answers(_range_rows(c, requests, policy, max_bytes_per_file, max_range_lines), "wanted", ["request_id"])


def read_batch(
    c: DataFrame,
    requests: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_ranges: int | None = None,
    max_total_lines: int | None = None,
    max_total_bytes: int | None = None,
    max_bytes_per_file: int | None = None,
    max_range_lines: int | None = None,
) -> DataFrame:
    """Answer batches of requests that share a line and a byte budget.

    ``requests`` adds ``batch_id`` and ``seq``, unique together; ``request_id`` may repeat. Requests of a batch are served in
    ``seq`` order, at most ``max_ranges`` of them; ``result_limit_reached`` tells
    whether more were asked for. A file that does not fit the bytes left is
    skipped, and every read spends bytes even when its content is refused.
    """
    rows = served_batch(c, requests, policy, max_ranges, max_total_lines, max_total_bytes, max_bytes_per_file, max_range_lines)
    return _answers(rows, "granted", ["batch_id", "seq", "request_id"], ["line_limit_reached", "result_limit_reached"])


def served_batch(
    c, requests, policy=DEFAULT_POLICY, max_ranges=None, max_total_lines=None, max_total_bytes=None, max_bytes_per_file=None, max_range_lines=None
) -> DataFrame:
    """The requests of ``read_batch`` with file facts, selected lines, ``status``, ``granted`` lines, and the ``limit`` that refused bytes.

    The selected lines are written once. Budgets are settled on narrow rows, by ordered
    passes over a batch of any length.
    """
    key = ["batch_id", "seq"]
    if max_ranges is None:
        asked = requests.withColumn("result_limit_reached", F.lit(False))
    else:
        asked = top_per_group(requests, ["batch_id"], [F.col("seq")], max_ranges, ["request_id"], "_rank", "result_limit_reached").drop("_rank")
    rows = materialize(_range_rows(c, asked, policy, max_bytes_per_file, max_range_lines))
    facts = rows.select(*key, "size", "wanted", "status", "reads", (F.col("total_lines") - F.col("start") + 1).alias("_left"))
    too_large = F.lit(False)
    if max_total_bytes is not None:
        fit = greedy_fill(facts.filter("reads").select(*key, "size"), "batch_id", [F.col("seq")], "size", max_total_bytes)
        facts = facts.join(fit.select(*key, F.lit(True).alias("_fits")), key, "left")
        too_large = F.col("reads") & F.col("_fits").isNull()
    ok = (F.col("status") == "ok") & ~too_large
    facts = facts.select(*key, "wanted", "status", too_large.alias("_no_bytes"), ok.alias("_ok"), F.when(ok, F.least("wanted", "_left")).otherwise(F.lit(0)).alias("_shown"))
    spent, left = F.lit(False), F.col("wanted")
    if max_total_lines is not None:
        facts = running_totals(facts, ["batch_id"], [F.col("seq")], {"_upto": F.col("_shown")})
        before = F.col("_upto") - F.col("_shown")
        spent, left = before >= max_total_lines, F.least(F.col("wanted"), F.lit(max_total_lines) - before)
    status = F.when(spent, "line-limit-reached").when(F.col("_no_bytes"), "byte-limit-reached").otherwise(F.col("status"))
    granted = F.when(~spent & F.col("_ok"), left).otherwise(F.lit(0)).cast("bigint")
    cut = spent | (F.col("_ok") & (left < F.col("wanted")))
    limit = F.when(status == "byte-limit-reached", F.when(F.col("_no_bytes"), "maxTotalBytes").otherwise("maxBytesPerFile"))
    grants = facts.select(*key, status.alias("status"), granted.alias("granted"), cut.alias("line_limit_reached"), limit.alias("limit"))
    return rows.drop("status").join(small_side(grants), key)


def _range_rows(c, requests, policy, max_bytes_per_file, max_range_lines=None):
    """Requests with the facts and the selected lines of their files, one row each.

    Few requests (by measured size) are broadcast to the scan of the contents. Many are
    shuffled to the files: the contents of a bucketed corpus stay in place, those of any
    other are first reduced to the files that may be asked for. Which requests no file
    answers is found without reading contents.
    """
    types = {"start_line": "bigint", "max_lines": "bigint", "expected_sha256": "string"}
    for name, kind in types.items():
        value = F.col(name) if name in requests.columns else F.lit(None)
        requests = requests.withColumn(name, value.cast(kind))
    wanted = F.greatest(F.lit(1), F.least(F.coalesce("max_lines", F.lit(K.DEFAULT_RANGE_LINES)), F.lit(max_range_lines)))
    req = requests.select(
        "*", P.clean_path("path").alias("clean"), P.path_error("path").alias("path_error"), wanted.cast("bigint").alias("wanted")
    )
    req, few = measured(req)
    files = kept(c, policy).select("tree_id", F.col("path").alias("clean"), "content", "size", fits(c, max_bytes_per_file).alias("small"))
    at = ["tree_id", "clean"]
    asked, wrong = req.filter(F.col("path_error").isNull()), req.filter(F.col("path_error").isNotNull())
    if few:
        found = files.join(F.broadcast(asked), at)
        names = files.select(*at).join(F.broadcast(asked.select(*at).distinct()), at, "left_semi")
        rest = wrong.unionByName(asked.join(names.distinct(), at, "left_anti"))
    else:
        found = asked.join(files.filter(key_filter(asked, *at)(*at)), at, "left")
        rest = wrong
    small = F.col("small")
    refusal = T.refusal("content", T.is_binary(c))
    read = found.select(
        *req.columns, "size", "small",
        F.when(small, T.content_sha256(F.col("content"))).alias("sha256"),
        F.when(small, refusal).alias("refusal"),
        F.when(small & refusal.isNull(), T.encoding("content")).alias("encoding"),
        F.when(small & refusal.isNull(), T.split_lines(T.decoded("content"))).alias("lines"),
    )
    total = F.when(F.col("lines").isNotNull(), F.size("lines").cast("bigint"))
    begin = F.greatest(F.lit(1), F.least(F.coalesce("start_line", F.lit(1)), total)).cast("bigint")
    selected = F.slice("lines", begin.cast("int"), F.col("wanted").cast("int"))
    picked = read.select(
        *req.columns, "size", "small", "sha256", "refusal", "encoding",
        total.alias("total_lines"), begin.alias("start"), selected.alias("selected"),
    )
    rows = picked.unionByName(rest, allowMissingColumns=True)
    mismatch = F.lower("expected_sha256") != F.col("sha256")
    status = (
        F.when(F.col("path_error").isNotNull(), F.col("path_error"))
        .when(policy.is_secret("clean"), "refused-secret")
        .when(policy.is_generated("clean"), "refused-generated")
        .when(F.col("small").isNull() | (F.col("refusal") == "not-readable"), "not-readable")
        .when(~F.col("small"), "byte-limit-reached")
        .when(F.col("refusal").isNotNull(), F.col("refusal"))
        .when(F.coalesce(mismatch, F.lit(False)), "hash-mismatch")
        .otherwise("ok")
    )
    reads = F.coalesce(F.col("small") & ~F.coalesce(F.col("refusal") == "not-readable", F.lit(False)), F.lit(False))
    return rows.select("*", status.alias("status"), reads.alias("reads"))


def _answers(rows: DataFrame, granted: str, keys: list[str], flags: list[str] = ()) -> DataFrame:
    """Final shape: facts and text of readable ranges, the status of all others."""
    ok = F.col("status") == "ok"
    shown = F.slice("selected", 1, F.col(granted).cast("int"))
    begin, total = F.col("start"), F.col("total_lines")
    last = begin + F.size(shown) - 1
    numbered = F.transform(shown, lambda line, i: F.concat((begin + i).cast("string"), F.lit(": "), line))
    actual = F.when(ok | (F.col("status") == "hash-mismatch"), F.col("sha256"))
    return rows.select(
        *keys,
        "tree_id",
        F.coalesce("clean", "path").alias("path"),
        "status",
        actual.alias("sha256"),
        F.when(ok, F.col("size")).alias("bytes"),
        F.when(ok, total).alias("total_lines"),
        F.when(ok, F.col("encoding")).alias("encoding"),
        F.when(ok, begin).alias("start_line"),
        F.when(ok, last.cast("bigint")).alias("end_line"),
        F.when(ok, begin > 1).alias("truncated_before"),
        F.when(ok, last < total).alias("truncated_after"),
        F.when(ok, F.array_join(numbered, "\n")).alias("text"),
        *flags,
    )
