"""Literal line search with excerpts, context, caps and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens.functions import paths as P, text as T
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.cuts import Cuts, cuts_of, within_cuts
from treelens.operators.inventory import KEY, before_cut, fits, kept, path_filter, walk_cut
from treelens.operators.reading import readable
from treelens.plans.materialize import materialize, small_side
from treelens.plans.ordered import running_totals, top_per_group


def _check_query(query: str) -> None:
    if not query:
        raise ValueError("query must not be empty")
    if "\n" in query or "\r" in query:
        raise ValueError("multi-line queries are not supported; split the query into lines")


def _has(text: Column, query: str, case_sensitive: bool) -> Column:
    if case_sensitive:
        return F.contains(text, F.lit(query))
    return F.contains(F.lower(text), F.lower(F.lit(query)))


def _clipped(line: Column, number: Column) -> Column:
    return F.struct(
        number.cast("bigint").alias("line"),
        T.clip(line).alias("text"),
        T.is_long(line).alias("text_truncated"),
    )


def _match_rows(files: DataFrame, query: str, case_sensitive: bool, context: int, granted: str | None = None) -> DataFrame:
    """One row per matching line of ``files(tree_id, path, text, size, file_sha256)``.

    Without context the lines are generated and filtered one by one. With context
    the hits are picked inside the array first, so only hit lines and their few
    neighbours become rows and the line array is never copied per line.
    """
    lines = T.split_lines(F.col("text"))
    if granted:
        lines = F.slice(lines, F.lit(1), F.col(granted).cast("int"))
    line = F.col("line")
    extra: list[Column] = []
    if not context:
        rows = files.select(*KEY, "size", "file_sha256", F.posexplode(lines).alias("pos", "line"))
        rows = rows.filter(_has(line, query, case_sensitive))
    else:
        files = files.select(*KEY, "size", "file_sha256", lines.alias("lines"))
        numbered = F.transform("lines", lambda l, i: F.when(_has(l, query, case_sensitive), i))
        hits = F.filter(numbered, lambda i: i.isNotNull())

        def around(i):
            return F.struct(i.alias("pos"), F.get("lines", i).alias("line"), *_neighbours(i, context))

        rows = files.select(*KEY, "size", "file_sha256", F.inline(F.transform(hits, around)))
        extra = [F.col("context_before"), F.col("context_after")]
    return _shown(rows, query, case_sensitive, extra)


def _first_matches(files: DataFrame, query: str, case_sensitive: bool, context: int, max_matches: int) -> DataFrame:
    """The first ``max_matches`` rows of each tree, with ``rank`` and ``match_limit_reached``.

    A file gives at most ``max_matches`` + 1 line numbers, and only these narrow rows are ranked.
    Excerpts and context are built for the lines that are left, where their file is scanned
    again; the lines of a file come to it as one list, so contents are not shuffled.
    """
    lines = T.split_lines(F.col("text"))
    numbered = F.transform(lines, lambda l, i: F.when(_has(l, query, case_sensitive), (i + 1).cast("bigint")))
    first = F.slice(F.filter(numbered, lambda i: i.isNotNull()), 1, max_matches + 1)
    narrow = files.select(*KEY, F.explode(first).alias("line"))
    order = [P.locale_key("path"), F.col("path"), F.col("line")]
    top = top_per_group(narrow, ["tree_id"], order, max_matches, ["path", "line"], "rank", "match_limit_reached")
    # At most max_matches of them.
    picks = top.groupBy(*KEY).agg(F.collect_list(F.struct("line", "rank", "match_limit_reached")).alias("picks"))
    found = files.join(small_side(picks), KEY).select(*KEY, "size", "file_sha256", lines.alias("lines"), "picks")

    def around(pick):
        at = (pick["line"] - 1).cast("int")
        fields = [pick["rank"].alias("rank"), pick["match_limit_reached"].alias("match_limit_reached"), *_neighbours(at, context)]
        return F.struct(at.alias("pos"), F.get("lines", at).alias("line"), *fields)

    rows = found.select(*KEY, "size", "file_sha256", F.inline(F.transform("picks", around)))
    extra = ["context_before", "context_after"] if context else []
    return _shown(rows, query, case_sensitive, [F.col(n) for n in (*extra, "rank", "match_limit_reached")])


def _neighbours(i: Column, context: int) -> list[Column]:
    """Lines of the array ``lines`` before and after position ``i``."""
    if not context:
        return []
    first = F.greatest(F.lit(0), i - context)
    before = F.slice("lines", first + 1, i - first)
    after = F.slice("lines", i + 2, F.lit(context))
    return [
        F.transform(before, lambda l, j: _clipped(l, first + j + 1)).alias("context_before"),
        F.transform(after, lambda l, j: _clipped(l, i + j + 2)).alias("context_after"),
    ]


def _shown(rows: DataFrame, query: str, case_sensitive: bool, extra: list[Column]) -> DataFrame:
    line = F.col("line")
    return rows.select(
        *KEY,
        (F.col("pos") + 1).cast("bigint").alias("line"),
        T.excerpt(line, query, case_sensitive).alias("text"),
        T.is_long(line).alias("text_truncated"),
        "file_sha256",
        F.col("size").alias("bytes"),
        *extra,
    )


def search(
    c: DataFrame,
    query: str,
    case_sensitive: bool = False,
    context: int = 0,
    policy: Policy = DEFAULT_POLICY,
    max_bytes_per_file: int | None = None,
    max_matches: int | None = None,
    expected: DataFrame | None = None,
    fingerprints: DataFrame | None = None,
    **filters,
) -> DataFrame:
    """Matching lines of all trees.

    Filters: ``path`` (scope), ``contains``, ``extensions``. ``max_matches`` keeps
    the first matches of each tree by path and line and adds
    ``match_limit_reached``. With ``expected(tree_id, fingerprint)`` only trees
    whose entry in ``fingerprints`` is equal are searched.
    """
    _check_query(query)
    context = max(0, context)
    # Paths first: contents of files that the policy drops are never looked at. The query
    # has no line break, so a file without it has no matching line.
    files = kept(c, policy).filter(path_filter(**filters)).filter(_has(F.col("content").cast("string"), query, case_sensitive))
    files = readable(files, policy, max_bytes_per_file)
    if expected is not None:
        agreed = expected.join(fingerprints, ["tree_id", "fingerprint"]).select("tree_id")
        files = files.join(small_side(agreed), "tree_id", "left_semi")
    files = files.select(*KEY, "text", "size", T.content_sha256(F.col("content")).alias("file_sha256"))
    if max_matches is None:
        return _match_rows(files, query, case_sensitive, context)
    return _first_matches(files, query, case_sensitive, context, max_matches)


def snapshot_check(expected: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Status per tree of ``expected(tree_id, fingerprint)``: ok or snapshot-mismatch."""
    actual = fingerprints.select("tree_id", F.col("fingerprint").alias("actual"))
    rows = expected.select("tree_id", F.col("fingerprint").alias("expected")).join(actual, "tree_id", "left")
    same = F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))
    return rows.withColumn("status", F.when(same, "ok").otherwise("snapshot-mismatch"))


def matched_files(matches: DataFrame) -> DataFrame:
    """Number of returned matches per file."""
    return matches.groupBy(*KEY).agg(
        F.first("file_sha256").alias("sha256"),
        F.first("bytes").alias("bytes"),
        F.count("*").alias("matches"),
    )


def scan_plan(
    c: DataFrame,
    query: str,
    case_sensitive: bool = False,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    max_bytes_per_file: int | None = None,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    max_matches: int | None = None,
    **filters,
) -> DataFrame:
    """How far a budgeted search gets in each tree: one narrow row per reached file.

    Files are visited by path. A file over the size cap is skipped; the search
    stops before the file that would exceed the bytes or finds no lines left, and
    after the file whose lines are cut or that holds one match too many. Refused
    files spend bytes but no lines.
    """
    _check_query(query)
    files = kept(c, policy).filter(path_filter(**filters))
    if max_files is not None or max_directories is not None:
        files = before_cut(files, walk_cut(c, policy, max_files, max_directories, **filters))
    text = T.decoded("content")
    refusal = T.refusal("content", T.is_binary(c))
    small = fits(c, max_bytes_per_file)
    hits = F.size(F.filter(T.split_lines(text), lambda l: _has(l, query, case_sensitive)))
    has_hit = _has(text, query, case_sensitive)
    reads = small & refusal.isNull()
    facts = files.select(
        *KEY, "size", small.alias("small"), F.when(small, refusal).alias("refusal"),
        F.when(reads, T.line_count(text)).otherwise(F.lit(0)).alias("n_lines"),
        F.when(reads & has_hit, hits).otherwise(F.lit(0)).cast("bigint").alias("n_matches"),
        F.when(reads, T.content_sha256(F.col("content"))).alias("sha256"),
    )
    facts = materialize(facts)  # one pass over the content; the rest is narrow
    small_size = F.when(F.col("small"), F.col("size")).otherwise(F.lit(0))
    rows = running_totals(
        facts, ["tree_id"], [P.locale_key("path"), F.col("path")],
        {"pos": F.lit(1), "bytes_upto": small_size, "lines_upto": F.col("n_lines"), "matches_upto": F.col("n_matches")},
    )
    rows = materialize(rows)
    never = F.lit(False)
    lines_before = F.col("lines_upto") - F.col("n_lines")
    over_bytes = never if max_total_bytes is None else F.col("bytes_upto") > max_total_bytes
    no_lines = never if max_total_lines is None else lines_before >= max_total_lines
    cut_lines = never if max_total_lines is None else F.col("lines_upto") > max_total_lines
    over_matches = never if max_matches is None else F.col("matches_upto") > max_matches
    stop_before = F.when(F.col("small") & (over_bytes | no_lines), F.col("pos") - 1)
    stop_after = F.when(F.col("small") & (cut_lines | over_matches), F.col("pos"))
    ends = rows.groupBy("tree_id").agg(F.min(stop_before).alias("end_before"), F.min(stop_after).alias("end_after"))
    ends = ends.withColumn("end", F.least("end_before", "end_after"))
    # Only a file that was really looked at can be the one that stopped the search.
    looked_at = F.col("end_after").isNull() | (F.col("end_before") < F.col("end_after"))
    refused_next = (F.col("pos") == F.col("end_before") + 1) & looked_at
    reached = rows.join(small_side(ends), "tree_id").withColumn("stopped_at", F.coalesce(refused_next, F.lit(False)))
    granted = F.col("n_lines") if max_total_lines is None else F.least(F.col("n_lines"), F.lit(max_total_lines) - lines_before)
    inside = F.col("end").isNull() | (F.col("pos") <= F.col("end"))
    return reached.filter(inside | F.col("stopped_at")).select(
        *KEY, "size", "small", "refusal", "n_lines", "sha256",
        inside.alias("reached"),
        (inside & F.col("small") & F.col("refusal").isNull()).alias("scanned"),
        F.when(inside, granted).otherwise(F.lit(0)).cast("bigint").alias("granted_lines"),
        (F.col("stopped_at") & over_bytes).alias("byte_stop"),
        ((F.col("stopped_at") & ~over_bytes) | (inside & F.col("small") & cut_lines)).alias("line_stop"),
    )


def plan_cuts(plan: DataFrame) -> Cuts:
    """A ``scan_plan`` as one cut per tree, beside the files it passed over."""
    scanned = F.col("scanned") & (F.col("granted_lines") > 0)
    return cuts_of(plan.filter(scanned).select(*KEY, "granted_lines"), plan.filter(F.col("reached") & ~scanned).select(*KEY))


def budgeted_search(c: DataFrame, query: str, plan: DataFrame | Cuts, case_sensitive: bool = False, context: int = 0,
                    max_matches: int | None = None, policy: Policy = DEFAULT_POLICY, **filters) -> DataFrame:
    """Matches within the files and lines granted by ``scan_plan``.

    The plan's rows name every file. Its ``plan_cuts`` do not: with them the policy and the
    filters of the plan have to be given again, and contents are not shuffled however many
    files a tree has.
    """
    context = max(0, context)
    hit_files = c.filter(_has(F.col("content").cast("string"), query, case_sensitive))
    if isinstance(plan, Cuts):
        files = kept(hit_files, policy).filter(path_filter(**filters)).select(*KEY, "content", "size")
        files = within_cuts(files, plan).withColumn("file_sha256", T.content_sha256(F.col("content")))
    else:
        scanned = plan.filter(F.col("scanned") & (F.col("granted_lines") > 0)).select(*KEY, "granted_lines", F.col("sha256").alias("file_sha256"))
        files = hit_files.select(*KEY, "content", "size").join(small_side(scanned), KEY)
    files = files.withColumn("text", T.decoded("content"))
    matches = _match_rows(files, query, case_sensitive, context, "granted_lines")
    if max_matches is None:
        return matches
    order = [P.locale_key("path"), F.col("path"), F.col("line")]
    return top_per_group(matches, ["tree_id"], order, max_matches, ["path", "line"], "rank", "match_limit_reached")
