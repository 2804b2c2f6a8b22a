"""Relative imports of script files and the files they resolve to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P, text as T
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.functions.regex import jvm
from treelens.operators.inventory import KEY, kept
from treelens.operators.reading import readable
from treelens.plans.materialize import measured
from treelens.plans.skew import left_join_spread


def relative_imports(
    c: DataFrame, policy: Policy = DEFAULT_POLICY, granted: str | None = None, max_bytes_per_file: int | None = None
) -> DataFrame:
    """Distinct relative specifiers per file: ``(tree_id, from_path, specifier, language, source_sha256)``."""
    lang = P.language("path")
    files = c.filter(lang.isin(*K.IMPORT_LANGUAGES))
    # Every specifier starts with ./ or ../, so other files need no pattern at all.
    files = files.filter(F.contains(F.col("content").cast("string"), F.lit("./")))
    files = readable(files, policy, max_bytes_per_file)
    if granted:
        head = F.slice(T.split_lines(F.col("text")), F.lit(1), F.col(granted).cast("int"))
        text = F.array_join(head, "\n")
    else:
        text = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))
    nothing = F.array().cast("array<string>")

    def matches(pattern, needed):
        found = F.regexp_extract_all("text", F.lit(jvm(pattern)), F.lit(1))
        return F.when(F.col("text").rlike(jvm(needed)), found).otherwise(nothing)

    # Each pattern runs only on texts that hold the short literal part it needs.
    found = F.array_distinct(F.concat(*(matches(p, n) for p, n in zip(K.IMPORT_PATTERNS, K.IMPORT_NEEDS))))
    return files.withColumn("text", text).select(
        "tree_id",
        F.col("path").alias("from_path"),
        lang.alias("language"),
        T.content_sha256(F.col("content")).alias("source_sha256"),
        F.explode(found).alias("specifier"),
    )


def with_import_path(imports: DataFrame) -> DataFrame:
    """Adds ``import_path``: the specifier joined to the importer's directory.

    It is null when the specifier leaves the tree. A trailing '/' is kept: such a
    specifier can only name an index file.
    """
    directory = P.dirname("from_path")
    joined = F.concat_ws("/", F.when(directory != ".", directory), "specifier")
    rows = imports.withColumn("_segments", P.normalized_segments(joined))
    segs = F.col("_segments")
    base = F.when(F.size(segs) == 0, F.lit(".")).otherwise(F.array_join(segs, "/"))
    tail = F.when(F.endswith(F.col("specifier"), F.lit("/")), "/").otherwise("")
    inside = F.coalesce(F.get(segs, F.lit(0)), F.lit("")) != ".."
    return rows.withColumn("import_path", F.when(inside, F.concat(base, tail))).drop("_segments")


def resolution_index(files: DataFrame) -> DataFrame:
    """``(tree_id, import_path, to_path)``: the file each import path resolves to.

    Built from the files instead of the imports: a file answers to its own path,
    to its path without a known extension and, as an index file, to its directory.
    Where several files answer, the order of the extensions decides. Only the rank is
    aggregated, by hash and before the shuffle; path and rank spell the file's name again.
    """
    path = F.col("path")
    names = [e[1:] for e in K.RESOLVE_EXTENSIONS]
    ending = rf"\.({'|'.join(names)})\z"
    bare = F.regexp_extract(path, rf"(?s)\A(.+){ending}", 1)
    position = F.array_position(F.split(F.lit(",".join(names)), ","), F.regexp_extract(path, ending, 1))
    # index files answer for their directory, written with or without a final '/'
    folder = F.when(path.rlike(rf"(?:^|/)index{ending}"), P.dirname(path))
    index_rank = position + len(names)

    def answer(import_path, rank):
        return F.struct(import_path.alias("import_path"), rank.alias("rank"))

    answers = [
        answer(path, F.lit(0).cast("bigint")),
        answer(F.when(bare != "", bare), position),
        answer(folder, index_rank),
        answer(F.concat(folder, F.lit("/")), index_rank),
    ]
    exploded = files.select("tree_id", "path", F.inline(F.array(*answers))).filter(F.col("import_path").isNotNull())
    best = exploded.groupBy("tree_id", "import_path").agg(F.min("rank").alias("rank"))
    rank = F.col("rank").cast("int")
    extension = F.element_at(F.array(*map(F.lit, names)), F.pmod(rank - 1, F.lit(len(names))) + 1)
    folder = F.regexp_replace("import_path", r"/\z", "")
    index = F.concat(F.when(folder == ".", "").otherwise(F.concat(folder, F.lit("/"))), F.lit("index."), extension)
    to_path = F.when(rank == 0, F.col("import_path")).when(rank <= len(names), F.concat("import_path", F.lit("."), extension)).otherwise(index)
    return best.select("tree_id", "import_path", to_path.alias("to_path"))


def resolve_imports(imports: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``to_path`` (null when nothing in the tree answers).

    The index is written and measured first. One that is too large for a broadcast is joined
    with its hot paths replicated, so a file that most others import does not meet all of them
    in one task.
    """
    index, small = measured(resolution_index(files))
    rows, keys = with_import_path(imports), ["tree_id", "import_path"]
    if small:
        return rows.join(F.broadcast(index), keys, "left").drop("import_path")
    return left_join_spread(rows, index, keys, ["from_path", "specifier"]).drop("import_path")


def import_edges(c: DataFrame, policy: Policy = DEFAULT_POLICY, max_bytes_per_file: int | None = None) -> DataFrame:
    """Import graph of all trees, unresolved specifiers included; files over the size cap are not read."""
    files = kept(c, policy).select(*KEY)
    return resolve_imports(relative_imports(c, policy, max_bytes_per_file=max_bytes_per_file), files)
