"""Symbol extraction by line patterns for scripts, Python and Java."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P, text as T
from treelens.functions.paths import any_of
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.functions.regex import WHITESPACE_CHARS, jvm
from treelens.operators.inventory import KEY, kept, path_filter
from treelens.operators.reading import readable
from treelens.plans.ordered import top_per_group

ORDER = ("line", "kind", "name")


def _found(kind: Column | str, pattern: str, group: int = 1) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), F.regexp_extract("line", jvm(pattern), group).alias("name"))


def _may_hold_symbol(language: Column) -> Column:
    """Cheap substring test that drops most lines before any pattern runs."""
    line = F.col("line")

    def has(*words):
        return any_of(*(F.contains(line, F.lit(w)) for w in words))

    return (
        F.when(language == "python", has("class", "def"))
        .when(language == "java", has("class", "interface", "enum", "record", "("))
        .otherwise(has("function", "class", "interface", "type", "enum", "const"))
    )


def symbols(
    c: DataFrame,
    kind: str | None = None,
    query: str | None = None,
    max_per_tree: int | None = None,
    policy: Policy = DEFAULT_POLICY,
    granted: str | None = None,
    max_bytes_per_file: int | None = None,
    **filters,
) -> DataFrame:
    """Symbols of all trees, one row per (line, kind).

    ``granted`` names a column with the number of leading lines to scan (see
    ``budgets.scan_budget``). Filters on kind and name apply before the cap.
    """
    lang = P.language("path")
    files = c.filter(lang.isin(*K.SYMBOL_LANGUAGES)).filter(path_filter(**filters))
    files = readable(files, policy, max_bytes_per_file).withColumn("language", lang)
    lines = T.split_lines(F.col("text"))
    if granted:
        lines = F.slice(lines, F.lit(1), F.col(granted).cast("int"))
    rows = files.select(
        *KEY, "language", T.content_sha256(F.col("content")).alias("source_sha256"), F.posexplode(lines).alias("pos", "raw")
    )
    rows = rows.select(
        *KEY, "language", "source_sha256", (F.col("pos") + 1).cast("bigint").alias("line_no"),
        F.btrim("raw", F.lit(WHITESPACE_CHARS)).alias("line"),
    )
    line = F.col("line")
    comment = F.startswith(line, F.lit("//")) | F.startswith(line, F.lit("#"))
    rows = rows.filter(_may_hold_symbol(F.col("language")) & ~comment)

    java_kind = F.regexp_extract("line", jvm(K.JAVA_TYPE), 1)
    method = F.regexp_extract("line", jvm(K.JAVA_METHOD), 1)
    java_method = F.struct(
        F.lit("method").alias("kind"),
        F.when(method.isin(*K.JAVA_NOT_METHODS), F.lit("")).otherwise(method).alias("name"),
    )
    found = (
        F.when(F.col("language") == "python", F.array(*(_found(k, p) for k, p in K.PYTHON_SYMBOLS)))
        .when(
            F.col("language") == "java",
            F.when(java_kind != "", F.array(_found(java_kind, K.JAVA_TYPE, 2))).otherwise(F.array(java_method)),
        )
        .otherwise(F.array(*(_found(k, p) for k, p in K.SCRIPT_SYMBOLS)))
    )
    rows = rows.select(*KEY, "language", "source_sha256", "line_no", "line", F.inline(found)).filter(F.col("name") != "")
    out = rows.select(
        *KEY,
        F.col("line_no").alias("line"),
        "language",
        "kind",
        "name",
        T.clip(F.col("line")).alias("signature"),
        F.lit("medium").alias("confidence"),
        F.concat(F.lit("regex-"), "language", F.lit("-v1")).alias("extractor"),
        "source_sha256",
    )
    out = filter_symbols(out, kind, query)
    if max_per_tree is None:
        return out
    order = [P.locale_key("path"), F.col("path"), *map(F.col, ORDER)]
    return top_per_group(out, ["tree_id"], order, max_per_tree, ["path", "line"], "rank", "symbol_limit_reached")


def filter_symbols(s: DataFrame, kind: str | None = None, query: str | None = None) -> DataFrame:
    """Exact kind; substring of name or signature, ignoring case."""
    if kind:
        s = s.filter(F.col("kind") == kind.lower())
    if query:
        needle = F.lower(F.lit(query))
        s = s.filter(F.contains(F.lower("name"), needle) | F.contains(F.lower("signature"), needle))
    return s


def unsupported_languages(c: DataFrame, policy: Policy = DEFAULT_POLICY, **filters) -> DataFrame:
    """Kept files per language that has no symbol patterns."""
    files = kept(c, policy).filter(path_filter(**filters)).select("tree_id", P.language("path").alias("language"))
    return files.filter(~F.col("language").isin(*K.SYMBOL_LANGUAGES)).groupBy("tree_id", "language").agg(F.count("*").alias("files"))
