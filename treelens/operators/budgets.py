"""Byte and line budgets per tree, in path order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.cuts import Cuts, cuts_of, within_cuts
from treelens.operators.imports import relative_imports, resolve_imports
from treelens.operators.inventory import KEY, kept
from treelens.operators.reading import file_facts
from treelens.operators.symbols import symbols
from treelens.plans.materialize import materialize, small_side
from treelens.plans.ordered import greedy_fill, running_totals



def _order(files: DataFrame) -> list[Column]:
    """Path order; files marked ``first`` come before all others."""
    by_path = [P.locale_key("path"), F.col("path")]
    return [~F.col("first"), *by_path] if "first" in files.columns else by_path


def _keys(files: DataFrame) -> list[str]:
    return [*KEY, "first"] if "first" in files.columns else KEY


def byte_prefix(files: DataFrame, budget: int) -> DataFrame:
    """Files before the first one that would exceed the bytes of its tree."""
    rows = files.select(*_keys(files), "size")
    upto = running_totals(rows, ["tree_id"], _order(files), {"bytes_upto": F.col("size")})
    return upto.filter(F.col("bytes_upto") <= budget)


def byte_greedy(files: DataFrame, budget: int, **options) -> DataFrame:
    """Files taken in path order; one that does not fit is skipped, later ones may fit."""
    return greedy_fill(files.select(*_keys(files), "size"), "tree_id", _order(files), "size", budget, **options)


def line_prefix(files: DataFrame, budget: int) -> DataFrame:
    """Leading lines granted per file of ``files(tree_id, path, total_lines)``.

    The last file may be cut; files after it get nothing and no row.
    """
    # Line counts come from the content: write them once, the range sort samples its input.
    rows = materialize(files.select(*_keys(files), "total_lines"))
    upto = running_totals(rows, ["tree_id"], _order(files), {"lines_upto": F.col("total_lines")})
    before = F.col("lines_upto") - F.col("total_lines")
    return upto.filter(before < budget).select(
        *KEY, "total_lines", F.least(F.col("total_lines"), F.lit(budget) - before).alias("granted_lines")
    )


def scan_budget(facts: DataFrame, max_total_bytes: int | None = None, max_total_lines: int | None = None) -> DataFrame:
    """Files and leading lines a budgeted scan of ``file_facts`` reads.

    Bytes are spent by every file that is read, refused ones included; lines only
    by readable files. A boolean column ``first`` marks files to read before the
    others, so that a tight budget is not spent elsewhere.
    """
    taken = facts if max_total_bytes is None else byte_greedy(facts, max_total_bytes).select(*KEY).join(facts, KEY)
    readable = taken.filter(F.col("refusal").isNull())
    if max_total_lines is None:
        return readable.select(*KEY, "total_lines", F.col("total_lines").alias("granted_lines"))
    return line_prefix(readable, max_total_lines)


def scan_cuts(facts: DataFrame, max_total_bytes: int | None = None, max_total_lines: int | None = None) -> Cuts:
    """``scan_budget`` as cuts."""
    granted = scan_budget(facts, max_total_bytes, max_total_lines)
    if "first" in facts.columns:
        granted = granted.join(small_side(facts.filter("first").select(*KEY, "first")), KEY, "left").withColumn("first", F.coalesce("first", F.lit(False)))
    granted = materialize(granted)
    return cuts_of(granted, facts.filter(F.col("refusal").isNull()).select(*KEY))


def _within(facts: DataFrame, max_bytes_per_file: int | None) -> DataFrame:
    """A file over the size cap is not read and spends nothing."""
    return facts if max_bytes_per_file is None else facts.filter(F.col("size") <= max_bytes_per_file)


def symbol_cuts(c, max_total_bytes=None, max_total_lines=None, policy: Policy = DEFAULT_POLICY, max_bytes_per_file=None) -> Cuts:
    """How far a budgeted symbol scan gets in every tree."""
    files = c.filter(P.language("path").isin(*K.SYMBOL_LANGUAGES))
    return scan_cuts(materialize(_within(file_facts(files, policy), max_bytes_per_file)), max_total_bytes, max_total_lines)


def budgeted_symbols(
    c: DataFrame,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    policy: Policy = DEFAULT_POLICY,
    max_bytes_per_file: int | None = None,
    **options,
) -> DataFrame:
    """Symbols of the files and lines that the budgets of each tree allow.

    ``symbols_coverage`` with the same limits tells what was left out and why.
    """
    cuts = symbol_cuts(c, max_total_bytes, max_total_lines, policy, max_bytes_per_file)
    files = c.filter(P.language("path").isin(*K.SYMBOL_LANGUAGES))
    return symbols(within_cuts(files, cuts), policy=policy, granted="granted_lines", max_bytes_per_file=max_bytes_per_file, **options)


def import_facts(c: DataFrame, targets: DataFrame, policy: Policy = DEFAULT_POLICY, max_bytes_per_file: int | None = None) -> DataFrame:
    """Facts of the files an import scan reads, the target of each tree marked ``first``."""
    script = F.coalesce(P.language("path").isin(*K.IMPORT_LANGUAGES), F.lit(False))
    wanted = small_side(targets.select(*KEY, F.lit(True).alias("first")))
    facts = file_facts(c.filter(script), policy).unionByName(file_facts(c.filter(~script), policy).join(wanted, KEY, "left_semi"))
    facts = materialize(_within(facts, max_bytes_per_file)).join(wanted, KEY, "left").withColumn("first", F.coalesce("first", F.lit(False)))
    # Files of other languages are read, and then count as refused: nothing of them is left to scan.
    return facts.withColumn("refusal", F.when(script, F.col("refusal")).otherwise("no-imports"))


def budgeted_imports(
    c: DataFrame,
    targets: DataFrame,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    policy: Policy = DEFAULT_POLICY,
    max_bytes_per_file: int | None = None,
) -> DataFrame:
    """Resolved imports under budgets, reading the target of each tree first.

    ``targets`` holds one file per tree; its imports survive the tightest budget. A target
    in a language without imports spends its bytes, but no lines.
    """
    cuts = scan_cuts(import_facts(c, targets, policy, max_bytes_per_file), max_total_bytes, max_total_lines)
    files = c.filter(F.coalesce(P.language("path").isin(*K.IMPORT_LANGUAGES), F.lit(False)))
    found = relative_imports(within_cuts(files, cuts), policy, granted="granted_lines", max_bytes_per_file=max_bytes_per_file)
    return resolve_imports(found, kept(c, policy).select(*KEY))
