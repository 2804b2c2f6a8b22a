"""Corpus analytics over file trees as Spark DataFrames.

Every operator takes a corpus frame keyed by ``(tree_id, path)`` and answers for
all trees in one job.
"""

from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.budgets import budgeted_imports, budgeted_symbols, byte_greedy, byte_prefix, line_prefix, scan_budget, scan_cuts
from treelens.operators.coverage import files_coverage, merge_coverage, read_coverage, search_coverage, with_unsupported
from treelens.operators.cuts import Cuts, within_cuts
from treelens.operators.fingerprints import (
    changed_directories, compare_snapshots, content_fingerprint, diff_changed_trees, diff_files, directory_fingerprint, fingerprint_of_hashes,
    layered_fingerprint, metadata_fingerprint, read_snapshot, snapshot, verify_snapshot, write_snapshot,
)
from treelens.operators.imports import import_edges, relative_imports, resolve_imports
from treelens.operators.inventory import (
    cap_dirs, cap_files, capped_inventory, classify_files, directories, inventory, inventory_coverage, kept, policy_counts, scope_status,
)
from treelens.operators.ledger import batch_coverage, related_coverage, symbols_coverage
from treelens.operators.reading import (
    content_hashes, decode, file_facts, file_lines, read_batch, read_ranges, readable, validate_paths, within_size,
)
from treelens.operators.related import (
    direct_imports, filter_related, grouped_related, imported_by, likely_tests, name_groups, related, same_basename, siblings, tested_stems,
)
from treelens.operators.reports import corpus_map, map_report, outline, outline_report
from treelens.operators.rollup import dir_roles, dir_rollup, first_files, guidance, language_counts, role_counts, role_top_n
from treelens.operators.search import budgeted_search, matched_files, plan_cuts, scan_plan, search, snapshot_check
from treelens.operators.symbols import filter_symbols, symbols, unsupported_languages
from treelens.plans.ordered import display_order
from treelens.sources.corpus import corpus, read_corpus, read_corpus_table, write_corpus
from treelens.sources.tree import list_tree, load_content, read_tree, write_table
