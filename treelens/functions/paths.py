"""Column functions over relative, '/'-separated paths. All stay in codegen."""

from __future__ import annotations

import posixpath
import re

from pyspark.sql import Column, functions as F

from treelens import constants as K


def _col(path) -> Column:
    return F.col(path) if isinstance(path, str) else path


def any_of(*conditions: Column) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def segments(path) -> Column:
    return F.split(_col(path), "/", -1)


def walk_key(path) -> Column:
    """Sort key of a depth-first walk that visits every directory in name order."""
    return segments(path)


def locale_key(path) -> Column:
    """Sort key of results: locale order (root collation) instead of byte order."""
    return F.collate(_col(path), "UNICODE")


def basename(path) -> Column:
    return F.substring_index(_col(path), "/", -1)


def dirname(path) -> Column:
    head = F.regexp_extract(_col(path), r"(?s)\A(.*)/[^/]*\z", 1)
    return F.when(head == "", ".").otherwise(head)


def extension(path) -> Column:
    """From the last dot of the basename; a leading dot alone is no extension."""
    return F.regexp_extract(_col(path), r"[^/](\.[^./]*)\z", 1)


def stem(path) -> Column:
    return F.regexp_replace(basename(path), r"(?s)(?<=.)\.[^./]*\z", "")


def test_stem(path) -> Column:
    """Lower-cased stem without one trailing test/spec marker."""
    return F.regexp_replace(F.lower(stem(path)), K.TEST_STEM_SUFFIX, "")


def alternatives(words) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def _named(names) -> str:
    """Pattern over a path: the basename is one of ``names``."""
    return rf"(?:^|/){alternatives(names)}\z"


def _with_extension(extensions) -> str:
    """Pattern over a path: the extension is one of ``extensions``."""
    return rf"[^/]{alternatives(extensions)}\z"


def language(path) -> Column:
    low = F.lower(_col(path))
    table = F.str_to_map(F.lit(",".join(f"{e}:{l}" for e, l in K.LANGUAGE_BY_EXTENSION.items())))
    known = F.coalesce(F.try_element_at(table, extension(low)), F.lit("unknown"))
    return F.when(basename(low) == "dockerfile", "dockerfile").otherwise(known)


def role(path) -> Column:
    """First hit of ci, manifest, test, doc, config, source, other.

    Each test is one pattern over the lower-cased path, so no arrays are built.
    """
    low = F.lower(_col(path))
    rules = {
        "ci": "^" + re.escape(K.CI_PREFIX) + "|" + _named(K.CI_NAMES),
        "manifest": _named(K.MANIFEST_NAMES),
        "test": "|".join([rf"(?:^|/){alternatives(K.TEST_SEGMENTS)}(?:/|\z)", *K.TEST_NAME_REGEXES]),
        "doc": "^docs/|" + _with_extension(K.DOC_EXTENSIONS),
        "config": _named(K.CONFIG_NAMES) + "|" + _with_extension(K.CONFIG_EXTENSIONS),
        "source": _with_extension(K.LANGUAGE_BY_EXTENSION),
    }
    out = F
    for name, pattern in rules.items():
        out = out.when(low.rlike(pattern), name)
    return out.otherwise("other")


def normalize_extensions(extensions) -> list[str]:
    """Trim, lower-case and dot-prefix caller-supplied extensions."""
    cleaned = (e.strip().lower() for e in extensions or ())
    return sorted({e if e.startswith(".") else f".{e}" for e in cleaned if e})


def path_contains(path, needle: str) -> Column:
    return F.contains(F.lower(_col(path)), F.lower(F.lit(needle)))


def ext_in(path, extensions) -> Column:
    """Extension filter; an empty set keeps every path."""
    wanted = normalize_extensions(extensions)
    return F.lower(extension(path)).isin(wanted) if wanted else F.lit(True)


def scope_of(path: str | None) -> str:
    """Normalise a scope argument; absolute or escaping scopes are errors."""
    if path is None or path == "":
        return "."
    if path.startswith("/"):
        raise ValueError("absolute paths are not allowed; use a relative path")
    norm = posixpath.normpath(path)
    if norm == ".." or norm.startswith("../"):
        raise ValueError("path is outside the tree: " + path)
    return norm


def in_scope(path, scope: str | None) -> Column:
    """True for the file named by ``scope`` and for everything below it."""
    norm = scope_of(scope)
    if norm == ".":
        return F.lit(True)
    return (_col(path) == norm) | F.startswith(_col(path), F.lit(norm + "/"))


def relativize(path, root) -> Column:
    """``path`` below ``root`` as a relative path; the root itself is '.'."""
    path, root = _col(path), F.rtrim(_col(root), F.lit("/"))
    return F.when(path == root, F.lit(".")).otherwise(
        F.when(
            F.startswith(path, F.concat(root, F.lit("/"))),
            F.substr(path, F.length(root) + 2),
        )
    )


def normalized_segments(path) -> Column:
    """Segments with '.', '' and 'x/..' removed; leading '..' mark an escape."""
    parts = F.filter(segments(path), lambda s: ~s.isin("", "."))

    def step(acc, s):
        can_pop = (F.size(acc) > 0) & (F.coalesce(F.element_at(acc, -1), F.lit("")) != "..")
        return F.when((s == "..") & can_pop, F.slice(acc, 1, F.size(acc) - 1)).otherwise(
            F.concat(acc, F.array(s))
        )

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def clean_path(path) -> Column:
    """Normalised relative path, '.' for the root; null when it is absolute or escapes."""
    path = _col(path)
    segs = normalized_segments(path)
    plain = ~path.rlike(r"(?:^|/)\.{0,2}(?:/|\z)")  # nothing to normalise: skip the fold
    return (
        F.when(F.coalesce(path, F.lit("")) == "", F.lit("."))
        .when(plain, path)
        .when(F.startswith(path, F.lit("/")), F.lit(None).cast("string"))
        .when(F.get(segs, F.lit(0)) == "..", F.lit(None).cast("string"))
        .when(F.size(segs) == 0, F.lit("."))
        .otherwise(F.array_join(segs, "/"))
    )


def path_error(path) -> Column:
    """Error text for a requested path, null when its shape is fine."""
    path = _col(path)
    return (
        F.when(F.coalesce(path, F.lit("")) == "", F.lit(None).cast("string"))
        .when(F.startswith(path, F.lit("/")), F.lit("absolute-path"))
        .when(clean_path(path).isNull(), F.lit("outside-tree"))
    )
