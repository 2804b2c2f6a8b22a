"""Path policy: secret-like paths, generated directories, caller additions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from treelens import constants as K
from treelens.functions.paths import alternatives, any_of, normalize_extensions, segments


def _words(values) -> tuple[str, ...]:
    return tuple(sorted({v.strip() for v in values if v.strip()}))


@dataclass(frozen=True)
class Policy:
    """Built-in rules plus additions; callers can only add, never remove."""

    ignore_dirs: tuple[str, ...] = ()
    secret_names: tuple[str, ...] = ()
    secret_extensions: tuple[str, ...] = ()
    secret_path_parts: tuple[str, ...] = ()

    def is_secret(self, path) -> Column:
        """Any segment is secret-like, or the path holds a caller's substring.

        One regular expression over the lower-cased path tests all segments at
        once, so the predicate needs no array and stays in generated code.
        """
        path = F.col(path) if isinstance(path, str) else path
        low = F.lower(path)
        names = [*K.SECRET_DIRS, *K.SECRET_NAMES]
        names += [n.lower() for n in _words(self.secret_names)]
        exts = [*K.SECRET_EXTENSIONS, *normalize_extensions(self.secret_extensions)]
        segment = "|".join(
            [
                alternatives(sorted({n for n in names if "/" not in n})),
                re.escape(K.ENV_PREFIX) + rf"(?!{K.ENV_ALLOWED}(?:/|\z))[^/]*",
                "[^/]+" + alternatives(sorted({e for e in exts if "/" not in e and e.count(".") == 1})),
            ]
        )
        parts = [p.lower() for p in _words(self.secret_path_parts)]
        return (
            low.rlike(rf"(?:^|/)(?:{segment})(?:/|\z)")
            | path.rlike("(?i)" + "|".join(K.SECRET_PATH_REGEXES))
            | any_of(*(F.contains(low, F.lit(p)) for p in parts))
        )

    def is_generated(self, path) -> Column:
        """Some directory segment (never the basename) is a generated directory."""
        path = F.col(path) if isinstance(path, str) else path
        dirs = sorted({d.lower() for d in (*K.GENERATED_DIRS, *_words(self.ignore_dirs))})
        return F.lower(path).rlike(rf"(?:^|/){alternatives(dirs)}/")

    def classify(self, path) -> Column:
        """'secret', 'generated' or null; secret wins."""
        return F.when(self.is_secret(path), "secret").when(self.is_generated(path), "generated")

    def pruned_prefix(self, path) -> Column:
        """Topmost path at which a walk stops: shortest refused prefix, else null."""
        segs = segments(path)
        n = F.size(segs)

        def prefix(i):
            return F.array_join(F.slice(segs, F.lit(1), i), "/")

        def refused(i):
            return self.is_secret(prefix(i)) | (
                (i < n) & self.is_generated(F.concat(prefix(i), F.lit("/")))
            )

        first = F.get(F.filter(F.sequence(F.lit(1), n), refused), F.lit(0))
        return F.when(self.classify(path).isNotNull(), prefix(first))


DEFAULT_POLICY = Policy()
