"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of four base patterns (email, ip, card, phone) and of two looser
ones (spelled-out emails, phone numbers without country code). Labelers vote on each:
the format check of its kind, a gazetteer (domains, issuer prefixes, plausible networks
and number lengths), the words before it, and the characters at its edges.
Expectation-maximisation over the vote patterns - at most 4 * 3**4 counts, all that the
driver sees - estimates how reliable each labeler is per kind and how likely each
pattern is personal. With those posteriors as soft labels a naive Bayes classifier over
features of the span is trained by one aggregation. Base matches that pass their check
are always reported; the classifier adds loose spans that overlap none of them.

Positions are code points. They come from splitting a text at the matches and adding up
lengths, because Spark returns matches without positions. Patterns use possessive
quantifiers and ``\\G``, which give the same matches as the plain patterns without
backtracking, so long runs of letters or digits take linear time and no deep recursion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import frames

KINDS = ("email", "ip", "card", "phone")
#: Base patterns by kind, each with a text that every match contains (fixed values).
_BASE = (
    (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", r"[0-9]\.[0-9]"),
    (r"[0-9](?:[-\x20]?[0-9])++", r"[0-9]"),
    (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
)
#: Looser patterns: kind, pattern, text that every match contains.
_LOOSE = (
    (0, r"\b[A-Za-z0-9._-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,64}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,64}+){1,8}+", r"[\[(]at[\])]"),
    (3, r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
)
#: Labeler word lists (fixed values).
_TOP_LEVEL = r"(?i)(?:\.|dot[\])]\x20?)(?:com|org|net|edu|gov|info|io|co|de|fr|es|it|uk|eu)$"
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|62)"
_UNROUTABLE = r"^0*(?:0|127|255)\."
_FOR = r"(?i)\b(?:e-?mail|mail|contact|write to|call|phone|tel|mobile|fax|card|visa|ip|host|address|reach|from)\b"
_AGAINST = r"(?i)\b(?:version|order|id|isbn|hash|token|part|page|section|figure|build|release)\b"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_CONTEXT = 24
_SPAN = (
    "struct<kind: int, start: bigint, end: bigint, loose: boolean, v0: int, v1: int, v2: int, v3: int,"
    " f0: int, f1: int, f2: int, f3: int, f4: int>"
)
_BLOCK = 256
_N_VOTES, _N_FEATURES = 4, 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(char, i):
        d = char.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: int, value: Column) -> Column:
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    n = F.length(_digits(value))
    if kind == 2:
        return F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(False)
    return n.between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _gazetteer(kind: int, value: Column) -> Column:
    if kind == 0:
        return F.when(value.rlike(_TOP_LEVEL), 1).otherwise(-1)
    if kind == 1:
        return F.when(value.rlike(_UNROUTABLE), -1).otherwise(1)
    if kind == 2:
        return F.when(_digits(value).rlike(_ISSUERS), 1).otherwise(-1)
    return F.when(F.length(_digits(value)).between(10, 12), 1).otherwise(0)


def _edge(char: Column) -> Column:
    """0 none, 1 white space, 2 sentence mark, 3 letter or digit, 4 other."""
    return F.when(char == "", 0).when(char.rlike(r"^\s"), 1).when(char.rlike("^[.,;:!?()]"), 2).when(char.rlike(r"^[\p{L}\p{N}_]"), 3).otherwise(4)


def _span(kind: int, loose: bool, x: Column, start: Column) -> Column:
    value, before, after = x["value"], F.right(x["before"], F.lit(_CONTEXT)), F.left(x["after"], F.lit(1))
    left, right = _edge(F.right(before, F.lit(1))), _edge(after)
    length = F.length(value)
    fields = {
        "kind": F.lit(kind), "start": start, "end": start + length, "loose": F.lit(loose),
        "v0": F.lit(0) if loose else F.when(_passes(kind, value), 1).otherwise(-1),
        "v1": _gazetteer(kind, value),
        "v2": _vote(before.rlike(_FOR), before.rlike(_AGAINST)),
        "v3": F.when((left == 3) | (right == 3) | (left == 4) | (right == 4), -1).otherwise(1),
        "f0": F.least(F.floor(length / 4), F.lit(10)).cast("int"),
        "f1": F.floor(F.length(_digits(value)) * 5 / length).cast("int"),
        "f2": left, "f3": right,
        "f4": F.least(F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(8)),
    }
    return F.struct(*(v.alias(k) for k, v in fields.items())).cast(_SPAN)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array as an array of runs of up to ``_BLOCK``; none of an empty one."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int"))
    return F.transform(F.when(F.size(items) > 0, numbers).otherwise(F.array().cast("array<int>")), lambda b: F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)))


def _sums(lengths: Column) -> Column:
    """Total and the sums before each of a few lengths. The list grows by copying, so it must stay short."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(lengths, zero, lambda acc, n: F.struct((acc["total"] + n).alias("total"), F.concat(acc["before"], F.array(acc["total"])).alias("before")))


def _places(lengths: Column) -> Column:
    """The sum before each length, block by block: an array of n costs about n * (_BLOCK + n / _BLOCK) copies of numbers."""

    def shifted(blocks: Column) -> Column:
        before = _sums(F.transform(blocks, lambda b: b["total"]))["before"]
        return F.flatten(F.zip_with(blocks, before, lambda b, n: F.transform(b["before"], lambda x: x + n)))

    return _let(lengths, lambda all_: _let(F.transform(_blocks(all_), _sums), shifted))


def _located(kind: int, loose: bool, matches: Column, pieces: Column) -> Column:
    """Spans of the matches; runs of digits too short or long for a card are passed over."""
    inner = F.zip_with(matches, F.slice(pieces, 2, F.size(matches)), lambda m, a: F.struct(m.alias("value"), a.alias("after")))
    rows = F.zip_with(F.slice(pieces, 1, F.size(matches)), inner, lambda b, x: F.struct(b.alias("before"), x["value"].alias("value"), x["after"].alias("after")))

    def spans(rows: Column) -> Column:
        places = _places(F.transform(rows, lambda x: (F.length(x["before"]) + F.length(x["value"])).cast("bigint")))
        placed = F.zip_with(rows, places, lambda x, at: F.struct(x.alias("x"), (at + F.length(x["before"])).alias("start")))
        if kind == 2:
            placed = F.filter(placed, lambda p: F.length(_digits(p["x"]["value"])).between(13, 19))
        return F.transform(placed, lambda p: _span(kind, loose, p["x"], p["start"]))

    return F.when(F.size(matches) > 0, _let(rows, spans)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to rows (row, doc_id, spans): every candidate with votes and features, written once."""
    patterns = [(k, False, p, hint) for k, (p, hint) in enumerate(_BASE)] + [(k, True, p, hint) for k, p, hint in _LOOSE]
    none = F.array().cast("array<string>")
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for i, (_, _, pattern, hint) in enumerate(patterns):
        df = df.withColumn(f"m{i}", F.when(F.col("text").rlike(hint), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    for i, (_, _, pattern, _) in enumerate(patterns):
        df = df.withColumn(f"p{i}", F.when(F.size(f"m{i}") > 0, F.split("text", pattern, -1)).otherwise(none))
    spans = [_located(kind, loose, F.col(f"m{i}"), F.col(f"p{i}")) for i, (kind, loose, _, _) in enumerate(patterns)]
    return frames.stored(df.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*spans).alias("spans")))


def estimate(counts: dict[tuple, int], rounds: int = 50) -> dict[tuple, float]:
    """Posterior of each vote pattern ``(kind, v0, v1, ...)`` by expectation-maximisation.

    Two classes, labelers independent given the class, one reliability table per kind and
    labeler; starts from the majority of votes and smooths every count by one half.
    """
    belief = {p: 1 / (1 + math.exp(-1.5 * sum(p[1:]))) for p in counts}
    for _ in range(rounds):
        fresh = {}
        for kind in {p[0] for p in counts}:
            own = [p for p in counts if p[0] == kind]
            yes = sum(counts[p] * belief[p] for p in own)
            no = sum(counts[p] * (1 - belief[p]) for p in own)
            odds = {}
            for i in range(1, _N_VOTES + 1):
                for v in (-1, 0, 1):
                    a = sum(counts[p] * belief[p] for p in own if p[i] == v)
                    b = sum(counts[p] * (1 - belief[p]) for p in own if p[i] == v)
                    odds[i, v] = math.log((a + 0.5) / (yes + 1.5)) - math.log((b + 0.5) / (no + 1.5))
            for p in own:
                z = math.log((yes + 0.5) / (no + 0.5)) + sum(odds[i, p[i]] for i in range(1, _N_VOTES + 1))
                fresh[p] = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
        belief = fresh
    return belief


def _lookup(table: dict, key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    entries = [F.lit(x) for k, v in sorted(table.items()) for x in (k, float(v))]
    return F.coalesce(F.element_at(F.create_map(*entries), key), F.lit(default))


def _code(*parts: Column) -> Column:
    return F.concat_ws(",", *(p.cast("string") for p in parts))


def train(spans: DataFrame) -> dict[str, float]:
    """Log odds of the span classifier by ``kind,feature,value``; ``kind`` alone is its prior."""
    flat = spans.select(F.explode("spans").alias("s")).select("s.*")
    votes = [f"v{i}" for i in range(_N_VOTES)]
    counted = flat.groupBy("kind", *votes).count().collect()  # at most 4 * 3**4 rows
    belief = estimate({tuple(r[:-1]): r[-1] for r in counted})
    likely = _lookup({",".join(map(str, p)): b for p, b in belief.items()}, _code(*map(F.col, ["kind", *votes])), 0.5)
    marked = flat.withColumn("likely", likely)
    parts = [F.struct(F.lit(i).alias("feature"), F.col(f"f{i}").alias("value")) for i in range(_N_FEATURES)]
    parts.append(F.struct(F.lit(-1).alias("feature"), F.lit(0).alias("value")))
    summed = marked.select("kind", "likely", F.explode(F.array(*parts)).alias("x")).groupBy("kind", "x.feature", "x.value")
    rows = summed.agg(F.sum("likely").alias("yes"), F.sum(1 - F.col("likely")).alias("no")).collect()  # at most 4 * 6 * 11 rows
    total = {r["kind"]: (r["yes"], r["no"]) for r in rows if r["feature"] == -1}
    out = {str(k): math.log((yes + 0.5) / (no + 0.5)) for k, (yes, no) in total.items()}
    for r in rows:
        if r["feature"] >= 0:
            yes, no = total[r["kind"]]
            out[f"{r['kind']},{r['feature']},{r['value']}"] = math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1))
    return out


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Spans of personal data: one row per row of ``docs (doc_id, text)``.

    Returns doc_id, base and spans, both arrays of struct(kind, start, end) in the order of
    KINDS, then start; positions in code points, end exclusive. ``base`` are the matches
    of the base patterns that pass their check; ``spans`` adds loose spans that the
    classifier holds for personal (``threshold``) and that overlap no base span.

    Null and empty texts have no spans; rows with null or repeated doc_id are judged each on
    its own; other columns are ignored. Without any candidate nothing is trained.
    """
    scanned = candidates(docs)
    model = train(scanned)

    def score(s: Column) -> Column:
        z = _lookup({k: v for k, v in model.items() if "," not in k}, s["kind"].cast("string"), -1.0)
        table = {k: v for k, v in model.items() if "," in k}
        for i in range(_N_FEATURES):
            z = z + _lookup(table, _code(s["kind"], F.lit(i), s[f"f{i}"]), 0.0)
        return 1 / (1 + F.exp(-z))

    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.transform(F.filter("spans", lambda s: ~s["loose"] & (s["v0"] == 1)), bare)
    marked = scanned.select("doc_id", "spans", base.alias("base"))
    likely = F.transform(F.filter("spans", lambda s: s["loose"] & (score(s) >= threshold)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    overlap = lambda b, s: (b["start"] < s["end"]) & (s["start"] < b["end"])

    def apart(block: Column) -> Column:
        """Loose spans of a block, sorted by start, that overlap no base span; only base spans near the block are compared with each."""
        reach = F.struct(F.get(block, F.lit(0))["start"].alias("start"), F.array_max(F.transform(block, lambda s: s["end"])).alias("end"))
        near = _let(reach, lambda r: F.filter("base", lambda b: overlap(b, r)))
        return _let(near, lambda n: F.filter(block, lambda s: ~F.exists(n, lambda b: overlap(b, s))))

    loose = _let(F.array_sort(likely), lambda all_: F.flatten(F.transform(_blocks(all_), apart)))
    return marked.select("doc_id", "base", F.array_sort(F.concat("base", F.transform(loose, bare))).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


def op5_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = find_personal_data(docs)
    counts = [F.size(F.filter("base", _of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
