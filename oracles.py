"""DuckDB SQL for every query of ``__spark_entry__`` that SQL can express.

The SQL is written from the definitions, not from the Spark plans: it splits
paths into segments, uses the unshortened patterns and whole-tree windows.
"""

from __future__ import annotations

from treelens import constants as K

SPACE = r"[\t\n\x0b\f\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
SPACES = "(" + "||".join(
    f"chr({c})" for c in (9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
) + ")"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def regex(pattern: str) -> str:
    """SQL literal of an RE2 pattern with the wider white space class."""
    return "'" + pattern.replace(r"\s", SPACE).replace("'", "''") + "'"


# ---- path expressions -------------------------------------------------------
def basename(p):
    return f"list_extract(string_split({p}, '/'), -1)"


def dirname(p):
    return f"CASE WHEN contains({p}, '/') THEN regexp_replace({p}, '/[^/]*$', '') ELSE '.' END"


def ext_of_name(n):
    return rf"regexp_extract({n}, '^.+?(\.[^.]*)$', 1)"


def extension(p):
    return ext_of_name(basename(p))


def stem(p):
    return f"left({basename(p)}, length({basename(p)}) - length({extension(p)}))"


def language(p):
    low = f"lower({basename(p)})"
    cases = " ".join(f"WHEN '{e}' THEN '{l}'" for e, l in K.LANGUAGE_BY_EXTENSION.items())
    return f"CASE WHEN {low} = 'dockerfile' THEN 'dockerfile' ELSE CASE {ext_of_name(low)} {cases} ELSE 'unknown' END END"


def role(p):
    low, name = f"lower({p})", f"lower({basename(p)})"
    ext = ext_of_name(name)
    return f"""CASE
      WHEN starts_with({low}, '{K.CI_PREFIX}') OR {name} IN ({quoted(K.CI_NAMES)}) THEN 'ci'
      WHEN {name} IN ({quoted(K.MANIFEST_NAMES)}) THEN 'manifest'
      WHEN list_has_any(string_split({low}, '/'), [{quoted(K.TEST_SEGMENTS)}])
        OR regexp_matches({name}, '(?:^|[._-])(test|spec)(?:[._-]|$)') OR regexp_matches({name}, 'test\\.[a-z0-9]+$') THEN 'test'
      WHEN {ext} IN ({quoted(K.DOC_EXTENSIONS)}) OR starts_with({low}, 'docs/') THEN 'doc'
      WHEN {name} IN ({quoted(K.CONFIG_NAMES)}) OR {ext} IN ({quoted(K.CONFIG_EXTENSIONS)}) THEN 'config'
      WHEN {language(p)} <> 'unknown' THEN 'source' ELSE 'other' END"""


def secret_name(s):
    names = quoted([*K.SECRET_DIRS, *K.SECRET_NAMES])
    return rf"""(lower({s}) IN ({names})
      OR (starts_with(lower({s}), '.env.') AND lower({s}) <> '.env.example')
      OR regexp_matches({s}, '(?i)^credentials\.(cfg|conf|ini|json|toml|txt|ya?ml)$')
      OR regexp_matches({s}, '(?i)^secrets?\.(cfg|conf|ini|json|toml|txt|ya?ml)$')
      OR regexp_matches({s}, '(?i)(^|[-_.])private[-_.]?key($|[-_.])')
      OR regexp_matches({s}, '(?i)(^|[-_.])service[-_.]?account($|[-_.])')
      OR {ext_of_name(f'lower({s})')} IN ({quoted(K.SECRET_EXTENSIONS)}))"""


GENERATED = quoted([d.lower() for d in K.GENERATED_DIRS])


def is_secret(p):
    return f"len(list_filter(string_split({p}, '/'), lambda s: {secret_name('s')})) > 0"


def is_generated(p):
    return f"len(list_filter(string_split({p}, '/')[:-2], lambda s: lower(s) IN ({GENERATED}))) > 0"


def policy_class(p):
    return f"CASE WHEN {is_secret(p)} THEN 'secret' WHEN {is_generated(p)} THEN 'generated' END"


# ---- tables -----------------------------------------------------------------
CODE = """b AS (SELECT doc_id, lang, source AS tree_id, doc_id // 20 AS n, text FROM documents),
k AS (SELECT *, CAST(n % 10 AS INT) AS r, CAST(n AS VARCHAR) AS s, CAST(n-1 AS VARCHAR) AS s1,
             CAST(n-5 AS VARCHAR) AS s5, CAST(n+2 AS VARCHAR) AS s2 FROM b),
code0 AS (SELECT doc_id, lang, tree_id,
  CASE r WHEN 0 THEN concat('src/mod',s,'.ts')
         WHEN 1 THEN concat('src/mod',s1,'.test.ts')
         WHEN 2 THEN concat('lib/util',s,'.js')
         WHEN 3 THEN concat('tools/job',s,'.py')
         WHEN 4 THEN concat('app/Main',s,'.java')
         WHEN 5 THEN concat('docs/mod',s5,'.md')
         WHEN 6 THEN concat('node_modules/pkg',s,'/index.js')
         WHEN 7 THEN concat('conf/env',s,'/.env')
         WHEN 8 THEN concat('.github/workflows/ci',s,'.yml')
         ELSE concat('pkg',s,'/package.json') END AS path,
  concat(CASE r
    WHEN 0 THEN concat('import { u } from "../lib/util',s2,'"',chr(10),
                       'export const mod',s,' = 1',chr(10),'export class Mod',s,' {}',chr(10))
    WHEN 1 THEN concat('import { m } from "./mod',s1,'"',chr(10))
    WHEN 2 THEN concat('export function util',s,'(a) {',chr(10))
    WHEN 3 THEN concat('class Job',s,':',chr(10),'    def run(self):',chr(10))
    WHEN 4 THEN concat('public class Main',s,' {',chr(10),'  public void start() {}',chr(10))
    ELSE '' END, text) AS content FROM k),
code AS (SELECT *, strlen(content) AS size FROM code0)"""
KEPT = CODE + f""",
kept AS (SELECT * FROM code WHERE ({policy_class('path')}) IS NULL)"""
CONTROL = "length(content) - length(regexp_replace(content, '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'))"
REFUSAL = f"CASE WHEN contains(content, chr(0)) THEN 'binary' WHEN {CONTROL} > 8 AND ({CONTROL}) / greatest(1, strlen(content)) > 0.05 THEN 'control-heavy' END"
VARIED = f"""b AS (SELECT source AS tree_id, doc_id // 20 AS n, CAST(doc_id // 20 % 10 AS INT) AS r, text FROM documents),
k AS (SELECT *, CAST(n AS VARCHAR) AS s, CAST(n-1 AS VARCHAR) AS s1, CAST(n-2 AS VARCHAR) AS s2, CAST(n-9 AS VARCHAR) AS s9, chr(13) || chr(10) AS crlf, chr(10) AS lf FROM b),
code0 AS (SELECT tree_id,
  CASE r WHEN 0 THEN concat('web/a',s,'/index.ts') WHEN 1 THEN concat('web/a',s1,'/part.ts') WHEN 2 THEN concat('lib/k',s,'/index.js')
    WHEN 3 THEN concat('svc/Main',s,'.java') WHEN 4 THEN concat('bin/blob',s,'.ts') WHEN 5 THEN concat('bin/ctrl',s,'.TXT')
    WHEN 6 THEN concat('Notes/Bom',s,'.MD') WHEN 7 THEN concat('src/contest',s,'.py') WHEN 8 THEN concat('.GitHub/workflows/x',s,'.YML')
    ELSE concat('test/a',s9,'/index.test.ts') END AS path,
  concat(CASE r
    WHEN 0 THEN concat('export interface Shape',s,' {{}}',crlf,'export type Alias',s,' = string',crlf,'export enum Color',s,' {{ A }}',crlf,
      'import type x from "./part"',crlf,'export {{ y }} from "../a',s,'/part"',crlf,'import a,',crlf,'  {{ b }} from "./part.ts"',crlf)
    WHEN 1 THEN concat('const z = require( "./index" )',lf,'import("../missing")',lf,'import w from "./"',lf,'abstract class Part',s,' {{}}',lf)
    WHEN 2 THEN concat('import q from "../../web/a',s2,'"',lf,'export * from "../../../outside"',lf,'async function go',s,' () {{}}',lf)
    WHEN 3 THEN concat('public record Point',s,'(int x) {{}}',lf,'enum Kind',s,' {{ A }}',lf,'interface Api',s,' {{}}',lf,'  protected static int go',s,
      ' (int a) {{ return new Foo(a); }}',lf,'// class Hidden',lf)
    WHEN 4 THEN concat('class Gone',s,' {{}}',lf,'import g from "./gone"',lf,chr(0),lf)
    WHEN 5 THEN concat(repeat(chr(1), 20),substr(text, 1, 100),lf,lf)
    WHEN 6 THEN concat(chr(65279),'# title',crlf,'lone',chr(13),'return',crlf)
    WHEN 7 THEN concat('async  def run',s,' (self):',lf,'# class Comment',lf,chr(160),'class Wide',s,':',lf)
    WHEN 9 THEN concat('import i from "../../web/a',s9,'/index"',lf,'import "./index.test"',lf) ELSE '' END, CASE WHEN r = 5 THEN '' ELSE text END) AS content FROM k),
code AS (SELECT *, strlen(content) AS size FROM code0),
kept AS (SELECT * FROM code WHERE ({policy_class('path')}) IS NULL),
readable AS (SELECT *, CASE WHEN starts_with(content, chr(65279)) THEN substr(content, 2) ELSE content END AS body FROM kept WHERE ({REFUSAL}) IS NULL)"""
BODY_LINES = "string_split_regex(body, '\r?\n')"
LATER = CODE + f""",
later0 AS (SELECT c.doc_id, c.tree_id, c.path, CASE WHEN l.quality = 0 THEN concat(c.content, 'edited') ELSE c.content END AS content
  FROM code c LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) = 0),
later AS (SELECT *, strlen(content) AS size FROM later0 WHERE ({policy_class('path')}) IS NULL),
kept AS (SELECT * FROM code WHERE ({policy_class('path')}) IS NULL)"""
DOCS = """docs AS (SELECT source AS tree_id, concat(lang, '/', doc_id, '.txt') AS path, text AS content, strlen(text) AS size FROM documents)"""
PAGES = """docs AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS tree_id, concat('pages/', page_id, '.html') AS path,
  html AS content, strlen(html) AS size FROM pages)"""
TALKS = """docs AS (SELECT CAST(conv_id AS VARCHAR) AS tree_id, concat(role, '/', turn, '.txt') AS path,
  text AS content, strlen(text) AS size FROM conversations)"""
NUMBERED = "string_split_regex(content, '\r?\n')"


def lines_of(table, columns="tree_id, path", alias="x", lines=NUMBERED):
    """One row per line of ``table``."""
    return f"""{alias} AS (SELECT {columns}, line_no, ls[line_no] AS line, ls FROM
      (SELECT {columns}, ls, unnest(range(1, len(ls) + 1)) AS line_no FROM
        (SELECT *, {lines} AS ls FROM {table})))"""


def clip(e):
    return f"CASE WHEN length({e}) > 320 THEN concat(left({e}, 320), '...') ELSE {e} END"


def excerpt(line, q, case_sensitive=False):
    hay, needle = (line, q) if case_sensitive else (f"lower({line})", q.lower())
    half = max(0, 320 - len(q)) // 2
    first = f"greatest(0, instr({hay}, '{needle}') - 1 - {half})"
    begin = f"(CASE WHEN {first} + 320 > length({line}) THEN greatest(0, length({line}) - 320) ELSE {first} END)"
    return f"""CASE WHEN length({line}) <= 320 THEN {line} ELSE concat(
      CASE WHEN {begin} > 0 THEN '...' ELSE '' END, substr({line}, {begin} + 1, 320),
      CASE WHEN {begin} + 320 < length({line}) THEN '...' ELSE '' END) END"""


def search(table, q, case_sensitive=False, where="true", context=0, suffix="", columns=""):
    hit = f"contains(line, '{q}')" if case_sensitive else f"contains(lower(line), '{q.lower()}')"
    ctx = ""
    if context:
        def part(lo, hi):
            item = f"concat({lo} + i - 1, ':', {clip('l')})"
            return f"array_to_string(list_transform(ls[{lo}:{hi}], lambda l, i: {item}), chr(10))"
        ctx = f""", {part(f'greatest(1, line_no - {context})', 'line_no - 1')} AS context_before,
          {part('line_no + 1', f'line_no + {context}')} AS context_after"""
    return f"""{lines_of(f'(SELECT * FROM {table} WHERE {where})', 'tree_id, path, size, content')},
      hits AS (SELECT tree_id, path, line_no AS line, {excerpt('line', q, case_sensitive)} AS text, length(line) > 320 AS text_truncated,
        sha256(content) AS file_sha256, size AS bytes{ctx} FROM x WHERE {hit}){suffix}"""


MATCH = "tree_id, path, line, text, text_truncated, file_sha256, bytes"

# ---- symbols, imports, relations --------------------------------------------
# The definitions of symbols and import specifiers.
SCRIPT = [
    ("function", r"(?:export\s+)?(?:async\s+)?function\s+([A-Za-z_$][\w$]*)\s*\("),
    ("class", r"(?:export\s+)?(?:abstract\s+)?class\s+([A-Za-z_$][\w$]*)\b"),
    ("interface", r"(?:export\s+)?interface\s+([A-Za-z_$][\w$]*)\b"),
    ("type", r"(?:export\s+)?type\s+([A-Za-z_$][\w$]*)\b"),
    ("enum", r"(?:export\s+)?enum\s+([A-Za-z_$][\w$]*)\b"),
    ("constant", r"(?:export\s+)?const\s+([A-Za-z_$][\w$]*)\s*[=:]"),
]
PYTHON = [("class", r"^class\s+([A-Za-z_]\w*)\b"), ("function", r"^(?:async\s+)?def\s+([A-Za-z_]\w*)\s*\(")]
JAVA_T = r"(?:public\s+|protected\s+|private\s+|abstract\s+|final\s+|static\s+)*(class|interface|enum|record)\s+([A-Za-z_]\w*)\b"
JAVA_M = r"(?:public|protected|private|static|final|synchronized|abstract|\s)+[\w<>\[\], ?]+\s+([A-Za-z_]\w*)\s*\("


def symbols(before=KEPT, table="kept", lines=NUMBERED) -> str:
    parts = []
    for langs, rules in ((("javascript", "typescript"), SCRIPT), (("python",), PYTHON)):
        for kind, pattern in rules:
            parts.append(
                f"SELECT *, '{kind}' AS kind, regexp_extract(t, {regex(pattern)}, 1) AS name FROM gate WHERE language IN ({quoted(langs)})"
            )
    parts.append(
        f"SELECT *, regexp_extract(t, {regex(JAVA_T)}, 1) AS kind, regexp_extract(t, {regex(JAVA_T)}, 2) AS name FROM gate WHERE language = 'java'"
    )
    method = f"regexp_extract(t, {regex(JAVA_M)}, 1)"
    parts.append(
        f"""SELECT *, 'method' AS kind, CASE WHEN {method} IN ({quoted(K.JAVA_NOT_METHODS)}) THEN '' ELSE {method} END AS name
        FROM gate WHERE language = 'java' AND NOT regexp_matches(t, {regex(JAVA_T)})"""
    )
    union = " UNION ALL ".join(parts)
    return f"""{before}, {lines_of(table, 'tree_id, path, content', lines=lines)},
      gate AS (SELECT tree_id, path, line_no AS line, {language('path')} AS language, trim(line, {SPACES}) AS t, sha256(content) AS source_sha256
        FROM x WHERE trim(line, {SPACES}) <> '' AND NOT starts_with(trim(line, {SPACES}), '//') AND NOT starts_with(trim(line, {SPACES}), '#')),
      found AS ({union}),
      symbols AS (SELECT tree_id, path, line, language, kind, name, {clip('t')} AS signature, 'medium' AS confidence,
        concat('regex-', language, '-v1') AS extractor, source_sha256 FROM found WHERE name <> '')"""


SYMBOL = "tree_id, path, line, language, kind, name, signature, confidence, extractor, source_sha256"
IMPORTS = [
    r"""\bimport\s+(?:type\s+)?(?:[^'"]+\s+from\s+)?["'](\.{1,2}\/[^"']+)["']""",
    r"""\bexport\s+[^'"]+\s+from\s+["'](\.{1,2}\/[^"']+)["']""",
    r"""\brequire\(\s*["'](\.{1,2}\/[^"']+)["']\s*\)""",
    r"""\bimport\(\s*["'](\.{1,2}\/[^"']+)["']\s*\)""",
]


def normalized(p):
    """Fold of the segments into a '/'-joined stack."""
    parts = f"list_filter(string_split({p}, '/'), lambda s: s NOT IN ('', '.'))"
    step = """CASE WHEN x <> '..' OR acc = '' OR acc = '..' OR ends_with(acc, '/..')
      THEN concat(acc, CASE WHEN acc = '' THEN '' ELSE '/' END, x) ELSE regexp_replace(acc, '/?[^/]*$', '') END"""
    return f"list_reduce({parts}, lambda acc, x: {step}, '')"


def edges(before=KEPT, table="kept") -> str:
    found = ", ".join(f"regexp_extract_all(content, {regex(p)}, 1)" for p in IMPORTS)
    exts = list(K.RESOLVE_EXTENSIONS)
    candidates = ["base", *(f"concat(base, '{e}')" for e in exts), *(f"concat(base, '/index{e}')" for e in exts)]
    return f"""{before},
      imp AS (SELECT DISTINCT tree_id, path AS from_path, {language('path')} AS language, sha256(content) AS source_sha256,
        unnest(flatten([{found}])) AS specifier FROM {table} WHERE {language('path')} IN ({quoted(K.IMPORT_LANGUAGES)})),
      norm AS (SELECT *, {normalized(f"concat({dirname('from_path')}, '/', specifier)")} AS base FROM imp),
      cand AS (SELECT *, unnest([{', '.join(candidates)}]) AS cpath, unnest(range(0, {len(candidates)})) AS pos FROM norm),
      best AS (SELECT c.tree_id, c.from_path, c.specifier, arg_min(c.cpath, c.pos) AS to_path
        FROM cand c JOIN kept f ON f.tree_id = c.tree_id AND f.path = c.cpath GROUP BY ALL),
      edges AS (SELECT i.tree_id, i.from_path, i.specifier, i.language, i.source_sha256, b.to_path
        FROM imp i LEFT JOIN best b USING (tree_id, from_path, specifier))"""


def source_targets(where="true"):
    return f"targets AS (SELECT tree_id, path FROM kept WHERE {role('path')} = 'source' AND {where})"


ENTRY = f"targets AS (SELECT tree_id, min(path) AS path FROM kept WHERE {role('path')} = 'source' AND {language('path')} = 'typescript' GROUP BY tree_id)"


def relations() -> str:
    def rel(kind, confidence, path, evidence, sha, source):
        return f"""SELECT {source.split()[0]}.tree_id, t.path AS target_path, {path} AS path, '{kind}' AS relationship, {evidence} AS evidence,
          '{confidence}' AS confidence, {language(path)} AS language, {sha} AS source_sha256 FROM {source}"""
    ts, fs = "lower(" + stem("t.path") + ")", "lower(" + stem("f.path") + ")"
    fn = "lower(" + basename("f.path") + ")"
    null = "CAST(NULL AS VARCHAR)"
    return f"""rel AS (
      {rel('direct-import', 'high', 'e.to_path', 'e.specifier', 'e.source_sha256', 'e').replace('FROM e', 'FROM edges e JOIN targets t ON t.tree_id = e.tree_id AND t.path = e.from_path WHERE e.to_path IS NOT NULL')}
      UNION ALL {rel('imported-by', 'high', 'e.from_path', 'e.specifier', 'e.source_sha256', 'e').replace('FROM e', 'FROM edges e JOIN targets t ON t.tree_id = e.tree_id AND t.path = e.to_path WHERE e.from_path <> t.path')}
      UNION ALL {rel('likely-test', 'medium', 'f.path', f"'{K.TEST_EVIDENCE}'", null, 'f').replace('FROM f', 'FROM kept f JOIN targets t ON t.tree_id = f.tree_id AND t.path <> f.path')}
        WHERE {role('f.path')} = 'test' AND (regexp_replace({fs}, '(\\.test|\\.spec|test|spec)$', '') = {ts}
          OR contains({fn}, concat({ts}, '.test')) OR contains({fn}, concat({ts}, '.spec'))
          OR {fn} = concat({ts}, 'test', lower({extension('t.path')})))
      UNION ALL {rel('same-basename', 'low', 'f.path', f"concat('same basename as ', {basename('t.path')})", null, 'f').replace('FROM f', 'FROM kept f JOIN targets t ON t.tree_id = f.tree_id AND t.path <> f.path')}
        WHERE {fs} = {ts}
      UNION ALL {rel('sibling', 'low', 'f.path', f"concat('same directory ', {dirname('t.path')})", null, 'f').replace('FROM f', 'FROM kept f JOIN targets t ON t.tree_id = f.tree_id AND t.path <> f.path')}
        WHERE {dirname('f.path')} = {dirname('t.path')})"""


RELATION = "tree_id, target_path, path, relationship, evidence, confidence, language, source_sha256"
RELATED_ORDER = """PARTITION BY tree_id, target_path ORDER BY CASE WHEN relationship = 'direct-import' THEN 0 ELSE 1 END,
  CASE WHEN relationship = 'direct-import' THEN '' ELSE path END,
  list_position(['likely-test', 'same-basename', 'sibling', 'imported-by'], relationship), evidence"""

# ---- walks, fingerprints, coverage ------------------------------------------
PREFIXES = "list_transform(range(1, len(seg) + 1), lambda i: array_to_string(seg[1:i], '/'))"
WALK = f"""seg AS (SELECT tree_id, path, string_split(path, '/') AS seg FROM code),
  pruned0 AS (SELECT *, list_filter(range(1, len(seg) + 1), lambda i: {secret_name('seg[i]')} OR (i < len(seg) AND lower(seg[i]) IN ({GENERATED})))[1] AS cutoff FROM seg),
  pruned AS (SELECT DISTINCT tree_id, array_to_string(seg[1:cutoff], '/') AS prefix,
    CASE WHEN {secret_name('seg[cutoff]')} THEN 'secret' ELSE 'generated' END AS policy_class FROM pruned0 WHERE cutoff IS NOT NULL),
  dirs AS (SELECT DISTINCT tree_id, unnest(list_prepend('.', list_transform(range(1, coalesce(cutoff, len(seg))), lambda i: array_to_string(seg[1:i], '/')))) AS directory FROM pruned0)"""


def walk_key(p):
    return f"CASE WHEN {p} = '.' THEN CAST([] AS VARCHAR[]) ELSE string_split({p}, '/') END"


def cut_at(table, column, n):
    return f"""SELECT tree_id, key AS cut FROM (SELECT tree_id, {walk_key(column)} AS key,
      row_number() OVER (PARTITION BY tree_id ORDER BY {walk_key(column)}) AS rn FROM {table}) WHERE rn = {n + 1}"""


def fingerprint(entry):
    return f"sha256(string_agg(concat({entry}, chr(0)), '' ORDER BY {entry}))"


META = "concat(path, chr(9), 'file', chr(9), size, chr(9), chr(9), chr(9))"
CONTENT = "concat(path, chr(9), sha256(content), chr(9))"
ZERO_FLAGS = {n: "false" for n in K.FLAGS}


def coverage_row(values: dict[str, str], reasons: str, source: str) -> str:
    counters = ", ".join(f"CAST({values.get(n, '0')} AS BIGINT) AS {n}" for n in K.COUNTERS)
    flags = ", ".join(f"{values.get(n, 'false')} AS {n}" for n in K.FLAGS)
    return f"SELECT tree_id, {counters}, {flags}, {reasons} AS reasons, {values['coverage_partial']} AS partial FROM {source}"


def budget_run(where: str, p: str = "") -> str:
    """``granted``: files of 20,000 bytes, taken in order where they fit, and n, the lines left of 60; names start with ``p``."""
    return f"""{p}o AS (SELECT tree_id, path, content, size, len({NUMBERED}) AS n_lines, row_number() OVER (PARTITION BY tree_id ORDER BY path) AS rn FROM kept WHERE {where}),
      {p}run AS (SELECT tree_id, CAST(0 AS BIGINT) AS rn, CAST(20000 AS BIGINT) AS room, false AS taken FROM (SELECT DISTINCT tree_id FROM {p}o)
        UNION ALL SELECT o.tree_id, o.rn, CASE WHEN o.size <= r.room THEN r.room - o.size ELSE r.room END, o.size <= r.room
        FROM {p}run r JOIN {p}o o ON o.tree_id = r.tree_id AND o.rn = r.rn + 1),
      {p}taken AS (SELECT o.*, sum(n_lines) OVER (PARTITION BY o.tree_id ORDER BY o.rn ROWS UNBOUNDED PRECEDING) - n_lines AS lines_before
        FROM {p}o o JOIN {p}run r ON r.tree_id = o.tree_id AND r.rn = o.rn WHERE r.taken),
      {p}granted AS (SELECT *, 60 - lines_before AS n FROM {p}taken WHERE lines_before < 60)"""


def ledger(files: str, flag: str, reason: str, found: str) -> str:
    """A scan of ``files(tree_id, path, size, n_lines, hits, scans, rn)`` step by step, folded per tree into ``covered``.

    Limits are 3,000 bytes a file, 20,000 bytes, 60 lines and, where ``hits`` are counted, 6 of them.
    """
    reasons = f"""array_to_string(list_filter([CASE WHEN large > 0 THEN 'maxBytesPerFile' END, CASE WHEN {flag} THEN '{reason}' END,
      CASE WHEN over > 0 THEN 'maxTotalBytes' END, CASE WHEN line_limit_reached THEN 'maxTotalLines' END], lambda r: r IS NOT NULL), ',')"""
    same = {n: n for n in ("candidate_files", "scanned_files", "bytes_scanned", "skipped_secret", "skipped_generated", "line_limit_reached", flag)}
    part = f"large > 0 OR over > 0 OR line_limit_reached OR {flag}"
    row = coverage_row({**same, "byte_limit_reached": "large > 0 OR over > 0", "coverage_partial": part}, reasons, "per")
    return f"""o AS ({files}),
      run AS (SELECT tree_id, CAST(0 AS BIGINT) AS rn, CAST(20000 AS BIGINT) AS room, CAST(0 AS BIGINT) AS used, CAST(0 AS BIGINT) AS n_hits, CAST('' AS VARCHAR) AS ev,
          false AS cut, false AS many FROM (SELECT DISTINCT tree_id FROM o)
        UNION ALL SELECT tree_id, rn, CASE WHEN ev = 'read' THEN room - size ELSE room END, CASE WHEN ev = 'read' THEN used + g ELSE used END,
          CASE WHEN ev = 'read' THEN n_hits + h ELSE n_hits END, ev, ev = 'dry' OR (ev = 'read' AND g < n_lines), ev = 'read' AND n_hits + h > 6
        FROM (SELECT r.tree_id, o.rn, r.room, r.used, r.n_hits, o.size, o.n_lines, least(o.n_lines, 60 - r.used) AS g,
            len(list_filter(o.hits, lambda x: x <= 60 - r.used)) AS h,
            CASE WHEN NOT o.scans THEN 'other' WHEN r.used >= 60 THEN 'dry' WHEN o.size > 3000 THEN 'large' WHEN o.size > r.room THEN 'over' ELSE 'read' END AS ev
          FROM run r JOIN o ON o.tree_id = r.tree_id AND o.rn = r.rn + 1 WHERE NOT r.cut AND NOT r.many)),
      met AS (SELECT o.*, r.ev, r.cut, r.many FROM run r JOIN o USING (tree_id, rn)),
      {found}per AS (SELECT t.tree_id,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id) AS candidate_files,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'secret') AS skipped_secret,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'generated') AS skipped_generated,
        (SELECT count(*) FROM met m WHERE m.tree_id = t.tree_id AND ev = 'read') AS scanned_files,
        (SELECT coalesce(sum(size), 0) FROM met m WHERE m.tree_id = t.tree_id AND ev = 'read') AS bytes_scanned,
        (SELECT count(*) FROM met m WHERE m.tree_id = t.tree_id AND ev = 'large') AS large,
        (SELECT count(*) FROM met m WHERE m.tree_id = t.tree_id AND ev = 'over') AS over,
        (SELECT coalesce(bool_or(cut), false) FROM met m WHERE m.tree_id = t.tree_id) AS line_limit_reached,
        (SELECT coalesce(bool_or(many), false) FROM {'found_many' if found else 'met'} m WHERE m.tree_id = t.tree_id) AS {flag}
        FROM (SELECT DISTINCT tree_id FROM code) t),
      covered AS ({row})"""


def queries() -> dict[str, str]:
    sql: dict[str, str] = {}
    page = f"WITH {CODE}"
    keep = f"WITH {KEPT}"
    sql["classify_files"] = f"""{page} SELECT tree_id, path, size, {basename('path')} AS basename, {dirname('path')} AS directory,
      {extension('path')} AS extension, {stem('path')} AS stem,
      regexp_replace(lower({stem('path')}), '(\\.test|\\.spec|test|spec)$', '') AS test_stem,
      {language('path')} AS language, {role('path')} AS role FROM code"""
    sql["policy_class"] = f"{page} SELECT tree_id, path, {policy_class('path')} AS policy_class FROM code"
    sql["policy_additions"] = f"""{page} SELECT tree_id, path FROM code WHERE ({policy_class('path')}) IS NULL
      AND len(list_filter(string_split(path, '/')[:-2], lambda s: lower(s) IN ('docs'))) = 0
      AND NOT regexp_matches(path, '\\.py(/|$)') AND NOT contains(lower(path), 'workflows/ci')"""
    sql["policy_counts"] = f"{page}, {WALK} SELECT tree_id, policy_class, count(*) AS skipped FROM pruned GROUP BY ALL"
    sql["inventory"] = f"{keep} SELECT tree_id, path, size FROM kept"
    sql["inventory_scope"] = f"{keep} SELECT tree_id, path, size FROM kept WHERE path = 'src' OR starts_with(path, 'src/')"
    sql["inventory_contains"] = f"{keep} SELECT tree_id, path, size FROM kept WHERE contains(lower(path), 'mod1')"
    sql["filter_ext"] = f"{keep} SELECT tree_id, path, size FROM kept WHERE lower({extension('path')}) IN ('.ts', '.md')"
    sql["within_size"] = f"{keep} SELECT tree_id, path, size FROM kept WHERE size <= 2000"
    sql["relative_paths"] = f"{page} SELECT tree_id, path AS relative, concat('/data/trees/', tree_id, '/', path) AS location FROM code"
    sql["path_validation"] = f"""{page}, asked AS (SELECT tree_id, unnest([path, '/' || path, './' || path, '../' || path,
        path || '/../x', '../../' || path || '/../..', path || '/']) AS path FROM code),
      n AS (SELECT *, {normalized('path')} AS norm FROM asked)
      SELECT tree_id, path,
        CASE WHEN starts_with(path, '/') OR norm = '..' OR starts_with(norm, '../') THEN NULL WHEN norm = '' THEN '.' ELSE norm END AS clean_path,
        CASE WHEN starts_with(path, '/') THEN 'absolute-path' WHEN norm = '..' OR starts_with(norm, '../') THEN 'outside-tree' END AS path_error FROM n"""
    sql["directories"] = f"{page}, {WALK} SELECT tree_id, directory FROM dirs"
    # text
    sql["decode_status"] = f"""WITH {DOCS} SELECT tree_id, path,
      {REFUSAL} AS refusal,
      CASE WHEN starts_with(content, chr(65279)) THEN 'utf-8-bom' ELSE 'utf-8' END AS encoding FROM docs"""
    sql["content_sha256"] = f"{keep} SELECT tree_id, path, size, sha256(content) AS sha256 FROM kept"
    sql["page_sha256"] = f"WITH {PAGES} SELECT tree_id, path, size, sha256(content) AS sha256 FROM docs"
    sql["line_counts"] = f"{keep} SELECT tree_id, path, len({NUMBERED}) AS total_lines FROM kept"
    sql["file_lines"] = f"{keep}, {lines_of('kept')} SELECT tree_id, path, line_no, line FROM x"
    answer = "request_id, tree_id, path, status, sha256, bytes, total_lines, encoding, start_line, end_line, truncated_before, truncated_after, text"

    def ranges(expected, lines="wanted"):
        return f"""asked AS (SELECT doc_id AS request_id, tree_id, path, content, size, {expected} AS expected, {NUMBERED} AS ls, {policy_class('path')} AS pc,
            length(path) % 7 AS start0, size % 9 + 1 AS wanted FROM code),
          located AS (SELECT *, len(ls) AS n, greatest(1, least(start0, len(ls))) AS st FROM asked),
          judged AS (SELECT *, CASE WHEN pc IS NOT NULL THEN 'refused-' || pc WHEN lower(expected) <> sha256(content) THEN 'hash-mismatch' ELSE 'ok' END AS status FROM located)"""

    def answers(source, granted, more=""):
        last = f"least(n, st + {granted} - 1)"
        return f"""SELECT request_id, tree_id, path, status, CASE WHEN status IN ('ok', 'hash-mismatch') THEN sha256(content) END AS sha256,
          CASE WHEN status = 'ok' THEN size END AS bytes, CASE WHEN status = 'ok' THEN n END AS total_lines,
          CASE WHEN status = 'ok' THEN 'utf-8' END AS encoding, CASE WHEN status = 'ok' THEN st END AS start_line,
          CASE WHEN status = 'ok' THEN {last} END AS end_line, CASE WHEN status = 'ok' THEN st > 1 END AS truncated_before,
          CASE WHEN status = 'ok' THEN {last} < n END AS truncated_after,
          CASE WHEN status = 'ok' THEN array_to_string(list_transform(ls[st:{last}], lambda l, i: concat(st + i - 1, ': ', l)), chr(10)) END AS text{more} FROM {source}"""

    sql["read_ranges"] = f"{page}, {ranges('CAST(NULL AS VARCHAR)')} {answers('judged', 'wanted')}"
    sql["read_ranges_hash_check"] = f"""{page.replace('WITH ', 'WITH ')}, code1 AS (SELECT c.*, d.text FROM code c JOIN documents d USING (doc_id)),
      {ranges('upper(sha256(text))').replace('FROM code)', 'FROM code1)')} {answers('judged', 'wanted')}"""
    batch = f"""WITH RECURSIVE {CODE}, {ranges('CAST(NULL AS VARCHAR)')},
      seqd AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY request_id) AS rn, count(*) OVER (PARTITION BY tree_id) > 20 AS more FROM judged),
      first20 AS (SELECT * FROM seqd WHERE rn <= 20),
      run AS (
        SELECT tree_id, CAST(0 AS BIGINT) AS rn, CAST('' AS VARCHAR) AS st2, CAST(0 AS BIGINT) AS granted, CAST(0 AS BIGINT) AS used, CAST(0 AS BIGINT) AS spent FROM (SELECT DISTINCT tree_id FROM code)
        UNION ALL
        SELECT r.tree_id, f.rn, CASE WHEN r.used >= 60 THEN 'line-limit-reached' WHEN f.pc IS NULL AND r.spent + f.size > 20000 THEN 'byte-limit-reached' ELSE f.status END,
          CASE WHEN r.used < 60 AND f.pc IS NULL AND r.spent + f.size <= 20000 THEN least(f.wanted, 60 - r.used) ELSE 0 END,
          r.used + CASE WHEN r.used < 60 AND f.pc IS NULL AND r.spent + f.size <= 20000 THEN least(f.wanted, 60 - r.used, f.n - f.st + 1) ELSE 0 END,
          r.spent + CASE WHEN r.used < 60 AND f.pc IS NULL AND r.spent + f.size <= 20000 THEN f.size ELSE 0 END
        FROM run r JOIN first20 f ON f.tree_id = r.tree_id AND f.rn = r.rn + 1),
      served AS (SELECT f.* EXCLUDE (status), r.st2 AS status, r.granted,
        r.st2 = 'line-limit-reached' OR (r.st2 = 'ok' AND r.granted < f.wanted) AS line_limit_reached, f.more AS result_limit_reached
        FROM first20 f JOIN run r ON r.tree_id = f.tree_id AND r.rn = f.rn)"""
    sql["read_batch"] = f"{batch} {answers('served', 'granted', ', line_limit_reached, result_limit_reached, rn AS seq')}"
    reasons = """array_to_string(list_filter([CASE WHEN result_limit_reached THEN 'maxBatchRanges' END, CASE WHEN byte_limit_reached THEN 'maxTotalBytes' END,
      CASE WHEN line_limit_reached THEN 'maxTotalLines' END], lambda r: r IS NOT NULL), ',')"""
    per_batch = {n: n for n in ("scanned_files", "bytes_scanned", "skipped_unreadable", "result_limit_reached", "line_limit_reached", "byte_limit_reached")}
    part = "skipped_unreadable > 0 OR result_limit_reached OR line_limit_reached OR byte_limit_reached"
    sql["batch_coverage"] = f"""{batch}, per AS (SELECT tree_id, count(*) FILTER (WHERE status = 'ok') AS scanned_files,
        coalesce(sum(size) FILTER (WHERE status = 'ok'), 0) AS bytes_scanned, count(*) FILTER (WHERE starts_with(status, 'refused-')) AS skipped_unreadable,
        bool_or(result_limit_reached) AS result_limit_reached, bool_or(line_limit_reached) AS line_limit_reached,
        bool_or(status = 'byte-limit-reached') AS byte_limit_reached FROM served GROUP BY tree_id),
      covered AS ({coverage_row({**per_batch, "coverage_partial": part}, reasons, "per")})
      SELECT tree_id AS batch_id, * EXCLUDE (tree_id) FROM covered"""
    # search
    sql["search_lines"] = f"WITH {KEPT}, {search('kept', 'token')} SELECT {MATCH} FROM hits"
    sql["search_excerpt"] = f"WITH {KEPT}, {search('kept', 'the')} SELECT {MATCH} FROM hits"
    sql["search_case_sensitive"] = f"WITH {KEPT}, {search('kept', 'The', True)} SELECT {MATCH} FROM hits"
    sql["search_context"] = f"WITH {KEPT}, {search('kept', 'license', context=2)} SELECT {MATCH}, context_before, context_after FROM hits"
    sql["matched_files"] = f"""WITH {KEPT}, {search('kept', 'the')}
      SELECT tree_id, path, min(file_sha256) AS sha256, min(bytes) AS bytes, count(*) AS matches FROM hits GROUP BY tree_id, path"""
    sql["search_capped"] = f"""WITH {KEPT}, {search('kept', 'the')},
      ranked AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line) AS rank, count(*) OVER (PARTITION BY tree_id) > 25 AS match_limit_reached FROM hits)
      SELECT {MATCH}, rank, match_limit_reached FROM ranked WHERE rank <= 25"""
    sql["search_scoped"] = f"""WITH {KEPT}, {search('kept', 'a', where="starts_with(path, 'docs/') AND contains(lower(path), 'mod') AND lower(" + extension('path') + ") IN ('.md')")} SELECT {MATCH} FROM hits"""
    sql["search_documents"] = f"WITH {DOCS}, {search('docs', 'license')} SELECT {MATCH} FROM hits"
    sql["search_pages"] = f"WITH {PAGES}, {search('docs', 'href')} SELECT {MATCH} FROM hits"
    sql["search_conversations"] = f"WITH {TALKS}, {search('docs', 'the')} SELECT {MATCH} FROM hits"
    talk_prints = f"""{TALKS}, now AS (SELECT tree_id, {fingerprint(META)} AS fingerprint FROM docs GROUP BY tree_id),
      old AS (SELECT tree_id, {fingerprint(META)} AS fingerprint FROM docs WHERE NOT starts_with(path, 'system/') GROUP BY tree_id)"""
    sql["snapshot_check"] = f"""WITH {talk_prints} SELECT o.tree_id, o.fingerprint AS expected, n.fingerprint AS actual,
      CASE WHEN o.fingerprint = n.fingerprint THEN 'ok' ELSE 'snapshot-mismatch' END AS status FROM old o LEFT JOIN now n USING (tree_id)"""
    sql["search_expected"] = f"""WITH {talk_prints},
      agreed AS (SELECT d.* FROM docs d JOIN old o USING (tree_id) JOIN now n USING (tree_id) WHERE o.fingerprint = n.fingerprint),
      {search('agreed', 'the')} SELECT {MATCH} FROM hits"""
    plan = f"""{KEPT},
      facts AS (SELECT tree_id, path, size, content, size <= 3000 AS small, len({NUMBERED}) AS n_lines FROM kept),
      sums AS (SELECT *, sum(CASE WHEN small THEN size ELSE 0 END) OVER w AS bytes_upto, sum(CASE WHEN small THEN n_lines ELSE 0 END) OVER w AS lines_upto,
        sum(CASE WHEN small THEN len(list_filter({NUMBERED}, lambda l: contains(lower(l), 'the'))) ELSE 0 END) OVER w AS matches_upto, row_number() OVER w AS pos
        FROM facts WINDOW w AS (PARTITION BY tree_id ORDER BY path ROWS UNBOUNDED PRECEDING)),
      ends AS (SELECT tree_id, min(CASE WHEN small AND (bytes_upto > 20000 OR lines_upto - n_lines >= 200) THEN pos END) AS stop_before,
        min(CASE WHEN small AND (lines_upto > 200 OR matches_upto > 60) THEN pos END) AS stop_after FROM sums GROUP BY tree_id),
      seen AS (SELECT s.*, e.stop_before, e.stop_after, pos < coalesce(stop_before, 9999999999) AND pos <= coalesce(stop_after, 9999999999) AS reached,
        pos = stop_before AND stop_before <= coalesce(stop_after, 9999999999) AS stopper FROM sums s JOIN ends e USING (tree_id)),
      granted AS (SELECT tree_id, path, size, content, string_split_regex(content, '\r?\n')[1:200 - (lines_upto - n_lines)] AS ls FROM seen WHERE reached AND small),
      x AS (SELECT tree_id, path, size, content, line_no, ls[line_no] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS line_no FROM granted)),
      hits AS (SELECT tree_id, path, line_no AS line, {excerpt('line', 'the')} AS text, length(line) > 320 AS text_truncated, sha256(content) AS file_sha256, size AS bytes
        FROM x WHERE contains(lower(line), 'the')),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line) AS rank, count(*) OVER (PARTITION BY tree_id) > 60 AS match_limit_reached FROM hits)"""
    sql["search_budgeted"] = f"WITH {plan} SELECT {MATCH}, rank, match_limit_reached FROM ranked WHERE rank <= 60"
    cov = f"""{plan}, {WALK}, per AS (SELECT t.tree_id,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id) AS candidate_files,
        (SELECT count(*) FROM seen s WHERE s.tree_id = t.tree_id AND reached AND small) AS scanned_files,
        (SELECT coalesce(sum(size), 0) FROM seen s WHERE s.tree_id = t.tree_id AND reached AND small) AS bytes_scanned,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'secret') AS skipped_secret,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'generated') AS skipped_generated,
        (SELECT count(*) FROM seen s WHERE s.tree_id = t.tree_id AND reached AND NOT small) AS skipped_large,
        (SELECT coalesce(bool_or(stopper AND bytes_upto > 20000), false) FROM seen s WHERE s.tree_id = t.tree_id) AS byte_stop,
        (SELECT coalesce(bool_or((stopper AND bytes_upto <= 20000) OR (reached AND small AND lines_upto > 200)), false) FROM seen s WHERE s.tree_id = t.tree_id) AS line_limit_reached,
        (SELECT coalesce(bool_or(match_limit_reached), false) FROM ranked r WHERE r.tree_id = t.tree_id) AS match_limit_reached,
        (SELECT coalesce(bool_or(text_truncated), false) FROM ranked r WHERE r.tree_id = t.tree_id AND rank <= 60) AS excerpt_truncated
      FROM (SELECT DISTINCT tree_id FROM code) t),
      done AS (SELECT *, skipped_large > 0 OR byte_stop AS byte_limit_reached, skipped_large > 0 OR byte_stop OR line_limit_reached OR match_limit_reached AS part,
        array_to_string(list_filter([CASE WHEN excerpt_truncated THEN 'excerptTruncated' END, CASE WHEN skipped_large > 0 THEN 'maxBytesPerFile' END,
          CASE WHEN match_limit_reached THEN 'maxMatches' END, CASE WHEN byte_stop THEN 'maxTotalBytes' END,
          CASE WHEN line_limit_reached THEN 'maxTotalLines' END], lambda r: r IS NOT NULL), ',') AS reason FROM per)"""
    same = {n: n for n in ("candidate_files", "scanned_files", "bytes_scanned", "skipped_secret", "skipped_generated", "skipped_large",
                           "byte_limit_reached", "line_limit_reached", "match_limit_reached", "excerpt_truncated")}
    sql["search_coverage"] = f"WITH {cov} " + coverage_row({**same, "coverage_partial": "part"}, "reason", "done")
    # symbols
    sql["symbols"] = f"WITH {symbols()} SELECT {SYMBOL} FROM symbols"
    sql["symbols_filtered"] = f"""WITH {symbols()} SELECT {SYMBOL} FROM symbols WHERE kind = 'class'
      AND (contains(lower(name), 'mod') OR contains(lower(signature), 'mod'))"""
    sql["symbols_topk"] = f"""WITH {symbols()}, ranked AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line, kind, name) AS rank,
      count(*) OVER (PARTITION BY tree_id) > 12 AS symbol_limit_reached FROM symbols)
      SELECT {SYMBOL}, rank, symbol_limit_reached FROM ranked WHERE rank <= 12"""
    sql["unsupported_languages"] = f"""{keep} SELECT tree_id, {language('path')} AS language, count(*) AS files FROM kept
      WHERE {language('path')} NOT IN ({quoted(K.SYMBOL_LANGUAGES)}) GROUP BY ALL"""
    scripts = f"{language('path')} IN ({quoted(K.SYMBOL_LANGUAGES)})"
    allowed = f"RECURSIVE {KEPT}, {budget_run(scripts)}"
    everything = f"RECURSIVE {KEPT}, {budget_run('true')}"
    sql["scan_budget"] = f"WITH {everything} SELECT tree_id, path, n_lines AS total_lines, CAST(least(n_lines, n) AS BIGINT) AS granted_lines FROM granted"
    sql["symbols_budgeted"] = f"WITH {symbols(allowed, 'granted', NUMBERED + '[1:n]')} SELECT {SYMBOL} FROM symbols"
    spotted = f"""SELECT k.tree_id, k.path, size, len({NUMBERED}) AS n_lines, coalesce(hits, []) AS hits, {language('path')} AS lang,
      {language('path')} IN ({quoted(K.SYMBOL_LANGUAGES)}) AS scans, row_number() OVER (PARTITION BY k.tree_id ORDER BY k.path) AS rn
      FROM kept k LEFT JOIN (SELECT tree_id, path, list(line) AS hits FROM symbols GROUP BY ALL) USING (tree_id, path)"""
    sql["symbols_coverage"] = f"""WITH RECURSIVE {symbols()}, {WALK}, {ledger(spotted, 'symbol_limit_reached', 'maxSymbols', '')}
      SELECT c.*, coalesce((SELECT string_agg(concat(lang, '=', n), ',' ORDER BY lang) FROM
        (SELECT lang, count(*) AS n FROM met m WHERE m.tree_id = c.tree_id AND ev = 'other' GROUP BY lang)), '') AS unsupported_languages FROM covered c"""
    # imports and relations
    sql["import_edges"] = f"WITH {edges()} SELECT tree_id, from_path, specifier, language, source_sha256, to_path FROM edges"
    every = f"WITH {edges()}, {source_targets()}, {relations()} SELECT {RELATION} FROM rel WHERE relationship = "
    sql["direct_imports"] = every + "'direct-import'"
    sql["imported_by"] = every + "'imported-by'"
    sql["likely_tests"] = every + "'likely-test'"
    sql["same_basename"] = every + "'same-basename'"
    entry = f"WITH {edges()}, {ENTRY}, {relations()}"
    sql["siblings"] = f"{entry} SELECT {RELATION} FROM rel WHERE relationship = 'sibling'"
    sql["related"] = f"{entry} SELECT {RELATION} FROM rel"
    # An import stands in the first line of its file, so every file that is read keeps it.
    scanned = f"""SELECT k.tree_id, k.path, size, len({NUMBERED}) AS n_lines, CAST([] AS BIGINT[]) AS hits, {language('k.path')} IN ({quoted(K.IMPORT_LANGUAGES)}) AS scans,
      row_number() OVER (PARTITION BY k.tree_id ORDER BY k.path IS DISTINCT FROM t.path, k.path) AS rn FROM kept k LEFT JOIN targets t USING (tree_id)"""
    many = f"""edges AS (SELECT e.* FROM all_edges e JOIN met m ON m.tree_id = e.tree_id AND m.path = e.from_path WHERE ev = 'read'), {relations()},
      found_many AS (SELECT tree_id, count(*) > 5 AS many FROM rel GROUP BY tree_id), """
    sql["related_coverage"] = f"""WITH RECURSIVE {edges().replace('edges AS (SELECT i.', 'all_edges AS (SELECT i.')}, {WALK}, {ENTRY},
      {ledger(scanned, 'relationship_limit_reached', 'maxRelationships', many)} SELECT *, scanned_files AS scanned_import_files FROM covered"""
    sql["budgeted_imports"] = f"""WITH RECURSIVE {edges().replace('edges AS (SELECT i.', 'all_edges AS (SELECT i.')}, {WALK}, {ENTRY},
      {ledger(scanned, 'relationship_limit_reached', 'maxRelationships', many)}
      SELECT tree_id, from_path, specifier, language, source_sha256, to_path FROM edges"""
    sql["related_grouped_capped"] = f"""{entry}, named AS (SELECT *, dense_rank() OVER (PARTITION BY tree_id, target_path, relationship ORDER BY path) AS place FROM rel)
      SELECT tree_id, target_path, relationship, count(*) AS relations, max(place) > 2 AS paths_limit_reached,
        string_agg(DISTINCT path, ',' ORDER BY path) FILTER (WHERE place <= 2) AS paths FROM named GROUP BY tree_id, target_path, relationship"""
    sql["related_filtered"] = f"""{entry} SELECT {RELATION} FROM rel WHERE relationship IN ('direct-import', 'imported-by', 'likely-test')
      AND starts_with(path, 'src') AND lower({extension('path')}) IN ('.ts')"""
    sql["related_topk"] = f"""{entry}, ranked AS (SELECT *, row_number() OVER ({RELATED_ORDER}) AS rank,
      count(*) OVER (PARTITION BY tree_id, target_path) > 6 AS relationship_limit_reached FROM rel)
      SELECT {RELATION}, rank, relationship_limit_reached FROM ranked WHERE rank <= 6"""
    sql["related_grouped"] = f"""{entry}, ranked AS (SELECT *, row_number() OVER ({RELATED_ORDER}) AS rank FROM rel)
      SELECT tree_id, target_path, relationship, count(*) AS relations, string_agg(DISTINCT path, ',' ORDER BY path) AS paths
      FROM ranked WHERE rank <= 6 GROUP BY ALL"""
    sql["name_groups"] = f"""{keep} SELECT tree_id, path, count(*) OVER (PARTITION BY tree_id, {dirname('path')}) - 1 AS siblings,
      count(*) OVER (PARTITION BY tree_id, lower({stem('path')})) - 1 AS same_basename FROM kept"""
    sql["tested_stems"] = f"""{keep}, t AS (SELECT tree_id, path, lower({basename('path')}) AS name, lower({stem('path')}) AS st FROM kept WHERE {role('path')} = 'test'),
      marks AS (SELECT tree_id, path, unnest(list_transform(list_filter(range(2, length(name) + 1),
          lambda p: substr(name, p, 5) IN ('.test', '.spec')), lambda p: substr(name, 1, p - 1))) AS head FROM t),
      ends AS (SELECT tree_id, path, substr(head, i) AS tested_stem FROM (SELECT *, unnest(range(1, length(head) + 1)) AS i FROM marks)),
      free AS (SELECT DISTINCT tree_id, path, regexp_replace(st, '(\\.test|\\.spec|test|spec)$', '') AS tested_stem FROM t UNION SELECT * FROM ends)
      SELECT tree_id, path, tested_stem, CAST(NULL AS VARCHAR) AS tested_ext FROM free
      UNION ALL SELECT tree_id, path, left(st, length(st) - 4), lower({extension('path')}) FROM t
        WHERE ends_with(st, 'test') AND length(st) > 4 AND NOT EXISTS (SELECT 1 FROM free f WHERE f.tree_id = t.tree_id AND f.path = t.path AND f.tested_stem = left(st, length(st) - 4))"""
    # roll-ups
    sql["language_counts"] = f"{keep} SELECT tree_id, {language('path')} AS language, count(*) AS files FROM kept GROUP BY ALL"
    sql["role_counts"] = f"{keep} SELECT tree_id, {role('path')} AS role, count(*) AS files FROM kept GROUP BY ALL"
    sql["dir_roles"] = f"""{keep} SELECT tree_id, array_to_string(string_split(path, '/')[1:least(2, len(string_split(path, '/')) - 1)], '/') AS directory,
      {role('path')} AS role, count(*) AS files FROM kept WHERE contains(path, '/') GROUP BY ALL"""
    sql["dir_rollup"] = f"""{keep}, d AS (SELECT tree_id, string_split(path, '/')[1] AS directory, {role('path')} AS role, count(*) AS files
        FROM kept WHERE contains(path, '/') GROUP BY ALL)
      SELECT tree_id, directory, CAST(sum(files) AS BIGINT) AS files, string_agg(concat(role, '=', files), ',' ORDER BY role) AS roles FROM d GROUP BY ALL"""
    sql["role_top_n"] = f"""{keep}, r AS (SELECT tree_id, path, size, {language('path')} AS language, {role('path')} AS role FROM kept),
      n AS (SELECT *, row_number() OVER (PARTITION BY tree_id, role ORDER BY path) AS rank FROM r WHERE role IN ('manifest', 'ci', 'doc', 'test'))
      SELECT * FROM n WHERE rank <= 3"""
    sql["guidance"] = f"""{page}, g AS (SELECT tree_id, CASE WHEN NOT starts_with(path, 'docs/') THEN path WHEN lang = 'en' THEN 'AGENTS.md' WHEN lang = 'fr' THEN concat('.agents/skills/', doc_id, '.md')
        WHEN lang = 'de' THEN 'WORKFLOW.md' ELSE path END AS path FROM code)
      SELECT DISTINCT tree_id, CASE WHEN starts_with(path, '.agents/skills/') THEN '.agents/skills' ELSE path END AS guidance FROM g
      WHERE path IN ('AGENTS.md', 'WORKFLOW.md') OR starts_with(path, '.agents/skills/')"""
    # caps
    cap = f"{KEPT}, cut AS ({cut_at('kept', 'path', 15)})"
    sql["inventory_cap"] = f"""WITH {cap} SELECT k.tree_id, path, size FROM kept k LEFT JOIN cut USING (tree_id)
      WHERE cut IS NULL OR string_split(path, '/') < cut"""
    sql["dir_cap"] = f"""WITH {KEPT}, {WALK}, cut AS ({cut_at('dirs', 'directory', 7)}) SELECT k.tree_id, path, size FROM kept k LEFT JOIN cut USING (tree_id)
      WHERE cut IS NULL OR string_split(path, '/') < cut"""
    walk_cov = f"""WITH {KEPT}, {WALK}, cf AS ({cut_at('kept', 'path', 15)}), cd AS ({cut_at('dirs', 'directory', 7)}),
      cut AS (SELECT tree_id, min(cut) AS cut, arg_min(reason, cut) AS reason FROM (SELECT *, 'maxFiles' AS reason FROM cf UNION ALL SELECT *, 'maxDirectories' FROM cd) GROUP BY tree_id),
      per AS (SELECT t.tree_id, c.reason,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id AND (c.cut IS NULL OR string_split(k.path, '/') <= c.cut)) AS candidate_files,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'secret' AND (c.cut IS NULL OR string_split(prefix, '/') < c.cut)) AS skipped_secret,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'generated' AND (c.cut IS NULL OR string_split(prefix, '/') < c.cut)) AS skipped_generated
        FROM (SELECT DISTINCT tree_id FROM code) t LEFT JOIN cut c USING (tree_id))"""
    walk_same = {n: n for n in ("candidate_files", "skipped_secret", "skipped_generated")}
    sql["files_coverage"] = f"{walk_cov} " + coverage_row(
        {**walk_same, "inventory_limit_reached": "reason IS NOT NULL", "coverage_partial": "reason IS NOT NULL"}, "coalesce(reason, '')", "per")
    sql["capped_inventory"] = walk_cov.split("      per AS (")[0].rstrip().rstrip(",") + """ SELECT k.tree_id, path, size FROM kept k LEFT JOIN cut USING (tree_id)
      WHERE cut IS NULL OR string_split(path, '/') < cut"""
    free = walk_cov.replace("LEFT JOIN cut c USING", "LEFT JOIN (SELECT * FROM cut WHERE false) c USING")
    free_row = coverage_row({**walk_same, "coverage_partial": "false"}, "''", "per")
    sql["with_unsupported"] = f"""{free}, covered AS ({free_row}) SELECT c.*, coalesce((SELECT string_agg(concat(lang, '=', n), ',' ORDER BY lang) FROM
      (SELECT {language('path')} AS lang, count(*) AS n FROM kept k WHERE k.tree_id = c.tree_id GROUP BY 1) WHERE lang NOT IN ({quoted(K.SYMBOL_LANGUAGES)})), '') AS unsupported_languages FROM covered c"""
    named = quoted(["src", "src/mod0.ts", ".", "./docs/../lib", "gone", "src/mod", "conf/env7/.env", ".ssh/key", "node_modules/pkg6", "../x", "/src"])
    sql["scope_status"] = f"""{page}, asked AS (SELECT tree_id, unnest([{named}]) AS path FROM (SELECT DISTINCT tree_id FROM code)),
      n AS (SELECT *, CASE WHEN {normalized('path')} = '' THEN '.' ELSE {normalized('path')} END AS clean FROM asked)
      SELECT tree_id, path, CASE WHEN starts_with(path, '/') THEN 'absolute-path' WHEN clean = '..' OR starts_with(clean, '../') THEN 'outside-tree'
        WHEN ({policy_class('clean')}) IS NOT NULL THEN 'refused-' || ({policy_class('clean')})
        WHEN clean = '.' OR EXISTS (FROM code c WHERE c.tree_id = n.tree_id AND (c.path = clean OR starts_with(c.path, concat(clean, '/')))) THEN 'ok' ELSE 'missing' END AS status FROM n"""
    running = "PARTITION BY tree_id ORDER BY path ROWS UNBOUNDED PRECEDING"
    sql["budget_bytes_prefix"] = f"""{keep}, r AS (SELECT tree_id, path, size, CAST(sum(size) OVER ({running}) AS BIGINT) AS bytes_upto FROM kept)
      SELECT * FROM r WHERE bytes_upto <= 20000"""
    sql["budget_lines_prefix"] = f"""{keep}, f AS (SELECT tree_id, path, len({NUMBERED}) AS total_lines FROM kept),
      r AS (SELECT *, sum(total_lines) OVER ({running}) - total_lines AS before FROM f)
      SELECT tree_id, path, total_lines, CAST(least(total_lines, 100 - before) AS BIGINT) AS granted_lines FROM r WHERE before < 100"""
    sql["budget_bytes_greedy"] = f"""WITH RECURSIVE {KEPT}, o AS (SELECT tree_id, path, size, row_number() OVER (PARTITION BY tree_id ORDER BY path) AS rn FROM kept),
      run AS (SELECT tree_id, CAST(0 AS BIGINT) AS rn, CAST(20000 AS BIGINT) AS room, false AS taken FROM (SELECT DISTINCT tree_id FROM o)
        UNION ALL SELECT o.tree_id, o.rn, CASE WHEN o.size <= r.room THEN r.room - o.size ELSE r.room END, o.size <= r.room
        FROM run r JOIN o ON o.tree_id = r.tree_id AND o.rn = r.rn + 1)
      SELECT o.tree_id, o.path, o.size FROM o JOIN run r ON r.tree_id = o.tree_id AND r.rn = o.rn WHERE r.taken"""
    # fingerprints
    sql["metadata_fingerprint"] = f"{keep} SELECT tree_id, {fingerprint(META)} AS fingerprint, count(*) AS entries FROM kept GROUP BY tree_id"
    sql["metadata_fingerprint_with_directories"] = f"""{keep}, seg AS (SELECT tree_id, string_split(path, '/') AS seg FROM kept),
      d AS (SELECT DISTINCT tree_id, unnest(list_prepend('.', list_transform(range(1, len(seg)), lambda i: array_to_string(seg[1:i], '/')))) AS directory FROM seg),
      e AS (SELECT tree_id, {META} AS entry FROM kept UNION ALL SELECT tree_id, concat(directory, chr(9), 'directory', chr(9), '0', chr(9), chr(9), chr(9)) FROM d)
      SELECT tree_id, {fingerprint('entry')} AS fingerprint, count(*) AS entries FROM e GROUP BY tree_id"""
    sql["content_fingerprint"] = f"{keep} SELECT tree_id, {fingerprint(CONTENT)} AS fingerprint, count(*) AS entries FROM kept GROUP BY tree_id"
    sql["layered_fingerprint"] = f"""{keep}, e AS (SELECT tree_id, left(sha256(path), 5) AS bucket, {CONTENT} AS entry FROM kept),
      l1 AS (SELECT tree_id, bucket, {fingerprint('entry')} AS d, count(*) AS n FROM e GROUP BY ALL),
      l2e AS (SELECT tree_id, left(bucket, 3) AS grp, concat(bucket, chr(9), d) AS entry, n FROM l1),
      l2 AS (SELECT tree_id, grp, {fingerprint('entry')} AS d, sum(n) AS n FROM l2e GROUP BY ALL),
      l3e AS (SELECT tree_id, concat(grp, chr(9), d) AS entry, n FROM l2)
      SELECT tree_id, {fingerprint('entry')} AS fingerprint, CAST(sum(n) AS BIGINT) AS entries FROM l3e GROUP BY tree_id"""
    sql["range_fingerprint"] = f"""{page}, {ranges('CAST(NULL AS VARCHAR)')}, e AS (SELECT tree_id,
        concat(path, chr(9), sha256(content), chr(9), st, '-', least(n, st + wanted - 1)) AS entry FROM judged WHERE status = 'ok')
      SELECT tree_id, {fingerprint('entry')} AS fingerprint, count(*) AS entries FROM e GROUP BY tree_id"""
    sql["snapshot"] = f"""{keep}, s AS (SELECT tree_id, {fingerprint(CONTENT)} AS fingerprint FROM kept WHERE size <= 5000 GROUP BY tree_id),
      m AS (SELECT tree_id, max(size) > 5000 AS part FROM kept GROUP BY tree_id)
      SELECT m.tree_id, coalesce(s.fingerprint, sha256('')) AS fingerprint, CASE WHEN part THEN 'partial-content' ELSE 'content' END AS fingerprint_kind,
        '.' AS fingerprint_scope, NOT part AS complete, CASE WHEN part THEN 'maxBytesPerFile' ELSE '' END AS truncation_reasons
      FROM m LEFT JOIN s USING (tree_id)"""
    sql["snapshot_compare"] = f"""WITH {LATER}, older AS (SELECT tree_id, {fingerprint(CONTENT)} AS before_fingerprint FROM kept GROUP BY tree_id),
      newer AS (SELECT tree_id, {fingerprint(CONTENT)} AS after_fingerprint FROM later GROUP BY tree_id)
      SELECT tree_id, before_fingerprint, after_fingerprint, before_fingerprint IS DISTINCT FROM after_fingerprint AS changed FROM older FULL JOIN newer USING (tree_id)"""
    sql["snapshot_verify"] = f"""WITH {LATER}, older AS (SELECT tree_id, {fingerprint(META)} AS before_fingerprint FROM kept GROUP BY tree_id),
      newer AS (SELECT tree_id, {fingerprint(META)} AS after_fingerprint FROM later GROUP BY tree_id)
      SELECT tree_id, before_fingerprint AS fingerprint, 'metadata' AS fingerprint_kind, '.' AS fingerprint_scope, true AS complete,
        CASE WHEN before_fingerprint IS DISTINCT FROM after_fingerprint THEN 'snapshotChanged' ELSE '' END AS truncation_reasons,
        before_fingerprint, after_fingerprint, before_fingerprint IS DISTINCT FROM after_fingerprint AS changed,
        before_fingerprint IS NOT DISTINCT FROM after_fingerprint AS stable,
        CASE WHEN before_fingerprint IS DISTINCT FROM after_fingerprint THEN 'stale-snapshot' ELSE 'ok' END AS status
      FROM older LEFT JOIN newer USING (tree_id)"""
    sql["snapshot_diff"] = f"""WITH {LATER}, older AS (SELECT tree_id, path, sha256(content) AS before_sha256 FROM kept),
      newer AS (SELECT tree_id, path, sha256(content) AS after_sha256 FROM later)
      SELECT tree_id, path, before_sha256, after_sha256, CASE WHEN before_sha256 IS NULL THEN 'added' WHEN after_sha256 IS NULL THEN 'removed'
        WHEN before_sha256 <> after_sha256 THEN 'modified' ELSE 'same' END AS status FROM older FULL JOIN newer USING (tree_id, path)"""
    read_per = f"""WITH {KEPT}, {WALK}, per AS (SELECT t.tree_id,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id) AS candidate_files,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id AND size <= 5000) AS scanned_files,
        (SELECT coalesce(sum(size), 0) FROM kept k WHERE k.tree_id = t.tree_id AND size <= 5000) AS bytes_scanned,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id AND size > 5000) AS skipped_large,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'secret') AS skipped_secret,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'generated') AS skipped_generated
        FROM (SELECT DISTINCT tree_id FROM code) t)"""
    read_same = {n: n for n in ("candidate_files", "scanned_files", "bytes_scanned", "skipped_large", "skipped_secret", "skipped_generated")}
    read_same |= {"byte_limit_reached": "skipped_large > 0", "coverage_partial": "skipped_large > 0"}
    read_reason = "CASE WHEN skipped_large > 0 THEN 'maxBytesPerFile' ELSE '' END"
    sql["read_coverage"] = f"{read_per} " + coverage_row(read_same, read_reason, "per")
    counters = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in K.COUNTERS)
    flags = ", ".join(f"bool_or({n}) AS {n}" for n in K.FLAGS)
    walk_part = walk_cov[len("WITH "):].replace("per AS", "wper AS").replace("cf AS", "wcf AS").replace("FROM cf", "FROM wcf")
    both = f"{read_per}, r AS ({coverage_row(read_same, read_reason, 'per')}), " + walk_part.split(WALK + ",", 1)[1]
    both += ", w AS (" + coverage_row(
        {**walk_same, "inventory_limit_reached": "reason IS NOT NULL", "coverage_partial": "reason IS NOT NULL"}, "coalesce(reason, '')", "wper") + ")"
    sql["merge_coverage"] = f"""{both}, u AS (SELECT * FROM r UNION ALL SELECT * FROM w)
      SELECT tree_id, {counters}, {flags}, coalesce(string_agg(DISTINCT reasons, ',' ORDER BY reasons) FILTER (WHERE reasons <> ''), '') AS reasons,
        bool_or(partial) AS partial FROM u GROUP BY tree_id"""
    # files of every branch
    varied = f"WITH {VARIED}"
    sql["varied_classify"] = f"""{varied} SELECT tree_id, path, size, {basename('path')} AS basename, {dirname('path')} AS directory, {extension('path')} AS extension,
      {stem('path')} AS stem, regexp_replace(lower({stem('path')}), '(\\.test|\\.spec|test|spec)$', '') AS test_stem, {language('path')} AS language, {role('path')} AS role FROM code"""
    sql["varied_decode"] = f"""{varied} SELECT tree_id, path, {REFUSAL} AS refusal, CASE WHEN ({REFUSAL}) IS NULL THEN
      CASE WHEN starts_with(content, chr(65279)) THEN 'utf-8-bom' ELSE 'utf-8' END END AS encoding FROM code"""
    sql["varied_lines"] = f"{varied}, {lines_of('readable', lines=BODY_LINES)} SELECT tree_id, path, line_no, line FROM x"
    sql["varied_symbols"] = f"WITH {symbols(VARIED, 'readable', BODY_LINES)} SELECT {SYMBOL} FROM symbols"
    varied_edges = edges(VARIED, "readable")
    sql["varied_imports"] = f"WITH {varied_edges} SELECT tree_id, from_path, specifier, language, source_sha256, to_path FROM edges"
    capped = f"""WITH {varied_edges}, {source_targets()}, {relations()}, ranked AS (SELECT *, row_number() OVER (PARTITION BY tree_id, target_path, relationship ORDER BY path) AS rank,
      count(*) OVER (PARTITION BY tree_id, target_path, relationship) AS n FROM rel)"""
    for name, kind, most in (("likely_tests_capped", "likely-test", 2), ("same_basename_capped", "same-basename", 3), ("siblings_capped", "sibling", 2)):
        sql[name] = f"{capped} SELECT {RELATION}, rank, n > {most} AS relationship_limit_reached FROM ranked WHERE relationship = '{kind}' AND rank <= {most}"
    sql["varied_search"] = f"""{varied}, {search('readable', 'import').replace(NUMBERED, BODY_LINES)},
      ranked AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line) AS rank, count(*) OVER (PARTITION BY tree_id) > 4 AS match_limit_reached FROM hits)
      SELECT {MATCH}, rank, match_limit_reached FROM ranked WHERE rank <= 4"""
    varied_per = f"""{varied}, {WALK}, per AS (SELECT t.tree_id,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id) AS candidate_files,
        (SELECT count(*) FROM readable k WHERE k.tree_id = t.tree_id) AS scanned_files,
        (SELECT coalesce(sum(size), 0) FROM readable k WHERE k.tree_id = t.tree_id) AS bytes_scanned,
        (SELECT count(*) FROM kept k WHERE k.tree_id = t.tree_id AND ({REFUSAL}) IS NOT NULL) AS skipped_unreadable,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'secret') AS skipped_secret,
        (SELECT count(*) FROM pruned p WHERE p.tree_id = t.tree_id AND policy_class = 'generated') AS skipped_generated
        FROM (SELECT DISTINCT tree_id FROM code) t)"""
    varied_same = {n: n for n in ("candidate_files", "scanned_files", "bytes_scanned", "skipped_unreadable", "skipped_secret", "skipped_generated")}
    sql["varied_coverage"] = f"{varied_per} " + coverage_row({**varied_same, "coverage_partial": "skipped_unreadable > 0"}, "''", "per")
    # directories from the deepest level up; no path of the files has more than three directories
    def directory_prints(before, source, sha):
        levels, union = [f"f AS (SELECT tree_id, {dirname('path')} AS directory, concat({basename('path')}, chr(9), 'file', chr(9), {sha}) AS entry FROM {source})"], []
        for depth in (3, 2, 1, 0):
            here = f"CASE WHEN directory = '.' THEN 0 ELSE len(string_split(directory, '/')) END = {depth}"
            child = f" UNION ALL SELECT tree_id, {dirname('directory')}, concat({basename('directory')}, chr(9), 'directory', chr(9), fingerprint) FROM d{depth + 1}" if depth < 3 else ""
            levels.append(f"d{depth} AS (SELECT tree_id, directory, {fingerprint('entry')} AS fingerprint, count(*) AS entries FROM (SELECT tree_id, directory, entry FROM f WHERE {here}{child}) GROUP BY ALL)")
            union.append(f"SELECT * FROM d{depth}")
        return f"{before}, {', '.join(levels)}, dirs_of AS ({' UNION ALL '.join(union)})"
    sql["directory_fingerprint"] = f"WITH {directory_prints(KEPT, 'kept', 'sha256(content)')} SELECT tree_id, directory, fingerprint, entries FROM dirs_of"
    two = f"""WITH {LATER}, older AS (SELECT tree_id, path, sha256(content) AS before_sha256 FROM kept),
      newer AS (SELECT tree_id, path, sha256(content) AS after_sha256 FROM later),
      compared AS (SELECT tree_id, path, before_sha256, after_sha256, CASE WHEN before_sha256 IS NULL THEN 'added' WHEN after_sha256 IS NULL THEN 'removed'
        WHEN before_sha256 <> after_sha256 THEN 'modified' ELSE 'same' END AS status FROM older FULL JOIN newer USING (tree_id, path)),
      moved AS (SELECT DISTINCT tree_id, {dirname('path')} AS directory FROM compared WHERE status <> 'same')"""
    # A directory differs if a file in it or below it does.
    sql["snapshot_diff_pruned"] = f"""{two} SELECT c.* FROM compared c WHERE EXISTS (FROM moved m WHERE m.tree_id = c.tree_id AND
      ({dirname('c.path')} = '.' OR m.directory = {dirname('c.path')} OR starts_with(m.directory, concat({dirname('c.path')}, '/'))))"""
    sql["snapshot_diff_trees"] = f"{two} SELECT c.* FROM compared c WHERE c.tree_id IN (SELECT tree_id FROM moved)"
    # reports
    sql["outline"] = f"""WITH {cap}, listed AS (SELECT k.*, row_number() OVER (PARTITION BY k.tree_id ORDER BY path) AS rank FROM kept k LEFT JOIN cut USING (tree_id)
        WHERE cut IS NULL OR string_split(path, '/') < cut),
      prints AS (SELECT k.tree_id, {fingerprint(META)} AS fingerprint FROM kept k LEFT JOIN cut USING (tree_id)
        WHERE cut IS NULL OR string_split(path, '/') <= cut GROUP BY k.tree_id)
      SELECT l.tree_id, p.fingerprint, string_agg(concat(path, ':', size), ',' ORDER BY rank) AS files_sample,
        l.tree_id IN (SELECT tree_id FROM cut) AS inventory_limit_reached
      FROM listed l JOIN prints p USING (tree_id) WHERE rank <= 10 GROUP BY ALL"""
    cls = f"cls AS (SELECT tree_id, path, size, {language('path')} AS language, {role('path')} AS role FROM kept)"
    item = "concat(path, ':', size, ':', language, ':', role)"
    lists = ", ".join(
        f"""(SELECT coalesce(string_agg({item}, ',' ORDER BY path), '') FROM (SELECT *, row_number() OVER (ORDER BY path) AS rn FROM cls c WHERE c.tree_id = t.tree_id{cond}) WHERE rn <= {n}) AS {name}"""
        for name, cond, n in (("files", "", K.MAP_FILES), *((name, f" AND role = '{r}'", K.MAP_ROLE_LIST) for r, name in
                              (("manifest", "manifests"), ("ci", "ci"), ("doc", "docs"), ("test", "tests"))))
    )
    sql["corpus_map"] = f"""WITH {symbols()}, {cls},
      dr AS (SELECT tree_id, array_to_string(string_split(path, '/')[1:least(2, len(string_split(path, '/')) - 1)], '/') AS directory, count(*) AS n FROM kept WHERE contains(path, '/') GROUP BY ALL)
      SELECT t.tree_id, {lists},
        (SELECT string_agg(concat(directory, '=', n), ',' ORDER BY directory) FROM (SELECT *, row_number() OVER (ORDER BY directory) AS rn FROM dr WHERE dr.tree_id = t.tree_id) WHERE rn <= {K.MAP_DIRECTORIES}) AS directories,
        (SELECT string_agg(concat(language, '=', n), ',' ORDER BY language) FROM (SELECT language, count(*) AS n FROM cls WHERE cls.tree_id = t.tree_id GROUP BY 1)) AS languages,
        (SELECT string_agg(concat(role, '=', n), ',' ORDER BY role) FROM (SELECT role, count(*) AS n FROM cls WHERE cls.tree_id = t.tree_id GROUP BY 1)) AS roles,
        (SELECT string_agg(concat(path, ':', line, ':', kind, ':', name), ',' ORDER BY path, line, kind, name) FROM
          (SELECT *, row_number() OVER (ORDER BY path, line, kind, name) AS rn FROM symbols s WHERE s.tree_id = t.tree_id) WHERE rn <= {K.MAP_SYMBOLS}) AS symbols
      FROM (SELECT DISTINCT tree_id FROM kept) t"""
    sql["outline_report"] = f"""{walk_cov}, prints AS (SELECT k.tree_id, {fingerprint(META)} AS fingerprint FROM kept k LEFT JOIN cut USING (tree_id)
        WHERE cut IS NULL OR string_split(path, '/') <= cut GROUP BY k.tree_id),
      listed AS (SELECT k.tree_id, path, row_number() OVER (PARTITION BY k.tree_id ORDER BY path) AS rank FROM kept k LEFT JOIN cut USING (tree_id)
        WHERE cut IS NULL OR string_split(path, '/') < cut)
      SELECT p.tree_id, r.fingerprint, (SELECT coalesce(string_agg(path, ',' ORDER BY rank), '') FROM listed l WHERE l.tree_id = p.tree_id AND rank <= 10) AS sample,
        reason IS NOT NULL AS inventory_limit_reached, 'metadata' AS fingerprint_kind, '.' AS fingerprint_scope, reason IS NULL AS complete,
        candidate_files, skipped_secret, skipped_generated, reason IS NOT NULL AS partial, coalesce(reason, '') AS reasons
      FROM per p JOIN prints r USING (tree_id)"""
    sql["map_report"] = f"""WITH RECURSIVE {symbols()}, {WALK}, {ledger(spotted, 'symbol_limit_reached', 'maxSymbols', '')},
      {budget_run(f"size <= 3000 AND {scripts}", "b")},
      shown AS (SELECT s.*, row_number() OVER (PARTITION BY s.tree_id ORDER BY s.path, s.line, s.kind, s.name) AS rank FROM symbols s JOIN bgranted g USING (tree_id, path) WHERE s.line <= g.n),
      prints AS (SELECT tree_id, {fingerprint(META)} AS fingerprint FROM kept GROUP BY tree_id),
      read_prints AS (SELECT tree_id, sha256(string_agg(concat(path, chr(9), sha256(content), chr(9), chr(0)), '' ORDER BY concat(path, chr(9), sha256(content), chr(9)))) AS symbol_fingerprint
        FROM bgranted GROUP BY tree_id)
      SELECT c.tree_id, c.candidate_files AS total_files, coalesce(rp.symbol_fingerprint, sha256('')) AS symbol_fingerprint,
        (SELECT count(*) FROM shown s WHERE s.tree_id = c.tree_id) > 6 AS symbols_limit_reached, p.fingerprint, NOT c.partial AS complete,
        (SELECT coalesce(string_agg(concat(path, ':', line, ':', name), ',' ORDER BY rank), '') FROM shown s WHERE s.tree_id = c.tree_id AND rank <= 6) AS symbols,
        c.scanned_files, c.bytes_scanned, c.line_limit_reached, c.symbol_limit_reached, c.byte_limit_reached, c.partial, c.reasons,
        coalesce((SELECT string_agg(concat(lang, '=', n), ',' ORDER BY lang) FROM (SELECT lang, count(*) AS n FROM met m WHERE m.tree_id = c.tree_id AND ev = 'other' GROUP BY lang)), '') AS unsupported_languages
      FROM covered c JOIN prints p USING (tree_id) LEFT JOIN read_prints rp USING (tree_id)"""
    n_role = lambda r: f"(SELECT count(*) FROM cls c WHERE c.tree_id = t.tree_id AND role = '{r}')"
    roles = {"manifests": "manifest", "ci": "ci", "docs": "doc", "tests": "test"}
    sql["corpus_map_flags"] = f"""WITH {symbols()}, {cls},
      dr AS (SELECT DISTINCT tree_id, array_to_string(string_split(path, '/')[1:least(2, len(string_split(path, '/')) - 1)], '/') AS directory FROM kept WHERE contains(path, '/')),
      n AS (SELECT t.tree_id, (SELECT count(*) FROM cls WHERE cls.tree_id = t.tree_id) AS total_files, (SELECT count(*) FROM dr WHERE dr.tree_id = t.tree_id) AS n_dirs,
        (SELECT count(*) FROM symbols s WHERE s.tree_id = t.tree_id) AS n_sym, {", ".join(f"{n_role(r)} AS r_{n}" for n, r in roles.items())} FROM (SELECT DISTINCT tree_id FROM code) t)
      SELECT tree_id, total_files, total_files > 40 AS files_limit_reached, n_dirs > 30 AS directories_limit_reached, n_sym > 45 AS symbols_limit_reached,
        {", ".join(f"r_{n} > 4 AS {n}_limit_reached, least(r_{n}, 4) AS n_{n}" for n in roles)}, least(total_files, 40) AS n_files, least(n_sym, 45) AS n_symbols FROM n"""
    return sql
