"""Fixed values.

Everything in this module is a fixed value: the word lists, tables, limits and
patterns below decide which rows come out, so they are stated as plain text.
Regular expressions use ``\\s`` and ``\\b`` in their ASCII/ECMAScript meaning;
``treelens.functions.regex`` turns them into the dialect of the JVM.
"""

# ---- path policy ----------------------------------------------------------
GENERATED_DIRS = (
    ".git", "node_modules", "dist", "build", "target", ".gradle", ".oc_learning",
    ".next", ".nuxt", ".turbo", ".cache", "coverage", ".venv", "venv", "__pycache__",
    ".pytest_cache", ".mypy_cache", ".ruff_cache", ".idea", ".vscode", "Pods",
)
SECRET_DIRS = (".ssh", ".gnupg", ".aws", ".azure", ".kube")
SECRET_NAMES = (
    ".env", ".git-credentials", ".netrc", ".npmrc", ".pypirc", "auth.json",
    "credentials", "credentials.ini", "credentials.json", "credentials.toml",
    "credentials.yaml", "credentials.yml", "gradle.properties", "id_dsa",
    "id_ecdsa", "id_ed25519", "id_rsa", "local.properties", "nuget.config",
    "pip.conf", "secrets.json", "secrets.toml", "secrets.yaml", "secrets.yml",
    "settings-security.xml", "settings.xml",
)
SECRET_EXTENSIONS = (".key", ".keystore", ".jks", ".p8", ".p12", ".pem", ".pfx", ".kdbx")
# Patterns over a path whose segments are delimited by "/", matched ignoring ASCII case.
SECRET_PATH_REGEXES = (
    r"(?:^|/)credentials\.(?:cfg|conf|ini|json|toml|txt|ya?ml)(?:/|\z)",
    r"(?:^|/)secrets?\.(?:cfg|conf|ini|json|toml|txt|ya?ml)(?:/|\z)",
    r"(?:^|[-_./])private[-_.]?key(?:\z|[-_./])",
    r"(?:^|[-_./])service[-_.]?account(?:\z|[-_./])",
)
# ".env.<anything>" is secret-like, this one name is not.
ENV_PREFIX, ENV_ALLOWED = ".env.", "example"

# ---- classification -------------------------------------------------------
LANGUAGE_BY_EXTENSION = {
    ".cjs": "javascript", ".css": "css", ".go": "go", ".java": "java",
    ".js": "javascript", ".json": "json", ".jsx": "javascript", ".kt": "kotlin",
    ".kts": "kotlin", ".md": "markdown", ".mjs": "javascript", ".py": "python",
    ".rs": "rust", ".sh": "shell", ".sql": "sql", ".tsx": "typescript",
    ".ts": "typescript", ".xml": "xml", ".yaml": "yaml", ".yml": "yaml",
}
SYMBOL_LANGUAGES = ("javascript", "typescript", "python", "java")
IMPORT_LANGUAGES = ("javascript", "typescript")
DOC_EXTENSIONS = (".md", ".mdx", ".rst", ".txt", ".adoc")
CONFIG_EXTENSIONS = (".conf", ".config", ".ini", ".json", ".toml", ".xml", ".yaml", ".yml")
MANIFEST_NAMES = (
    "build.gradle", "build.gradle.kts", "cargo.toml", "composer.json", "dockerfile",
    "gemfile", "go.mod", "package.json", "pom.xml", "pyproject.toml",
    "requirements.txt", "settings.gradle", "settings.gradle.kts",
)
CONFIG_NAMES = (
    ".editorconfig", ".eslintignore", ".eslintrc", ".gitattributes", ".gitignore",
    ".prettierrc", "eslint.config.js", "tsconfig.json",
)
CI_NAMES = (".gitlab-ci.yml", "azure-pipelines.yml", "bitbucket-pipelines.yml")
CI_PREFIX = ".github/workflows/"
TEST_SEGMENTS = ("__tests__", "spec", "specs", "test", "tests")
# Over a lower-cased path; both can only match inside the basename.
TEST_NAME_REGEXES = (r"(?:^|[/._-])(?:test|spec)(?:[._-][^/]*)?\z", r"test\.[a-z0-9]+\z")
TEST_STEM_SUFFIX = r"(?:\.test|\.spec|test|spec)\z"
GUIDANCE_PATHS = (
    "AGENTS.md",
    "WORKFLOW.md",
    ".opencode/skills/project/SKILL.md",
    ".opencode/skills/tests/SKILL.md",
    ".opencode/skills/release/SKILL.md",
    ".agents/skills",
)

# ---- text -----------------------------------------------------------------
CLIP_CHARS = 320
DEFAULT_RANGE_LINES, MAX_RANGE_LINES = 160, 500
MAX_CONTEXT_LINES = 3
MAX_BATCH_RANGES = 20
CONTROL_MIN_COUNT, CONTROL_MAX_SHARE = 8, 0.05

# ---- symbols: (kind, pattern); the last group of each pattern is the name ---
SCRIPT_SYMBOLS = (
    ("function", r"function\s+([A-Za-z_$][\w$]*)\s*\("),
    ("class", r"class\s+([A-Za-z_$][\w$]*)\b"),
    ("interface", r"interface\s+([A-Za-z_$][\w$]*)\b"),
    ("type", r"type\s+([A-Za-z_$][\w$]*)\b"),
    ("enum", r"enum\s+([A-Za-z_$][\w$]*)\b"),
    ("constant", r"const\s+([A-Za-z_$][\w$]*)\s*[=:]"),
)
PYTHON_SYMBOLS = (
    ("class", r"^class\s+([A-Za-z_]\w*)\b"),
    ("function", r"^(?:async\s+)?def\s+([A-Za-z_]\w*)\s*\("),
)
JAVA_TYPE = r"(class|interface|enum|record)\s+([A-Za-z_]\w*)\b"
JAVA_METHOD = (
    r"(?:public|protected|private|static|final|synchronized|abstract|\s)"
    r"[\w<>\[\], ?]+\s+([A-Za-z_]\w*)\s*\("
)
JAVA_NOT_METHODS = ("catch", "for", "if", "new", "switch", "while")

# ---- imports --------------------------------------------------------------
IMPORT_PATTERNS = (
    r"""\bimport\s+(?:type\s+)?(?:[^'"]+\s+from\s+)?["'](\.{1,2}/[^"']+)["']""",
    r"""\bexport\s+[^'"]+\s+from\s+["'](\.{1,2}/[^"']+)["']""",
    r"""\brequire\(\s*["'](\.{1,2}/[^"']+)["']\s*\)""",
    r"""\bimport\(\s*["'](\.{1,2}/[^"']+)["']\s*\)""",
)
# What a text must contain for the pattern of the same position to match at all.
IMPORT_NEEDS = (r"import\s", r"""from\s+["']\.{1,2}/""", r"require\(", r"import\(")
RESOLVE_EXTENSIONS = (".ts", ".tsx", ".js", ".jsx", ".mjs", ".cjs", ".json")

# ---- related files --------------------------------------------------------
RELATIONSHIPS = ("direct-import", "imported-by", "likely-test", "same-basename", "sibling")
MAX_RELATIONSHIPS = 300
TEST_EVIDENCE = "test naming convention"

# ---- report sizes ---------------------------------------------------------
OUTLINE_MAX_FILES, OUTLINE_SAMPLE = 200, 80
MAP_FILES, MAP_DIRECTORIES, MAP_ROLE_LIST, MAP_SYMBOLS = 120, 120, 40, 80

# ---- coverage -------------------------------------------------------------
FLAGS = (
    "inventory_limit_reached", "result_limit_reached", "match_limit_reached",
    "byte_limit_reached", "line_limit_reached", "duration_limit_reached",
    "excerpt_truncated", "context_before_truncated", "context_after_truncated",
    "symbol_limit_reached", "relationship_limit_reached", "snapshot_changed",
    "coverage_partial",
)
PARTIAL_FLAGS = (
    "inventory_limit_reached", "result_limit_reached", "match_limit_reached",
    "byte_limit_reached", "line_limit_reached", "duration_limit_reached",
    "symbol_limit_reached", "relationship_limit_reached", "snapshot_changed",
)
COUNTERS = (
    "candidate_files", "scanned_files", "bytes_scanned", "skipped_secret",
    "skipped_generated", "skipped_large", "skipped_unreadable",
)
