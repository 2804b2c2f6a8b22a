"""Pattern dialect: ECMAScript ``\\s`` and ``\\b`` written for java.util.regex."""

import re

# ECMAScript white space and line terminators (a fixed set).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
_SPACE = (
    r"[\t\n\x0B\f\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}\x{feff}]"
)
_WORD = "[A-Za-z0-9_]"
# java.util.regex has a Unicode-aware \b; names here are ASCII words.
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def jvm(pattern: str) -> str:
    """``\\s`` and ``\\b`` (outside brackets) become explicit ASCII forms.

    A boundary before a literal word is checked after the word was found: the
    matcher then skips quickly to the word instead of looking back at every
    character, which is many times faster on long texts.
    """
    pattern = re.sub(r"\\b(\w+)", rf"\1(?<!{_WORD}\1)", pattern)
    return pattern.replace(r"\s", _SPACE).replace(r"\b", _BOUNDARY)


def one_of(chars: str) -> str:
    """Class of single listed characters; the JVM matches these by table lookup."""
    return "[" + "".join(f"\\x{ord(c):02x}" for c in chars) + "]"
