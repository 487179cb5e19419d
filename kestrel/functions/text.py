"""String functions (H1-H8) as Column expressions; all JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import SLUG_LENGTH, STOPWORDS

# White space as Python's str.strip/str.split see it. Spelled out because
# Java's \s (and Spark's trim) and RE2's \s each cover a different set. The
# same class text runs in Java and RE2 (both read \x{...}).
WS_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same set as characters, for btrim (no regex): code point ranges of WS_CLASS.
WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
             (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
WS_CHARS = "".join(chr(c) for lo, hi in WS_RANGES for c in range(lo, hi + 1))

# Tokens of cleaned abstracts: runs of ASCII letters after lower-casing, at
# least three long (everything else separates tokens).
TOKEN_PATTERN = "[a-z]{3,}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """H1: remove white space (Unicode sense, as Python's str.strip) at both ends.

    ``btrim`` with the explicit character set: Spark's plain ``trim`` removes
    only the space character.
    """
    return F.btrim(_col(c), F.lit(WS_CHARS))


BLANK = "^" + WS_CLASS + r"*\z"


def is_blank(c: Column | str) -> Column:
    """True when null or only white space (an anchored match: stops at the first other character)."""
    return _col(c).isNull() | _col(c).rlike(BLANK)


def label_tokens(c: Column | str) -> Column:
    """H2: newline -> comma, split on comma, drop blank pieces (pieces unstripped)."""
    pieces = F.split(F.translate(_col(c), "\n", ","), ",")
    return F.filter(pieces, lambda t: F.length(py_strip(t)) > 0)


def norm_name(c: Column | str) -> Column:
    """Stripped, lower-cased name; a null name becomes ''."""
    return F.coalesce(F.lower(py_strip(c)), F.lit(""))


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


STOPWORD_SQL_LIST = ", ".join(_sql_string(w) for w in STOPWORDS)


def clean_tokens(c: Column | str) -> Column:
    """H3/H4: lower, letters-only tokens longer than two characters, no stop-words.

    The stop-word test is ``NOT t IN (...)``, which the optimizer turns into a
    hash-set lookup. For a column name the whole expression is one SQL
    expression (built in one call instead of one call per stop-word).
    """
    if isinstance(c, str):
        return F.expr(f"filter(regexp_extract_all(lower(`{c}`), '{TOKEN_PATTERN}', 0), "
                      f"t -> NOT t IN ({STOPWORD_SQL_LIST}))")
    tokens = F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)
    return F.filter(tokens, lambda t: ~t.isin(STOPWORDS))


def clean_text(tokens: Column | str) -> Column:
    """H5: tokens joined by one space."""
    return F.array_join(_col(tokens), " ")


def slug(c: Column | str, length: int = SLUG_LENGTH) -> Column:
    """H8: every character that is not a letter or digit -> '_', first ``length`` chars."""
    return F.substring(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]", "_"), 1, length)


# HTML entities decoded by strip_markup, in the order applied ('&amp;' last so
# '&amp;lt;' stays '&lt;').
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def strip_markup(c: Column | str) -> Column:
    """H6: visible text of an HTML page.

    Script and style bodies and comments go first, then every tag becomes a
    space, entities are decoded, white space runs collapse to one space and
    the ends are stripped.
    """
    out = _col(c)
    out = F.regexp_replace(out, r"(?is)<script\b[^>]*>.*?</script[^>]*>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style[^>]*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, WS_CLASS + "+", " ")
    return py_strip(out)


def html_title(c: Column | str) -> Column:
    """Text inside the first <title> element ('' when absent)."""
    return F.regexp_extract(_col(c), r"(?is)<title[^>]*>(.*?)</title>", 1)


def term_from_file(file_name: Column | str, prefix: str, suffix_pattern: str = r"\.[^.]*$") -> Column:
    """H7: landing-file name -> term: prefix and extension off, '_' -> ' '."""
    stem = F.regexp_replace(F.regexp_replace(_col(file_name), r"^.*/", ""), suffix_pattern, "")
    stem = F.regexp_replace(stem, "^" + prefix, "")
    return F.replace(stem, F.lit("_"), F.lit(" "))
