"""String column functions.

All of these are built-in Spark expressions (JVM side, whole-stage codegen); no Python runs per row.
Regular expressions are written so that Java (Spark) and RE2 (the DuckDB oracle) agree: explicit
Unicode classes instead of engine-specific ``\\b``/``\\w``/``\\s`` meanings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters (the set Python's str ``\s`` and Java's
# ``(?U)\s`` agree on), written as one character class that Java and RE2 both accept.
WS_CLASS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# A "word character" in the Unicode sense: letters, numbers, marks, underscore.
WORD_CHARS = r"\p{L}\p{N}\p{M}_"
TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}_]{2,}"

_META = set(r"\.^$|?*+()[]{}")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def escape_regex(word: str) -> str:
    """Escape regex metacharacters so a keyword is matched literally (Q8)."""
    return "".join("\\" + ch if ch in _META else ch for ch in word)


def clean_text(col: str | Column, mode: str = "ascii") -> Column:
    """G1: NULL -> '', drop characters outside letters/digits/whitespace, squeeze whitespace to one
    space, trim, lower.  ``mode='ascii'`` keeps only a-z, A-Z, 0-9 (as the reference does, Q10);
    ``mode='unicode'`` keeps every letter and number."""
    # classes of few members are looked up fastest, so ASCII whitespace (``\s``) is one and the rest of WS_CLASS another;
    # what is left of the first step is kept characters and whitespace only, so its words are the runs of kept ones
    keep = r"\p{Alnum}" if mode == "ascii" else r"\p{L}\p{N}"
    s = F.coalesce(_c(col).cast("string"), F.lit(""))
    s = F.array_join(F.regexp_extract_all(s, F.lit(f"[{keep}\\s]++|{WS_CLASS}++"), F.lit(0)), "")
    s = F.array_join(F.regexp_extract_all(s, F.lit(f"[{keep}]++"), F.lit(0)), " ")
    return F.lower(s)


def clean_text_sql(expr: str, mode: str = "ascii") -> str:
    """DuckDB twin of :func:`clean_text`."""
    keep = "a-zA-Z0-9" if mode == "ascii" else r"\p{L}\p{N}"
    ws = WS_CLASS[1:-1]
    return (f"lower(trim(regexp_replace(regexp_replace(coalesce({expr}, ''), '[^{keep}{ws}]', '', 'g'), "
            f"'{WS_CLASS}+', ' ', 'g')))")


def word_count(col: str | Column) -> Column:
    """Words of an already cleaned text; the empty text has 0 words (plain split gives 1)."""
    return F.size(F.regexp_extract_all(_c(col), F.lit("[^ ]+"), F.lit(0)))


def has_words(col: str | Column, n: int, mode: str = "ascii") -> Column:
    """Whether the cleaned text has ``n`` words or more, read off the text itself: ``n`` kept characters with whitespace
    between each two.  Stops at the n-th word."""
    keep = "a-zA-Z0-9" if mode == "ascii" else r"\p{L}\p{N}"
    ws = WS_CLASS[1:-1]
    s = F.coalesce(_c(col).cast("string"), F.lit(""))
    return s.rlike(f"[{keep}](?:[^{ws}]*+[{ws}][^{keep}]*+[{keep}]){{{n - 1}}}")


def word_count_sql(expr: str) -> str:
    return f"len(list_filter(string_split({expr}, ' '), lambda x: x <> ''))"


def keyword_regex(words: Iterable[str], literal: bool = True) -> str:
    """One alternation matching any keyword as a whole word, any case (Unicode, Q9).
    Word boundaries are look-arounds over Unicode word characters (Q7: no stemming)."""
    alts = "|".join(escape_regex(w) if literal else w for w in words)
    return f"(?iu)(?<![{WORD_CHARS}])(?:{alts})(?![{WORD_CHARS}])"


def keyword_regex_sql(words: Iterable[str], literal: bool = True) -> str:
    """RE2 twin of :func:`keyword_regex` (RE2 has no look-arounds: consume one boundary char)."""
    alts = "|".join(escape_regex(w) if literal else w for w in words)
    return f"(?i)(?:^|[^{WORD_CHARS}])(?:{alts})(?:[^{WORD_CHARS}]|$)"


def has_keyword(col: str | Column, words: Iterable[str], literal: bool = True) -> Column:
    """True when any keyword occurs as a whole word."""
    return _c(col).rlike(keyword_regex(list(words), literal))


def extract_quantity(col: str | Column, pattern: str = r"(\d+)\s?ml", group: int = 1) -> Column:
    """First captured quantity as a number (NULL when absent)."""
    v = F.regexp_extract(_c(col), "(?i)" + pattern, group)
    return F.when(v == "", None).otherwise(v.try_cast("bigint"))


def extract_all(col: str | Column, pattern: str, group: int = 0) -> Column:
    """Every match of a pattern."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(group))


def words(col: str | Column) -> Column:
    """Tokenizer of the usual TF-IDF default: lower case, runs of 2+ word characters."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), F.lit(0))


def words_sql(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '{TOKEN_PATTERN}')"


def not_identical(a: str | Column, b: str | Column) -> Column:
    """Candidate differs from the original ignoring case."""
    return F.lower(_c(a)) != F.lower(_c(b))


def percent_text(score: str | Column, digits: int = 2) -> Column:
    """Confidence as percent text, e.g. ``87.25%`` (no thousands separators).  The percent is
    rounded half-up in decimal arithmetic, so the text does not depend on binary floating point."""
    pct = F.round((_c(score) * 100).cast("decimal(20,8)"), digits).cast("double")
    return F.format_string(f"%.{digits}f%%", pct)


def join_labels(labels: str | Column, sep: str = ", ") -> Column:
    """Labels as one string."""
    return F.array_join(_c(labels), sep)


def path_key(levels: str | Column) -> Column:
    """Slash path from an array of levels."""
    return F.array_join(_c(levels), "/")
