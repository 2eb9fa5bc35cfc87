"""Text expressions: all are built-in Spark expressions, so they stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. A token is a run of at least three Unicode letters, numbers or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{3,}"
# Whitespace in the Unicode sense, with the four separator controls that Java's \s leaves out.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MARKUP_PATTERN = r"<[^<]+?>"


def tokens(text) -> Column:
    """Lower-cased tokens of a text in order; an empty array for null or empty text."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def strip_space(text) -> Column:
    """Cut Unicode whitespace at both ends (Spark's ``trim`` cuts spaces only), in time linear in the text."""
    return F.btrim(text, F.lit(SPACES))


def unix_newlines(text) -> Column:
    """Turn CRLF and lone CR into LF, as reading a file in text mode does."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def strip_markup(text) -> Column:
    """Remove every tag. Entities stay as they are and the edges are not trimmed again."""
    return F.regexp_replace(text, MARKUP_PATTERN, "")


def python_pattern(pattern: str) -> str:
    """A pattern written for Python's dialect as a Java one.

    ``d``: only LF ends a line, so ``.`` crosses CR, NEL and the Unicode separators.
    ``U``: ``\\s`` and ``\\w`` are Unicode classes.
    """
    return "(?dU)" + pattern


def first_group(text, pattern: str) -> Column:
    """Group 1 of the first match, or the empty string."""
    return F.coalesce(F.regexp_extract(text, python_pattern(pattern), 1), F.lit(""))
