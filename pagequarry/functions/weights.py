"""TF-IDF arithmetic. Divisions are guarded because ANSI mode raises on zero."""

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("classic", "smooth")


def term_frequency(tf, doc_len) -> Column:
    """Share of a document's tokens; 0 for an unknown or empty document."""
    return F.coalesce(F.col(tf) / F.nullif(F.col(doc_len), F.lit(0)), F.lit(0.0))


def idf_classic(total_docs: Column, df) -> Column:
    """ln(N / df), and 0 for a term no document holds."""
    df = F.coalesce(F.col(df), F.lit(0))
    return F.when(df > 0, F.ln(total_docs / df)).otherwise(F.lit(0.0))


def idf_smooth(total_docs: Column, df) -> Column:
    """ln((N + 1) / (df + 1)) + 1, defined for unseen terms too."""
    df = F.coalesce(F.col(df), F.lit(0))
    return F.ln((total_docs + 1) / (df + 1)) + 1


def idf(method: str, total_docs: Column, df) -> Column:
    """Smooth IDF for ``"smooth"``; every other method name means classic."""
    return idf_smooth(total_docs, df) if method == "smooth" else idf_classic(total_docs, df)


def doc_share(total_docs: Column, df) -> Column:
    """Percentage of the corpus that holds the term."""
    return F.col(df) / total_docs * 100
