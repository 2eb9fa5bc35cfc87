"""Extracted records as CSV: header first, every column a string, a missing value the empty string."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.extract import FIELD_RULES
from .file_order import in_file_order

COLUMNS = ("url", *FIELD_RULES)
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_records(records: DataFrame, path: str, order: Sequence[str] = ()) -> bool:
    """Write ``url`` and then the fields, in the order of the given columns (not written themselves) if there are any;
    nothing is written, and False returned, when there are no records."""
    if records.isEmpty():
        return False
    ordered = ["url", *[c for c in records.columns if c != "url" and c not in order]]
    if order:
        records = records.repartitionByRange(*order).sortWithinPartitions(*order)
    records.select(*ordered).write.mode("overwrite").options(**CSV).option("emptyValue", "").csv(path)
    return True


def read_records(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, numbered: bool = False
) -> DataFrame:
    """Records as strings, by the names in the header: all columns, or the given ones; a missing path raises. ``numbered``
    adds ``seq``, their place in the order of writing."""
    found = spark.read.options(**CSV).option("multiLine", True).csv(path)
    names = [f"`{c}`" for c in columns or found.columns]
    if numbered:
        found, names = in_file_order(found), [*names, "seq"]
    return found.select(*names).na.fill("")
