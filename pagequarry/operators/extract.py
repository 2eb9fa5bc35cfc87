"""Named fields out of HTML by a table of patterns, and the job that turns a download log into records."""

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_group, python_pattern, strip_markup, strip_space, unix_newlines
from ..plans.joins import hot_split_join

# Field name -> pattern whose group 1 is the value. The order is the column order of the records,
# and `contry` is the spelling of that column.
FIELD_RULES = {
    "name": r'<h1 class="primary_title">(.+)</h1>',
    "full_name": r"<dt.*>Full Name</dt>\s*<dd.*>\s*(.*?)\s*<small>",
    "votes": r'<div class="site-rating".+data-votes="(.*?)".*?>',
    "whs_rating": r'<div class="site-rating".+data-rating="(.*?)".*?>',
    "average_rating": r'<div class="site-rating".+data-average="(.*?)".*?>',
    "description": r'<div class="intro-text text-lead">([\s\S]*?)\s*</div',
    "contry": r"<dt.*>\s*(?:Country|Countries)\s*</dt>\s*<dd .*>(?:\s*?(?:<a.*?>)(.+)</a>)*(?:\s*</dd>)",
    "status": r"<dt.*>\s*Status\s*</dt>\s*<dd .*>\s*(.*)\s*<span",
    "type": r"<dt.*>\s*Type\s*</dt>\s*<dd.*>\s*(.*)\s*<i",
}
# A rule whose group repeats, as what ends a block, the block's head with the body behind it, and what each line of the body
# must be: the last line's group 1 is the value. A repeated group costs the pattern engine stack for every repetition,
# and a long list would end the process.
REPEATED_RULES = {
    FIELD_RULES["contry"]: (
        r"</dd>",
        r"^[\s\S]*<dt.*>\s*(?:Country|Countries)\s*</dt>\s*<dd .*>([\s\S]*)$",
        r"^\s*<a.*?>(.+)</a>\s*$",
    ),
}
# Fields freed from markup, and the class of pages that hold records.
MARKUP_FIELDS = ("description",)
RECORD_PATHS = r"^(list|tentative|former-tentative|in-danger).+/index.html"


def _of_blocks(text: str, end: str, block: str, item: str) -> Column:
    """Value of a rule whose group repeats: that of the first block all of whose lines fit; empty when none does."""
    block, item = python_pattern(block), python_pattern(item)
    pieces = F.split(text, end)
    # what follows the last end is no block
    closed = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    bodies = F.transform(F.filter(closed, lambda x: F.rlike(x, F.lit(block))), lambda x: F.regexp_extract(x, block, 1))
    lines = F.transform(bodies, lambda x: F.filter(F.split(x, "\n"), lambda y: strip_space(y) != ""))
    sound = F.filter(lines, lambda x: F.forall(x, lambda y: F.rlike(y, F.lit(item))))
    last = F.try_element_at(F.try_element_at(sound, F.lit(1)), F.lit(-1))
    return F.coalesce(F.regexp_extract(last, item, 1), F.lit(""))


def extract_fields(
    pages: DataFrame,
    rules: Mapping[str, str] = FIELD_RULES,
    html: str = "html",
    markup_fields: Collection[str] = MARKUP_FIELDS,
) -> DataFrame:
    """Replace ``html`` by one string column per rule: first match, trimmed, empty when nothing matches.

    One narrow projection. A matched rule whose group took no part (a country list on one line) gives the empty
    string. The line ends are unified once for all rules.
    """
    others = [c for c in pages.columns if c != html]
    text = pages.select(*others, unix_newlines(F.col(html)).alias("_text"))

    def value_of(pattern: str):
        return _of_blocks("_text", *REPEATED_RULES[pattern]) if pattern in REPEATED_RULES else first_group("_text", pattern)

    def field(name: str, pattern: str):
        value = strip_space(value_of(pattern))
        return (strip_markup(value) if name in markup_fields else value).alias(name)

    return text.select(*others, *[field(name, pattern) for name, pattern in rules.items()])


def select_pages(rows: DataFrame, path: str = "filepath_saved", pattern: str = RECORD_PATHS) -> DataFrame:
    """Rows whose file path starts with a match of the page-class pattern."""
    return rows.where(F.col(path).rlike(python_pattern(pattern)))


def join_log_pages(log: DataFrame, pages: DataFrame) -> DataFrame:
    """Log rows with their page by file path. Pages that are missing drop out; repeated log rows stay.

    ``pages`` holds one row per ``filepath_saved``. A path that much of the log repeats is split.
    """
    return hot_split_join(log, pages, "filepath_saved", "inner", "url")


def extract_records(
    log: DataFrame,
    pages: DataFrame,
    rules: Mapping[str, str] = FIELD_RULES,
    pattern: str = RECORD_PATHS,
    dedupe: bool = False,
) -> DataFrame:
    """Records ``url`` + one column per rule for the log rows of the wanted page class, and ``seq`` where the log has it:
    the place of the log row, which is the order of the records. ``dedupe`` keeps the first of repeated log rows.

    The fields are extracted before the join, so the shuffle carries nine short strings instead of whole pages.
    """
    place = ["seq"] if "seq" in log.columns else []
    wanted = select_pages(log.select("url", "filepath_saved", *place), pattern=pattern)
    if dedupe:
        rows = wanted.groupBy("url", "filepath_saved")
        wanted = rows.agg(F.min("seq").alias("seq")) if place else wanted.distinct()
    texts = select_pages(pages.select("filepath_saved", "html"), pattern=pattern)
    return join_log_pages(wanted, extract_fields(texts, rules)).select("url", *rules, *place)
