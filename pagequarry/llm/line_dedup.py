"""Dropping recurring lines by a log-template tree, in DataFrame operations only.

Lines are parsed to a fixed depth: by their number of words, then by their leading words. Words that look variable
(those with a digit) are a wildcard from the start. Below that, a leaf generalises the lines it holds: at each place the
word of the majority is part of the leaf's template and all else is a wildcard. A line is covered by its leaf when it
agrees with most of a template that has mostly fixed words. What recurs in at least ``MIN_TEXTS`` different texts, as
the same masked line or as the lines covered by one leaf, is dropped from all documents.

Exact copies of a text count once, so copies do not make their own lines recur. Lines are counted by digests with
map-side combining; words are only looked at in leaves that recur. Documents stay where they are: what is dropped is a
list of line numbers per text, sent to the documents when it is measured to fit, else joined.

Short lines, of fewer than ``MIN_WORDS`` words, recur only as the same masked line. One that would be all wildcards is
compared as it is written: numbers are no copies of each other, nor are lines of a script without spaces that hold a digit.
Whoever calls can leave out lines with fewer than ``min_words`` words; 1 leaves out none but blank ones.

Edge cases: null text stays null and has 0 lines; blank lines and those with fewer than ``min_words`` words are never
dropped; repeated rows are treated alike; all columns but the text pass through; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast
from ..plans.storage import written

MIN_TEXTS = 5
MIN_WORDS = 3
LEADING = 3
# shares of a leaf's template that must be fixed, and of the fixed words a line must agree with
FIXED, AGREE = 0.6, 0.8
MAJORITY = 0.5
VARIABLE = r"[^ ]*[0-9][^ ]*"
WILD = "<*>"
_WORD = "[^ 0-9]*+[0-9][^ ]*+"
SHORT_AND_VARIABLE = rf"^{_WORD}(?: {_WORD}){{0,{MIN_WORDS - 2}}}$"


def masked(lines: Column) -> Column:
    """Lines with single spaces between their words and variable-looking words replaced. The patterns run only on lines
    that need them, and each step is an array of its own, so no line is worked on twice."""

    def where_needed(pattern: str, change) -> None:
        nonlocal lines
        lines = F.transform(lines, lambda x: F.when(F.rlike(x, F.lit(pattern)), change(x)).otherwise(x))

    lines = F.transform(lines, lambda x: F.btrim(x, F.lit("\t\n\x0b\x0c\r ")))
    where_needed(r"[\x09-\x0D]|  ", lambda x: F.regexp_replace(x, r"[\x09-\x0D\x20]+", " "))
    whole = lambda x: F.rlike(x, F.lit(SHORT_AND_VARIABLE))
    where_needed("[0-9]", lambda x: F.when(whole(x), x).otherwise(F.regexp_replace(x, VARIABLE, WILD)))
    return lines


def text_key(text: str) -> Column:
    """Digest that stands for a whole text."""
    return F.unhex(F.md5(F.col(text)))


def masked_lines(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``key, pos, line, words``: one row per masked line that is not blank and has enough words."""
    rows = docs.where(F.col(text).isNotNull()).select(
        text_key(text).alias("key"), F.posexplode(masked(F.split(text, "\n"))).alias("pos", "line")
    )
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    # only a short line can be blank
    shown = (F.col("words") >= MIN_WORDS) | F.rlike("line", F.lit(r"(?U)\S"))
    return rows.withColumn("words", words).where((F.col("words") >= min_words) & shown)


def template_of() -> Column:
    return F.xxhash64("line", "words").alias("template")


def parsed_lines(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``key, pos, template, leaf``: digests of the text, the masked line, and its number of words with the leading ones."""
    leading = F.substring_index("line", " ", LEADING)
    rows = masked_lines(docs, text, min_words)
    return rows.select("key", "pos", template_of(), F.xxhash64(leading, "words").alias("leaf"))


def recurring_templates(docs: DataFrame, lines: DataFrame, text: str, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``template`` of the masked lines to drop; ``lines`` are the parsed lines of ``docs``."""
    seen = written(lines.select("key", "leaf", "template").distinct(), "line-keys")
    per_template = seen.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("texts"))
    counted = written(per_template, "templates")
    by_itself = counted.where(F.col("texts") >= min_texts).select("template")

    # leaves whose lines differ and that recur: only there is anything to generalise
    leaves = counted.groupBy("leaf").agg(F.sum("texts").alias("texts"), F.count(F.lit(1)).alias("kinds"))
    leaves = leaves.where((F.col("texts") >= min_texts) & (F.col("kinds") > 1)).select("leaf")
    wanted = written(counted.join(leaves, "leaf").select("template", F.col("leaf").alias("_leaf"), "texts"), "wanted")
    side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    # a line of each template is enough, so only the texts that hold the chosen ones are read again
    held = lines.select("key", "template").join(side.select("template"), "template", "left_semi")
    chosen = written(held.groupBy("template").agg(F.min("key").alias("key")).select("key").distinct(), "chosen-texts")
    chosen = F.broadcast(chosen) if fits_broadcast(chosen) else chosen
    texts = docs.select(text).join(chosen, text_key(text) == F.col("key"), "left_semi")
    # only the lines of these leaves are shuffled, one for each template; a short line is the only one of its leaf
    shown = masked_lines(texts, text).select(template_of(), "line").join(side, "template").distinct()
    words = shown.select("template", "_leaf", "texts", F.posexplode(F.split("line", " ")).alias("place", "word"))
    words = written(words, "line-words")
    votes = words.groupBy("_leaf", "place", "word").agg(F.sum("texts").alias("n"))
    # the greatest count, then the least word
    places = votes.groupBy("_leaf", "place").agg(
        F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("n"), "word")).alias("_top")
    )
    fixed = places.select(
        "_leaf",
        "place",
        F.when(-F.col("_top.n") > F.col("all") * MAJORITY, F.col("_top.word")).alias("_fixed"),
    )
    firm = fixed.groupBy("_leaf").agg(F.count("_fixed").alias("_n_fixed"), F.count(F.lit(1)).alias("_n"))
    firm = firm.where(F.col("_n_fixed") >= F.col("_n") * FIXED).select("_leaf", "_n_fixed")
    agreed = (
        words.join(fixed, ["_leaf", "place"])
        .groupBy("_leaf", "template")
        .agg(F.count_if(F.col("word") == F.col("_fixed")).alias("_agreed"))
        .join(firm, "_leaf")
        .where(F.col("_agreed") >= F.col("_n_fixed") * AGREE)
        .select(F.col("_leaf").alias("leaf"), "template")
    )
    agreed = written(agreed, "covered")
    covered = seen.join(agreed, ["leaf", "template"]).groupBy("leaf").agg(F.countDistinct("key").alias("texts"))
    general = agreed.join(covered.where(F.col("texts") >= min_texts).select("leaf"), "leaf").select("template")
    return by_itself.unionByName(general).distinct()


def dropped_lines(docs: DataFrame, text: str = "text", min_texts: int = MIN_TEXTS, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, dropped``: line numbers to drop, for the texts that have any."""
    lines = written(parsed_lines(docs, text, min_words), "parsed-lines")
    templates = written(recurring_templates(docs, lines, text, min_texts), "recurring")
    found = lines.select("key", "pos", "template")
    hit = found.join(F.broadcast(templates) if fits_broadcast(templates) else templates, "template")
    return hit.groupBy("key").agg(F.collect_set("pos").alias("dropped"))


def drop_recurring_lines(
    docs: DataFrame, text: str = "text", min_texts: int = MIN_TEXTS, min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without their recurring lines; adds ``n_lines`` and ``n_dropped``."""
    dropped = written(dropped_lines(docs, text, min_texts, min_words), "dropped-lines")
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    keyed = docs.select(*others, F.col(text), text_key(text).alias("_key"))
    narrow = dropped.select(F.col("key").alias("_key"), "dropped")
    side = F.broadcast(narrow) if fits_broadcast(narrow) else narrow
    joined = keyed.join(side, "_key", "left")
    lines = F.split(text, "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(numbers, F.col("dropped")), lambda i: F.get(lines, i))
    new = F.when(F.col("dropped").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *others,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        new.alias(text),
    )
