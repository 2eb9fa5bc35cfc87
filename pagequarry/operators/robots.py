"""Robots rules: parsing the text and applying the path prefixes.

``reference`` mode keeps the observable quirks of the block and line patterns: a ``*`` block counts only when
another ``User-agent:`` or a ``#`` follows, and an empty value takes the next line as its value. ``strict`` mode
reads what the text means: the block ends at the next agent or at the end, comments are skipped and an empty
value is no rule. ``Allow`` is not used in either.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_space, unix_newlines
from ..functions.url import netloc, url_path
from ..plans.joins import fits_broadcast, lookup_join
from ..plans.storage import written

DEFAULT_DELAY = 15
# Up to this many prefixes of a host travel as an array.
LISTED_PREFIXES = 1_000
# Stands for the host of rules that hold for every URL; no host has a slash.
EVERYWHERE = "/"
# Block and line patterns per mode; group 1 of a line is its kind, group 2 its value.
BLOCK_PATTERN = {
    "reference": r"(?sU)User-agent: \*\s*(.*?)(?:User-agent:|#)",
    "strict": r"(?sU)User-agent:[ \t]*\*[ \t]*(?:\n|\z)(.*?)(?:User-agent:|\z)",
}
LINE_PATTERN = {
    "reference": r"(?mdU)^(Disallow:|Crawl-delay:)\s*(.*)$",
    "strict": r"(?mdU)^(Disallow:|Crawl-delay:)[ \t]*([^\n#]*)",
}
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def parse_robots(robots: DataFrame, mode: str = "reference") -> DataFrame:
    """``host, text`` -> ``host, pos, kind, value`` with kind ``disallow`` or ``delay``; empty values are dropped."""
    block = strip_space(F.regexp_extract(unix_newlines(F.col("text")), BLOCK_PATTERN[mode], 1))
    kinds = F.regexp_extract_all("_block", F.lit(LINE_PATTERN[mode]), F.lit(1))
    values = F.regexp_extract_all("_block", F.lit(LINE_PATTERN[mode]), F.lit(2))
    lines = F.arrays_zip(kinds.alias("kind"), values.alias("value"))
    return (
        robots.select("host", block.alias("_block"))
        .select("host", F.posexplode(lines).alias("pos", "_line"))
        .select(
            "host",
            "pos",
            F.when(F.col("_line.kind") == "Crawl-delay:", "delay").otherwise("disallow").alias("kind"),
            strip_space(F.col("_line.value")).alias("value"),
        )
        .where(F.col("value") != "")
    )


def delay_seconds(value) -> Column:
    """Whole seconds of a delay value, or null when it is not a number."""
    number = F.when(F.rlike(value, F.lit(NUMBER_PATTERN)), F.col(value).try_cast("double"))
    return number.try_cast("bigint")


def crawl_delays(robots: DataFrame, rules: DataFrame, default: int = DEFAULT_DELAY) -> DataFrame:
    """``host, delay`` for every host: its last readable delay rule, else the default."""
    parsed = rules.where(F.col("kind") == "delay").withColumn("_s", delay_seconds("value"))
    last = parsed.where(F.col("_s").isNotNull()).groupBy("host").agg(F.max_by("_s", "pos").alias("_s"))
    hosts = robots.select("host").distinct()
    return hosts.join(last, "host", "left").select("host", F.coalesce("_s", F.lit(default)).alias("delay"))


def flag_disallowed(
    df: DataFrame, rules: DataFrame, url: str, out: str = "disallowed", listed: int | None = None
) -> DataFrame:
    """Add ``out``: whether the URL's path starts with a disallowed prefix of its host.

    A rule without a host holds for every URL. Never are all pairs of URLs and rules looked at: hosts with up to
    ``listed`` (LISTED_PREFIXES) prefixes bring them along as a short array, so URLs are joined by host and tested in place. Where
    some host has more, a path is cut at the lengths its host's prefixes have, and the beginnings are looked up by an
    equality join, so a URL costs as many lookups as there are lengths, however many prefixes there are.
    """
    prefixes = rules.where(F.col("kind") == "disallow").select(
        F.coalesce("host", F.lit(EVERYWHERE)).alias("_host"), F.col("value").alias("_prefix")
    )
    prefixes = written(prefixes.distinct(), "prefixes")
    most = prefixes.groupBy("_host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    # host and path are settled below the join, so the test on each prefix only compares strings
    placed = df.withColumns({"_host": netloc(url), "_path": url_path(url)})
    if most <= (LISTED_PREFIXES if listed is None else listed):
        blocked = F.exists("_listed", lambda p: F.startswith(F.col("_path"), p))
        known = _with_listed(placed, prefixes, F.collect_set("_prefix"), "array<string>", url)
        return known.withColumn(out, blocked).drop("_host", "_path", "_listed")
    return _flag_by_lookup(placed, prefixes, url, out)


def _with_listed(placed: DataFrame, prefixes: DataFrame, values: Column, kind: str, url: str) -> DataFrame:
    """Add ``_listed``: values collected over the prefixes of the URL's host and those that hold everywhere."""
    everywhere = prefixes.where(F.col("_host") == EVERYWHERE).agg(values).scalar()
    per_host = prefixes.where(F.col("_host") != EVERYWHERE).groupBy("_host").agg(values.alias("_own"))
    joined = lookup_join(placed, per_host, "_host", "left", spread_by=url).withColumn("_everywhere", everywhere)
    none = F.array().cast(kind)
    listed = F.array_union(F.coalesce("_own", none), F.coalesce("_everywhere", none))
    return joined.withColumn("_listed", listed).drop("_own", "_everywhere")


def _flag_by_lookup(placed: DataFrame, prefixes: DataFrame, url: str, out: str) -> DataFrame:
    """The test by equality join. Rows are numbered and written once; of a row, only number, host and beginnings move."""
    # a host's prefixes have no more lengths than its longest one has characters
    lengths = _with_listed(placed, prefixes, F.collect_set(F.length("_prefix")), "array<int>", url)
    rows = written(lengths.withColumn("_row", F.monotonically_increasing_id()), "placed-urls")
    fitting = F.filter("_listed", lambda n: n <= F.length("_path"))
    starts = rows.select("_row", "_host", "_path", F.explode(fitting).alias("_n"))
    starts = starts.select("_row", F.explode(F.array(F.col("_host"), F.lit(EVERYWHERE))).alias("_host"), F.left("_path", F.col("_n")).alias("_prefix"))
    key = F.to_json(F.struct("_host", "_prefix")).alias("_key")
    hits = lookup_join(starts.select("_row", key), prefixes.select(key), "_key", "left_semi", spread_by="_row")
    hits = written(hits.select("_row").distinct().withColumn("_hit", F.lit(True)), "disallowed")
    flagged = rows.join(F.broadcast(hits) if fits_broadcast(hits) else hits, "_row", "left")
    return flagged.withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_row", "_hit", "_host", "_path", "_listed")


def drop_disallowed(df: DataFrame, rules: DataFrame, url: str, listed: int | None = None) -> DataFrame:
    """Rows whose URL no rule forbids."""
    flagged = flag_disallowed(df, rules, url, "_disallowed", listed)
    return flagged.where(~F.col("_disallowed")).drop("_disallowed")
