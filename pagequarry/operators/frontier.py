"""Crawl frontier over tables: one step, a whole crawl in rounds, and hop distances.

A round is a few joins, and it gives exactly what a first-in first-out queue gives: the queue is numbered by
``seq``, the pages that fit the budget are its first ones, and new links follow in the order of (page, position).
"""

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.url import cut_fragment
from ..plans.joins import BROADCAST_BYTES, ROW_OVERHEAD, fits_broadcast, keys_among, lookup_join
from ..plans.ordering import nth_smallest, number_rows, part_of, place_in_part
from ..plans.storage import fresh_path, read_if_there, written
from .links import site_links
from .robots import drop_disallowed, flag_disallowed

DEFAULT_BUDGET = 5
# A crawl's log: each round is a folder, and ``at`` is partition and position of its sort in one number.
LOG_SCHEMA = "url string, status string, at bigint, round int"
# One row per finished round: pages fetched so far, and the last log row that has been taken from the queue.
ROUNDS_SCHEMA = "round int, fetched bigint, done_round int, done_at bigint"


@dataclass(frozen=True)
class FrontierStep:
    """``frontier(url, seq)`` to go on with, and ``visited(url, seq, status)`` of the URLs taken from the queue;
    status is fetched, failed or disallowed."""

    frontier: DataFrame
    visited: DataFrame
    fetched: int


def queue_of(urls: DataFrame, order: list[str | Column]) -> DataFrame:
    """Number URLs in the given order into ``url, seq``; of repeats the first stays."""
    first = urls.groupBy("url").agg(F.min(F.struct(*order)).alias("_first"))
    return number_rows(first, ["_first"], "seq").select("url", "seq")


def _attempts(queue: DataFrame, visited: DataFrame, known: DataFrame) -> DataFrame:
    """Status each URL of the queue would get, already visited ones left out."""
    small = fits_broadcast(queue.select("url"))
    todo = queue.join(keys_among(visited, queue, "url", small), "url", "left_anti")
    found = todo.join(keys_among(known, queue, "url", small).withColumn("_page", F.lit(True)), "url", "left")
    status = F.when(F.col("disallowed"), "disallowed").when(F.col("_page"), "fetched").otherwise("failed")
    return found.select("url", "seq", status.alias("status"))


def _step(
    queue: DataFrame,
    visited: DataFrame,
    known: DataFrame,
    budget: int,
    links_of: Callable[[DataFrame], DataFrame],
) -> FrontierStep:
    """One level for ``queue(url, seq, disallowed)``."""
    # the queue's fate is read by the cut, the links and the result, so it is settled once
    attempts = written(_attempts(queue, visited, known), "attempts")
    fetchable = attempts.where(F.col("status") == "fetched")
    n = fetchable.count()
    if budget <= 0:
        n, taken, remaining = 0, attempts.where(F.lit(False)), queue
    elif n < budget:
        taken, remaining = attempts, queue.where(F.lit(False))
    else:
        n, last = budget, nth_smallest(fetchable, "seq", budget)
        taken, remaining = attempts.where(F.col("seq") <= last), queue.where(F.col("seq") > last)

    fresh = (
        links_of(taken.where(F.col("status") == "fetched").select("url", "seq"))
        .groupBy(F.col("abs_url").alias("url"))
        .agg(F.min(F.struct("seq", "pos")).alias("_first"))
        .join(visited.select("url").distinct(), "url", "left_anti")
        .join(queue.select("url"), "url", "left_anti")
        .select("url", F.lit(1).alias("_new"), "_first.seq", F.col("_first.pos").cast("bigint").alias("_pos"))
    )
    kept = remaining.select("url", F.lit(0).alias("_new"), "seq", F.lit(0).cast("bigint").alias("_pos"))
    merged = kept.unionByName(fresh).withColumnRenamed("seq", "_from")
    frontier = number_rows(merged, ["_new", "_from", "_pos"], "seq").select("url", "seq")
    return FrontierStep(frontier, taken, n)


def next_frontier(
    pages: DataFrame,
    frontier: DataFrame,
    visited: DataFrame,
    rules: DataFrame,
    budget: int = DEFAULT_BUDGET,
    site: str | Column | None = None,
) -> FrontierStep:
    """Take up to ``budget`` fetchable URLs from the queue and append the new links of their pages.

    ``pages(url, html)`` holds what a fetch would return; a URL without a page counts as failed. Links are kept
    when they lie on ``site`` (default: on their own page's site), no rule forbids them and they are neither
    visited nor queued. URLs already in the queue are not asked for their site.
    """

    def links_of(fetched: DataFrame) -> DataFrame:
        # whole pages stay where they are: the fetched URLs go to them, or their narrow links to the fetched URLs
        if fits_broadcast(fetched):
            html = pages.select("url", "html").join(F.broadcast(fetched), "url")
            return drop_disallowed(site_links(html, site), rules, "abs_url")
        links = site_links(pages.select("url", "html"), site).select("url", "pos", "abs_url")
        return drop_disallowed(links.join(fetched, "url"), rules, "abs_url")

    return _step(flag_disallowed(frontier, rules, "url"), visited, pages, budget, links_of)


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    rules: DataFrame,
    max_pages: int = DEFAULT_BUDGET,
    site: str | Column | None = None,
    path: str | None = None,
    base_url: str | None = None,
) -> FrontierStep:
    """Rounds until the queue is empty or ``max_pages`` pages are fetched. ``seq`` of the result is the visiting order,
    and the rest of the queue goes on from there.

    ``seeds(url, seq)``; without any, the crawl starts at ``base_url``. Every URL gets its fate and its place once, when
    it enters the queue, and is appended to one log below ``path``: a first-in first-out queue is visited in the order
    it was filled. So the queue is the part of the log behind a pointer, the visited URLs are the part before it, and
    the plan of a round stays the same however many rounds there were. Links are extracted once for the whole corpus,
    and forbidden ones never enter the table, so only the seeds are held against the rules.

    A crawl whose ``path`` holds finished rounds goes on behind them (``max_pages`` counts the pages fetched before, the
    seeds have had their turn); a round that was broken off is written anew.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "crawl")
    known = pages.select("url").distinct().withColumn("_page", F.lit("fetched"))
    fate = F.coalesce("_page", F.lit("failed")).alias("status")
    links = drop_disallowed(site_links(pages, site), rules, "abs_url").select("abs_url", "url", "pos")
    known = written(known.withColumnRenamed("url", "abs_url"), "known")
    linked = lookup_join(links, known, "abs_url", "left", spread_by="url")
    edges = written(linked.select("url", "pos", "abs_url", fate), "links")

    rounds = read_if_there(spark, f"{path}/rounds", ROUNDS_SCHEMA)
    last = rounds and rounds.orderBy(F.desc("round")).first()
    if last is None:
        if base_url is not None and seeds.isEmpty():
            seeds = spark.createDataFrame([(base_url, 0)], "url string, seq bigint")
        first = flag_disallowed(seeds.groupBy("url").agg(F.min("seq").alias("seq")), rules, "url")
        found = first.join(known.withColumnRenamed("abs_url", "url"), "url", "left")
        status = F.when(F.col("disallowed"), "disallowed").otherwise(fate).alias("status")
        last = _append_round(found.select("url", status, "seq"), ["seq"], path, 0, (0, -1, -1))
    while last["fetched"] < max_pages:
        # a folder without its row in the table of rounds was broken off
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log").where(F.col("round") <= last["round"])
        queue = log.where(_behind(last))
        fetchable = F.col("status") == "fetched"
        seen = queue.agg(
            F.max(F.struct("round", "at")).alias("end"),
            F.count_if(fetchable).alias("fetchable"),
            F.sum(F.when(fetchable, F.octet_length("url") + ROW_OVERHEAD)).alias("bytes"),
        ).first()
        if seen["end"] is None:
            break
        left, end = max_pages - last["fetched"], tuple(seen["end"])
        if seen["fetchable"] >= left:
            end = _nth_place(queue.where(fetchable), left)
        taken = queue.where(fetchable & ~_behind_place(*end)).select("url", F.struct("round", "at").alias("_from"))
        # a page's links are as many as its text can hold, so no key of this join is hot
        batch = F.broadcast(taken) if (seen["bytes"] or 0) <= BROADCAST_BYTES else taken
        fresh = (
            edges.join(batch, "url")
            .groupBy(F.col("abs_url").alias("url"))
            .agg(F.min(F.struct("_from", "pos")).alias("_first"), F.first("status").alias("status"))
            .join(log.select("url"), "url", "left_anti")
        )
        fetched = last["fetched"] + min(left, seen["fetchable"])
        last = _append_round(written(fresh, "fresh"), ["_first"], path, last["round"] + 1, (fetched, *end))
    return _crawled(spark, path, last)


def _behind(last) -> Column:
    return _behind_place(last["done_round"], last["done_at"])


def _behind_place(done_round: int, done_at: int) -> Column:
    """Log rows after a place."""
    return (F.col("round") > done_round) | ((F.col("round") == done_round) & (F.col("at") > done_at))


def _append_round(found: DataFrame, order: list[str], path: str, number: int, state: tuple) -> dict:
    """Write a round's new URLs in their order, then the row that says so."""
    placed = found.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("url", "status", F.monotonically_increasing_id().alias("at"))
    placed.write.mode("overwrite").parquet(f"{path}/log/round={number}")
    row = (number, *state)
    found.sparkSession.createDataFrame([row], ROUNDS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/rounds")
    return dict(zip(("round", "fetched", "done_round", "done_at"), row, strict=True))


def _nth_place(rows: DataFrame, n: int) -> tuple[int, int]:
    """Round and place of the ``n``-th of the given log rows, by counting."""
    counts = rows.groupBy("round").agg(F.count(F.lit(1)).alias("rows")).orderBy("round").collect()
    for row in counts:
        if n <= row["rows"]:
            return row["round"], nth_smallest(rows.where(F.col("round") == row["round"]), "at", n)
        n -= row["rows"]
    raise ValueError("fewer rows than that")


def _crawled(spark, path: str, last: dict) -> FrontierStep:
    """Number the log: offsets per round and partition turn places into the visiting order."""
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log").where(F.col("round") <= last["round"])
    log = log.withColumn("_part", part_of("at"))
    # one row per round and task
    sizes = log.groupBy("round", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    so_far = W.orderBy("round", "_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = sizes.select("round", "_part", (F.sum("_rows").over(so_far) - F.col("_rows")).alias("_before"))
    seq = (F.col("_before") + place_in_part("at")).alias("seq")
    numbered = log.join(F.broadcast(offsets), ["round", "_part"])
    queued = _behind(last)
    return FrontierStep(
        numbered.where(queued).select("url", seq), numbered.where(~queued).select("url", seq, "status"), last["fetched"]
    )


def crawl_summary(visited: DataFrame, frontier: DataFrame) -> DataFrame:
    """One row: pages fetched, unique URLs visited, URLs still queued."""
    return visited.agg(
        F.count_if(F.col("status") == "fetched").alias("pages_fetched"),
        F.count(F.lit(1)).alias("urls_visited"),
    ).withColumn("urls_remaining", frontier.agg(F.count(F.lit(1))).scalar())


def crawl_depth(links: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``url, depth``: hops from the seeds over ``links(url, abs_url)``, up to ``max_depth`` where one is given.

    One join, one distinct and one anti-join per level. Every level is a written table, so plans stay short and a
    lost executor repeats at most one level. The level is broadcast only while it fits. Each level reads ``links``,
    which should therefore be a stored table.
    """
    edges = links.select("url", cut_fragment("abs_url").alias("_to"))
    level = written(seeds.select("url").distinct().withColumn("depth", F.lit(0).cast("bigint")), "depth")
    reached = level
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        step = (
            lookup_join(edges, level.select("url"), "url", spread_by="_to")
            .select(F.col("_to").alias("url"))
            .distinct()
            .join(reached.select("url"), "url", "left_anti")
        )
        level = written(step.withColumn("depth", F.lit(depth).cast("bigint")), "depth")
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    return reached
