"""Plans that must not depend on how the rows are spread: hot keys, large result lists, long rule lists, resumed crawls."""

import random

import pytest
from brute import Corpus
from pyspark.sql import functions as F
from test_crawl import NO_VISITS, RULES_SCHEMA, SEEDS, simulated, site_of, tables
from test_search import indexed, random_texts

from pagequarry.checks import index_checks
from pagequarry.operators import robots
from pagequarry.operators import search as search_module
from pagequarry.operators.frontier import crawl
from pagequarry.operators.index import build_index, shard_tokens
from pagequarry.operators.robots import drop_disallowed
from pagequarry.operators.search import Searcher
from pagequarry.plans import joins, ordering
from pagequarry.sources.index_store import save_index


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- order ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ranges", [2, 7, 4_096])
def test_the_nth_value_is_found_by_counting(spark, monkeypatch, ranges):
    monkeypatch.setattr(ordering, "RANGES", ranges)
    rng = random.Random(ranges)
    values = [rng.randrange(-50, 50) for _ in range(200)] + [-(1 << 63), (1 << 63) - 1, None, None]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").cache()
    ordered = sorted(v for v in values if v is not None)
    for n in (1, 2, 100, 201, 202):
        assert ordering.nth_smallest(df, "v", n) == ordered[n - 1]
    assert ordering.nth_smallest(df, "v", 203) is None and ordering.nth_smallest(df, "v", 0) is None
    assert ordering.nth_smallest(df.limit(0), "v", 1) is None


def test_the_cut_is_the_same_plan_for_any_n(spark):
    table = joins.written(spark.range(20_000).withColumnRenamed("id", "seq"), "seq")
    few, many = (ordering.first_rows(table, "seq", n) for n in (9_999, 10_001))
    assert (few.count(), many.count()) == (9_999, 10_001)
    for df in (few, many):
        assert "TakeOrdered" not in plan_of(df) and "Sort" not in plan_of(df) and "Exchange" not in plan_of(df)
    assert ordering.first_rows(table, "seq", 0).count() == 0 and ordering.first_rows(table, "seq", 30_000).count() == 20_000


def test_ranks_of_groups_that_span_partitions(spark):
    rng = random.Random(5)
    data = [(g, rng.randrange(40), i) for g, n in (("a", 300), ("b", 1), ("c", 40)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, x int, i int").repartition(5)
    ranked = ordering.rank_rows(df, ["g"], [F.desc("x"), "i"], "rank")
    expected = {}
    for g in "abc":
        for rank, (_, x, i) in enumerate(sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            expected[g, i] = rank
    assert {(r.g, r.i): r["rank"] for r in ranked.collect()} == expected


# -- joins ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("part_rows", [4, 1_000_000])
def test_joins_with_split_keys_equal_plain_joins(spark, monkeypatch, rows, part_rows):
    monkeypatch.setattr(joins, "PART_ROWS", part_rows)
    left = spark.range(1_200).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 240 = 1 then 'warm' when id % 7 = 0 then null else concat('k', id) end k", "id"
    )
    right = spark.createDataFrame([("hot", 1), ("warm", 2), ("k2", 3), ("k2", 4), (None, 5)], "k string, v int")
    for how in ("inner", "left", "left_anti", "left_semi"):
        plain = rows(left.join(right, "k", how))
        assert rows(joins.hot_split_join(left, right, "k", how, "id")) == plain
        assert rows(joins.lookup_join(left, right, "k", how, "id", limit=0)) == plain


def test_parts_follow_the_rows_of_each_key_not_their_share(spark):
    # a key with 0.4 percent of the rows is above the limit, one with half of that is not
    counted = spark.createDataFrame([("hot", 400_000), ("warm", 4_000), ("cool", 1_000)], "k string, rows bigint")
    assert {r.k: r["_parts"] for r in joins.key_parts(counted, "k", 1_000).collect()} == {"hot": 400, "warm": 4}


def test_a_split_key_is_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "PART_ROWS", 500)
    left = spark.range(20_000).selectExpr("if(id % 250 = 0, 'hot', concat('k', id)) k", "id")  # 0.4 percent, 80 rows
    monkeypatch.setattr(joins, "PART_ROWS", 10)
    right = left.select("k").distinct().withColumn("v", F.lit(1))
    joined = joins.hot_split_join(left, right, "k", "inner", "id").withColumn("part", F.spark_partition_id())
    monkeypatch.undo()
    assert joined.count() == 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert joined.where("k = 'hot'").select("part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# -- search -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("limit,top_k", [(0, 1), (0, 4), (0, 1_000), (1_000, 4), (0, None), (0, 0)])
def test_any_top_k_is_the_head_of_the_whole_list(spark, monkeypatch, limit, top_k, broadcast):
    monkeypatch.setattr(search_module, "GROUP_LIMIT", limit)
    monkeypatch.setattr(search_module, "SCORE_RANGES", 8)
    if not broadcast:
        monkeypatch.setattr(search_module, "fits_broadcast", lambda df, limit=0: False)
    texts = random_texts(21)
    corpus, searcher = Corpus(texts), Searcher(indexed(spark, texts))
    queries = ["fox dog fox", "the quick", "nosuch", "fox dog fox"]
    table = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, text string")
    found = searcher.search(table, "smooth", top_k, matches=True).collect()
    for i, query in enumerate(queries):
        whole = corpus.ranking(query, "smooth")
        mine = sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])
        assert [r.doc_id for r in mine] == [d for d, _ in whole][:top_k]
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r.matches for r in mine} <= {len(whole)}


def test_whole_lists_are_not_sorted_a_query_at_a_time(spark):
    searcher = Searcher(indexed(spark, random_texts(2)))
    for plan in (plan_of(searcher.search("fox", top_k=k)) for k in (None, 5_000)):
        # ranks come from written places; the only windows left run over partition sizes, which are written too
        assert "Window" not in plan and "CartesianProduct" not in plan


def test_many_terms_prune_folders_when_the_plan_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search_module, "LITERAL_TERMS", 2)
    texts = random_texts(8)
    corpus, index = Corpus(texts), save_index(indexed(spark, texts), str(tmp_path / "index"), buckets=16)
    searcher = Searcher(index)
    query = "fox dog the quick lazy"
    found = searcher.search(query, top_k=5)
    plan = plan_of(found)
    assert plan.count("dynamicpruning") >= 2
    assert [r.doc_id for r in found.orderBy("rank").collect()] == [d for d, _ in corpus.ranking(query, "classic")[:5]]
    shown = searcher.with_metadata(searcher.search(query, top_k=5))
    assert "dynamicpruning" in plan_of(shown) and shown.count() == len(found.collect())
    asked = ["fox", "red", "the", "nosuch", "x"]
    statistics = searcher.term_statistics(asked)
    assert "dynamicpruning" in plan_of(statistics)
    assert [r.status for r in statistics.orderBy("query_id").collect()] == ["found", "found", "found", "not_found", "invalid"]


# -- robots -----------------------------------------------------------------------------------------------------


def test_long_rule_lists_are_looked_up(spark, monkeypatch):
    rules = [("h", i, "disallow", f"/dir{i}/") for i in range(3_000)] + [(None, 0, "disallow", "/all/x"), ("g", 0, "disallow", "/é")]
    urls = [f"http://h/dir{i}/page" for i in range(0, 4_000, 7)] + [f"http://g/dir{i}/" for i in range(5)]
    urls += ["http://h/all/xy", "http://q/all/x", "http://q/all/", "http://g/éa", "http://h/dir5", "mailto:x", None]
    df = spark.createDataFrame([(u, i) for i, u in enumerate([*urls, urls[0]])], "url string, i int").repartition(3)
    rule_table = spark.createDataFrame(rules, RULES_SCHEMA)
    results = []
    for listed in (10_000, 5):
        monkeypatch.setattr(robots, "LISTED_PREFIXES", listed)
        flagged = robots.flag_disallowed(df, rule_table, "url")
        assert flagged.columns == ["url", "i", "disallowed"]
        results.append({r.i: bool(r.disallowed) for r in flagged.collect()})
    assert results[0] == results[1]
    assert sum(results[1].values()) == len(range(0, 3_000, 7)) + 1 + 3
    plan = plan_of(robots.flag_disallowed(df, rule_table, "url"))
    assert "collect_set(_prefix" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    kept = {r.url for r in drop_disallowed(df.where("url is not null"), rule_table, "url").collect()}
    assert "http://h/dir5" in kept and "http://h/dir7/page" not in kept and "http://q/all/" in kept


# -- crawl ------------------------------------------------------------------------------------------------------


def answers(result):
    return (
        [(r.url, r.status) for r in result.visited.orderBy("seq").collect()],
        [r.url for r in result.frontier.orderBy("seq").collect()],
    )


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_a_crawl_goes_on_where_it_stopped(spark, tmp_path, seed):
    site = site_of(seed, 60)
    pages, frontier, rules = tables(spark, site, SEEDS)
    for budget in (2, 3, 7, 8, 30, 10_000):
        result = crawl(pages, frontier, rules, budget, "h", path=str(tmp_path / "crawl"))
        assert answers(result) == simulated(site, SEEDS, ["/x"], "h", budget)
        everything = result.visited.select("seq").union(result.frontier.select("seq"))
        assert sorted(r.seq for r in everything.collect()) == list(range(everything.count()))
    assert result.fetched == sum(s == "fetched" for _, s in answers(result)[0])


def test_a_broken_round_is_written_anew(spark, tmp_path):
    site = site_of(3, 60)
    pages, frontier, rules = tables(spark, site, SEEDS)
    path = str(tmp_path / "crawl")
    crawl(pages, frontier, rules, 3, "h", path=path)
    finished = spark.read.parquet(f"{path}/rounds").agg(F.max("round")).first()[0]
    # a round without its row never happened
    spark.createDataFrame([("http://h/p9", "fetched", 0)], "url string, status string, at bigint").write.parquet(f"{path}/log/round={finished + 1}")
    assert answers(crawl(pages, frontier, rules, 3, "h", path=path)) == simulated(site, SEEDS, ["/x"], "h", 3)
    assert answers(crawl(pages, frontier, rules, 40, "h", path=path)) == simulated(site, SEEDS, ["/x"], "h", 40)


def test_a_crawl_without_seeds_starts_at_the_base_url(spark):
    site = site_of(2)
    pages, frontier, rules = tables(spark, site, SEEDS)
    nothing = frontier.limit(0)
    assert answers(crawl(pages, nothing, rules, 6, "h", base_url="http://h/p1")) == simulated(site, ["http://h/p1"], ["/x"], "h", 6)
    assert answers(crawl(pages, nothing, rules, 6, "h")) == ([], [])
    assert NO_VISITS


def test_frequent_keys_are_sent_and_others_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 200)
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["hot"] * 50 + ["warm"] * 5 + ["a", "b", "c", "d", "gone", None])], "term string, doc_id int")
    right = spark.createDataFrame([("hot", 50), ("warm", 5), ("a", 1), ("b", 1), ("c", 1), ("d", 1)], "term string, df bigint")
    assert joins.least_frequent(right, "df") == 5
    found = joins.frequent_first_join(left, right, "term", "df", "doc_id")
    plain = left.join(right, "term", "left").select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert joins.least_frequent(right, "df", 10) is None and joins.least_frequent(right, "df", 10_000) == 0
    assert sorted(map(str, joins.frequent_first_join(left, right, "term", "df", "doc_id").collect())) == sorted(map(str, plain.collect()))


def test_tokens_are_shuffled_as_strings(spark, tmp_path):
    texts = [(1, "one two two three"), (2, None), (3, "A b c"), (1, "zwei two drei_4 two"), (None, "two eins")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    index = build_index(docs, fields=["text"], metadata=[])
    sharded = shard_tokens(index.tokenized, 8, 3).collect()
    assert all(r.shard in range(3) for r in sharded)
    # at most a row per document and shard, each token in one of them
    assert len(sharded) <= 3 * 4
    assert sum(len(r.words.split(" ")) for r in sharded) == 10
    stored = save_index(index, str(tmp_path), 8)
    columns = ["term", "doc_id", "tf", "doc_len"]
    assert sorted(map(str, stored.postings.select(columns).collect())) == sorted(map(str, index.postings.select(columns).collect()))


def test_token_statistics_move_texts_only(spark, tmp_path):
    docs = spark.createDataFrame([(1, "s", "one two two", "en"), (2, "s", None, "en"), (None, "src", "x", "deu")], "doc_id bigint, source string, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = index_checks.tokens_fields(spark, str(tmp_path))
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(doc_id" in plan
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 3, 2, 2, "one", "two"), (None, 2, 1, 2, "src", "deu")]
