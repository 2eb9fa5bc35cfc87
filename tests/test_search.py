import random

import pytest
from brute import Corpus, words

from pagequarry.operators import search as search_module
from pagequarry.operators.index import build_index, explode_tokens, number_documents
from pagequarry.operators.search import Searcher
from pagequarry.plans import joins
from pagequarry.sources.index_store import index_exists, load_index, load_or_build, save_index

FIVE = {
    0: "Ancient city, ancient temple",
    1: "city of x",
    2: "ancient city temple",
    3: "a b",
    4: "city temple city temple",
}
SCORES = {
    ("ancient city", "classic"): [(0, 0.513931), (2, 0.379811), (1, 0.223144), (4, 0.111572)],
    ("ancient city", "smooth"): [(1, 1.182322), (0, 1.142154), (2, 0.958490), (4, 0.591161)],
    ("city city ancient", "classic"): [(0, 0.569717), (2, 0.454193), (1, 0.446287), (4, 0.223144)],
    ("city city ancient", "smooth"): [(1, 2.364643), (0, 1.437734), (2, 1.352597), (4, 1.182322)],
    ("temple city", "classic"): [(4, 0.366985), (2, 0.244656), (1, 0.223144), (0, 0.183492)],
    ("temple city", "smooth"): [(4, 1.293893), (1, 1.182322), (2, 0.862596), (0, 0.646947)],
}
VOCABULARY = ["red", "blue", "fox", "hill", "river", "stone", "the", "the", "the", "gate", "of", "été"]


def docs_of(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")


def indexed(spark, texts):
    return build_index(docs_of(spark, texts), fields=["text"])


def random_texts(seed, n=60):
    rng = random.Random(seed)
    return {d: " ".join(rng.choices(VOCABULARY, k=rng.choice([0, 1, 3, 8, 20]))) for d in range(n)}


@pytest.fixture(scope="module")
def five(spark):
    return Searcher(indexed(spark, FIVE))


def test_statistics_of_five_documents(five, rows):
    index = five.index
    stats = index.corpus_stats.first()
    assert (stats.total_docs, stats.total_unique_terms, stats.indexed_fields) == (5, 3, ["text"])
    assert rows(index.term_df) == [("ancient", 2, 3), ("city", 4, 5), ("temple", 3, 4)]
    assert rows(index.doc_lengths) == [(0, 4), (1, 1), (2, 3), (3, 0), (4, 4)]


@pytest.mark.parametrize("query,method", SCORES)
def test_known_scores(five, query, method):
    found = five.search(query, method).orderBy("rank").collect()
    assert [(r.doc_id, round(r.score, 6)) for r in found] == SCORES[query, method]
    assert [r.rank for r in found] == [1, 2, 3, 4]


def test_any_other_method_name_is_classic(five, rows):
    assert rows(five.search("ancient city", "other").drop("method")) == rows(five.search("ancient city").drop("method"))


def test_ties_follow_the_query_order(spark):
    searcher = Searcher(indexed(spark, {10: "red fox", 11: "blue fox"}))
    ranked = searcher.search(["blue red", "red blue"]).orderBy("query_id", "rank").collect()
    assert [r.doc_id for r in ranked] == [11, 10, 10, 11]


def test_zero_scores_still_match(spark):
    searcher = Searcher(indexed(spark, {0: "fox", 1: "fox hill"}))
    assert [(r.doc_id, r.score) for r in searcher.search("fox").collect()] == [(0, 0.0), (1, 0.0)]


def test_empty_and_unknown_queries_have_no_rows(five):
    assert five.search(["", "of x", "harbour"]).count() == 0
    counts = five.match_counts(["", "harbour", "ancient city"]).orderBy("query_id").collect()
    assert [r.matches for r in counts] == [0, 0, 4]


def test_top_k_bounds(five):
    assert five.search("city", top_k=0).count() == 0
    assert five.search("city", top_k=2).count() == 2
    with pytest.raises(ValueError):
        five.search("city", top_k=-1)


def test_empty_index_is_refused(spark):
    with pytest.raises(ValueError):
        Searcher(build_index(docs_of(spark, {0: "a"}).limit(0), fields=["text"]))


@pytest.mark.parametrize("way", ["broadcast", "salted"])
@pytest.mark.parametrize("stored", [False, True])
def test_batches_equal_brute_force(spark, tmp_path, monkeypatch, way, stored):
    texts = random_texts(3)
    corpus = Corpus(texts)
    queries = [" ".join(random.Random(i).choices(VOCABULARY, k=i % 6)) for i in range(12)] + ["red the fox"] * 3
    table = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, text string")
    if way == "salted":
        monkeypatch.setattr(search_module, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(search_module, "LITERAL_TERMS", 0)
    index = indexed(spark, texts)
    if stored:
        index = save_index(index, str(tmp_path / "index"), buckets=3)
    searcher = Searcher(index)
    got = {}
    for r in searcher.compare(table, top_k=7).orderBy("rank").collect():
        got.setdefault((r.query_id, r.method), []).append((r.doc_id, r.score))
    expected = {
        (i, m): corpus.ranking(q, m)[:7]
        for i, q in enumerate(queries)
        for m in ("classic", "smooth")
        if corpus.ranking(q, m)
    }
    assert got.keys() == expected.keys()
    for key, ranking in expected.items():
        assert [d for d, _ in got[key]] == [d for d, _ in ranking], key
        assert [s for _, s in got[key]] == pytest.approx([s for _, s in ranking], abs=1e-12)
    counts = {r.query_id: r.matches for r in searcher.match_counts(table).collect()}
    assert counts == {i: len(corpus.ranking(q, "classic")) for i, q in enumerate(queries)}


def test_comparison_is_the_union_of_two_searches(five, rows):
    both = five.search("ancient city", "classic").unionByName(five.search("ancient city", "smooth"))
    assert rows(five.compare("ancient city")) == rows(both)


def test_ranking_does_not_depend_on_partitions(spark, rows):
    texts = random_texts(5)
    ranked = [
        rows(Searcher(build_index(docs_of(spark, texts).repartition(n), fields=["text"])).search("red the fox hill"))
        for n in (1, 7)
    ]
    assert ranked[0] == ranked[1]


def test_term_statistics(five, spark):
    for inputs in (["City", "harbour", "of", "temple and city"],):
        got = {r.input: r for r in five.term_statistics(inputs).collect()}
    assert (got["City"].status, got["City"].document_frequency, got["City"].total_occurrences) == ("found", 4, 5)
    assert got["City"].percentage_of_docs == pytest.approx(80)
    assert got["City"].idf_classic == pytest.approx(0.22314355)
    assert (got["harbour"].status, got["harbour"].term, got["harbour"].idf_smooth) == ("not_found", "harbour", None)
    assert (got["of"].status, got["of"].term) == ("invalid", None)
    assert got["temple and city"].term == "temple"


def test_term_statistics_of_many_inputs(five, monkeypatch, rows):
    few = rows(five.term_statistics(["City", "harbour", "of"]))
    monkeypatch.setattr(search_module, "LITERAL_TERMS", 0)
    assert rows(five.term_statistics(["City", "harbour", "of"])) == few


def test_idf_of_unseen_terms(five):
    got = {r.term: r for r in five.idf_table(["city", "harbour"]).collect()}
    assert got["harbour"].idf_classic == 0
    assert got["harbour"].idf_smooth == pytest.approx(2.791759469)
    assert got["harbour"].df == 0


def test_weights_of_postings_and_of_pairs(spark, monkeypatch):
    texts = random_texts(9)
    corpus = Corpus(texts)
    searcher = Searcher(indexed(spark, texts))
    # every term above two documents counts as hot and is split
    monkeypatch.setattr(joins, "PART_ROWS", 2)
    got = {(r.term, r.doc_id): (r.tfidf_classic, r.tfidf_smooth) for r in searcher.weights().collect()}
    assert len(got) == sum(len(c) for c in corpus.counts.values())
    for (term, d), (classic, smooth) in got.items():
        tf = corpus.counts[d][term] / corpus.length[d]
        assert classic == pytest.approx(tf * corpus.idf(term, "classic"))
        assert smooth == pytest.approx(tf * corpus.idf(term, "smooth"))
    pairs = spark.createDataFrame([("fox", 999), ("nosuch", 1)], "term string, doc_id bigint")
    assert [r.tfidf for r in searcher.weights_by("smooth", pairs).collect()] == [0.0, 0.0]


def test_display(spark):
    records = spark.createDataFrame(
        [(0, "u0", "Old fox", "", "Cultural"), (1, None, None, "Testland", "")],
        "doc_id bigint, url string, name string, contry string, type string",
    )
    searcher = Searcher(build_index(records.withColumn("description", records.doc_id.cast("string"))))
    shown = searcher.display(searcher.search(["fox", "testland"])).orderBy("query_id").collect()
    assert [tuple(r)[1:] for r in shown] == [
        (1, "Old fox", "0.2310", "u0", None, "Cultural"),
        (1, "N/A", "0.6931", "N/A", "Testland", None),
    ]


def test_tokens_come_in_field_order_and_absent_fields_are_skipped(spark, rows):
    docs = spark.createDataFrame([(1, "one two", None, "three"), (2, "", "", "")], "doc_id int, a string, b string, c string")
    assert rows(explode_tokens(docs, ["c", "nosuch", "b", "a"])) == [(1, 0, "three"), (1, 1, "one"), (1, 2, "two")]


def test_numbering_follows_the_order(spark):
    urls = [f"u{i:03d}" for i in range(500)]
    shuffled = urls[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(u,) for u in shuffled], "url string").repartition(9)
    assert {r.url: r.doc_id for r in number_documents(df, ["url"]).collect()} == {u: i for i, u in enumerate(urls)}


def test_stored_index_round_trip_and_rebuild(spark, tmp_path, rows):
    path = str(tmp_path / "index")
    assert not index_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        load_index(spark, path)
    built = []

    def build(texts):
        built.append(1)
        return indexed(spark, texts)

    first = load_or_build(spark, path, lambda: build(FIVE), buckets=3)
    again = load_or_build(spark, path, lambda: build(FIVE), buckets=3)
    assert len(built) == 1
    lazy = indexed(spark, FIVE)
    for stored in (first, again, load_index(spark, path)):
        assert rows(stored.postings.select(*lazy.postings.columns)) == rows(lazy.postings)
        assert rows(stored.docs.select(*lazy.docs.columns)) == rows(lazy.docs)
        assert rows(stored.term_df.select(*lazy.term_df.columns)) == rows(lazy.term_df)
        assert rows(stored.doc_lengths) == rows(lazy.doc_lengths)
        assert rows(stored.corpus_stats) == rows(lazy.corpus_stats)
    rebuilt = load_or_build(spark, path, lambda: build({7: "one"}), force_rebuild=True, buckets=3)
    assert rebuilt.total_docs() == load_index(spark, path).total_docs() == 1
    assert first.postings.count() > 1


def test_search_reads_only_the_folders_of_its_terms(spark, tmp_path):
    searcher = Searcher(save_index(indexed(spark, random_texts(2)), str(tmp_path / "index"), buckets=16))
    plan = searcher.search("fox")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    assert "term IN (fox)" in plan or "(term#" in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_invariants(spark):
    texts = random_texts(11)
    index = indexed(spark, texts)
    n = index.total_docs()
    assert index.postings.groupBy().sum("tf").first()[0] == index.doc_lengths.groupBy().sum("doc_len").first()[0]
    assert index.term_df.where(f"df > {n}").count() == 0
    assert sum(len(words(t)) for t in texts.values()) == index.term_df.groupBy().sum("occurrences").first()[0]
