"""Registered queries of the operators, with SQL where SQL can express them."""

from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    fingerprint,
    jaccard_join,
    langid,
    line_dedup,
    manifest,
    mixing,
    oracle,
    piece_bpe,
    surrogates,
    token_trees,
    url_filter,
    vector_graph,
)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_graph(spark, sf_dir):
    """Links and components of all embeddings."""
    return vector_graph.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op2_bpe(spark, sf_dir):
    """Every whole text encoded and decoded, as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary(), outputs=(), keep_text=False)


def op3_language(spark, sf_dir):
    """The language of every whole text, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op4_surrogates(spark, sf_dir):
    """Every whole text with surrogates in the place of personal data. The key is the test's, not a secret."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.pseudonymize(docs, b"key of the registered query")


def op5_line_dedup(spark, sf_dir):
    """Every document without its recurring lines, as counts and a digest."""
    kept = line_dedup.drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text"), min_words=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op6_mixing(spark, sf_dir):
    """How many words the mix takes from each document."""
    sized = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count("text").alias("size"))
    planned = mixing.plan_mix(sized, text="")
    taken = F.col("copies") * F.col("size")
    return planned.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op7_token_counts(spark, sf_dir):
    """Tokens of every whole text before and after two edits: a tenth cut out in the middle, with the beginning of the
    text put there instead, and the first character doubled."""
    half = (F.length("text") / 2).cast("int")
    cut = F.struct(half.alias("start"), (F.length("text") / 10).cast("int").alias("removed"), F.left("text", F.lit(30)).alias("inserted"))
    double = F.struct(F.lit(0).alias("start"), F.lit(0).alias("removed"), F.left("text", F.lit(1)).alias("inserted"))
    docs = documents(spark, sf_dir).select("doc_id", "text", F.array(cut, double).alias("edits"))
    counted = token_trees.count_with_edits(docs, vocabulary())
    return counted.select(
        "doc_id", "n_tokens", "n_tokens_edited", "encoded_again", F.sha2("edited", 256).alias("edited_sha256")
    )


def op8_fingerprint(spark, sf_dir):
    """Fingerprints of every document and its edited text, and how alike they are to each other and to the next."""
    return fingerprint.compare_with_next(documents(spark, sf_dir).select("doc_id", "text"))


def op9_jaccard_join(spark, sf_dir):
    """Groups of documents whose shingle sets are similar."""
    found = jaccard_join.jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def op10_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_manifest(spark, sf_dir):
    """A proof for every document, and what a version says in which some of them are tampered with."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col("n_chars") + 1 if c == "n_chars" else c for c in fields]
    touched = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    built = manifest.build(docs, "doc_id", "lang", fields, F.when(touched, manifest.leaf_digest(tampered)))
    root = F.lit(built.root)
    return manifest.prove(built).select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def op12_alignment(spark, sf_dir):
    """Tokens of two tokenizers aligned over every whole text, with corpus-wide counts of the id pairs that meet."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = alignment.cross_align(docs, vocabulary(), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", *alignment.RESULTS)


def op13_sentencepiece(spark, sf_dir):
    """Every whole text encoded with begin and end ids and decoded, as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return piece_bpe.round_trip(docs, vocabulary("piece_bpe_32k.model"), outputs=(), keep_text=False)


QUERIES = {
    "op1_embedding_graph": op1_embedding_graph,
    "op2_bpe": op2_bpe,
    "op3_language": op3_language,
    "op4_surrogates": op4_surrogates,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_fingerprint": op8_fingerprint,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_url_filter": op10_url_filter,
    "op11_manifest": op11_manifest,
    "op12_alignment": op12_alignment,
    "op13_sentencepiece": op13_sentencepiece,
}
SQL = oracle.SQL
