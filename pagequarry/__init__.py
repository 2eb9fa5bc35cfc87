"""Page corpora on Spark: extraction, links, an inverted index and ranked search."""
