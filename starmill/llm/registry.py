"""Every operator of this package as a query, with SQL where SQL can check it."""

from importlib import import_module

MODULES = [
    "arc_to_warc", "harmonic_packing", "tree_bpe", "rank_counts", "jaccard_join", "toxicity", "posting_lists",
    "pq_neardup", "sentence_spans", "secret_scan", "centroid_trie", "host_words", "dual_tree",
]

QUERIES = {
    name: pair
    for module in MODULES
    for name, pair in import_module(f"starmill.llm.{module}").QUERIES.items()
}
