"""The queries of this subpackage and their SQL."""

from laddermill.llm import bpe, chroma, conversation_trie, decontamination, licenses, mixing, near_dedup, periodic_runs, pii, quality, substring_dedup, suffix_dedup, url_filters

MODULES = (substring_dedup, suffix_dedup, quality, pii, licenses, url_filters, mixing, chroma, bpe, near_dedup, decontamination, periodic_runs, conversation_trie)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
