"""All queries of this package. Importing this module fills the registry."""

from panelweave.llm import chat, conv_trie, decontam, fill_middle, html_text, mixing, ngram_join, pii, quality, secret_scan, suffix_dedup, token_prefixes, urls  # noqa: F401
from panelweave.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
