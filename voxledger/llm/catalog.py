"""All registered queries of this folder."""

from . import bpe, decontamination, exact_dedup, html_text, jaccard_join, license_scan, prefix_trie, quality, suffix_dedup, token_count, url_filter, warc, whitening  # noqa: F401
from .common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
