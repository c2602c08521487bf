"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

from scenetrail.llm.common import CHECKS, QUERIES, Query

MODULES = ("mix", "decontaminate", "url_rules", "near_dedup", "quality", "fingerprints", "token_counts", "html_text", "line_dedup", "licences", "prefix_trie", "piece_encoding", "source_divergence")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"scenetrail.llm.{module}")
    return dict(QUERIES)


def all_checks() -> dict[str, str]:
    all_queries()
    return dict(CHECKS)
