"""Importing this module registers every query of the package."""

from tidemark.llm import chat, exact, langid, lexical, mixing, near, packing, quality, scoring, substrings, trie, urls, warc  # noqa: F401
from tidemark.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
