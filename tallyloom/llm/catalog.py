"""Imports the modules that register the corpus queries."""

from . import chats, jaccard, language, leaks, licences, lines, mixing, pages, pii, repair, tokens, vectors, whitening  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
