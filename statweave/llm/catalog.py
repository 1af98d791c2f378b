"""Queries of the corpus operators, each beside its SQL where SQL can say it."""

from statweave.llm import queries_native, queries_selection, queries_text  # noqa: F401
from statweave.llm.registry import ORACLES, QUERIES  # noqa: F401
