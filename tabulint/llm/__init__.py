"""Operators that prepare training data for language models, with their queries and SQL texts."""

from tabulint.llm.oracles import ORACLES
from tabulint.llm.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
