"""Every operator applied to the test tables, and the equal SQL text for each."""

from tabulint.catalog.oracles import ORACLES
from tabulint.catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
