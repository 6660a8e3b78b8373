"""Column expressions: rules, standard forms, row hashes."""

from tabulint.functions.rules import InRange, IsNull, Matches, NotNull, RuleSet, Stage, Standards, UniqueKey

__all__ = ["InRange", "IsNull", "Matches", "NotNull", "RuleSet", "Stage", "Standards", "UniqueKey"]
