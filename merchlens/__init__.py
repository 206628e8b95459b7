"""Order-source attribution and deal-price analytics as Spark DataFrame operators."""

from merchlens.rules import RULES, RuleSet
from merchlens.scope import Scope
from merchlens.session import configure, materialize

__all__ = ["RULES", "RuleSet", "Scope", "configure", "materialize"]
