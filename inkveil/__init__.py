"""Find and remove labelled personal data from positioned-text tables with Spark."""

from inkveil.params import RuleParams, RuleSet

__all__ = ["RuleParams", "RuleSet"]
