"""Plan construction policy (helper-join sizing) and plan inspection."""

from rowsieve.plans.joins import DEFAULT, LAZY, JoinPolicy, sized_side

__all__ = ["DEFAULT", "LAZY", "JoinPolicy", "sized_side"]
