"""Row-local rule predicates as Catalyst expressions."""

from rowsieve.functions.predicates import ROW_LOCAL, epoch_seconds, violation

__all__ = ["ROW_LOCAL", "epoch_seconds", "violation"]
