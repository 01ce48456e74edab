"""Validation rules: a name plus a condition that is true when a row breaks the rule.

A condition that evaluates to NULL does not fire (a NULL currency passes the pattern rule,
as in the source system). ``reasons`` concatenates the names of every rule a row breaks,
in declared order; it is ``''`` for a valid row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import CURRENCY_PATTERN


@dataclass(frozen=True)
class Rule:
    name: str
    failed: Callable[[], Column]

    def condition(self) -> Column:
        return self.failed()


def amount_invalid(col: str = "amount") -> Rule:
    return Rule("amount_invalid", lambda: F.col(col).isNull() | (F.col(col) <= 0))


def currency_invalid(col: str = "currency", strict_null: bool = False) -> Rule:
    if strict_null:
        return Rule("currency_invalid", lambda: F.coalesce(~F.col(col).rlike(CURRENCY_PATTERN), F.lit(True)))
    return Rule("currency_invalid", lambda: ~F.col(col).rlike(CURRENCY_PATTERN))


def key_invalid(col: str = "transaction_id") -> Rule:
    return Rule(f"{col}_invalid", lambda: F.col(col).isNull())


def transaction_rules(strict_null_currency: bool = False) -> list[Rule]:
    """The silver rules of the transaction feed, in their declared order."""
    return [amount_invalid(), currency_invalid(strict_null=strict_null_currency), key_invalid("transaction_id")]


def reasons(rules: Sequence[Rule], sep: str = "; ") -> Column:
    # concat_ws skips NULL slots: same string as array/filter/array_join, but stays in codegen
    return F.concat_ws(sep, *[F.when(r.condition(), F.lit(r.name)) for r in rules])
