"""Validation rules that compile to columns and keep every error.

A rule gives two columns: the values it passes and the texts of what failed; a row is
valid when nothing failed. Rules combine with ``&`` and ``|``::

    rule = (unique_product("name", {"b", "c"}) | known_spec_map("spec", {21: "a"})) & unique_spec("id", {2, 3})
    validate(df, rule)

Members of a set are literals of the query. For a large set, mark the rows first with
``joins.flag_member`` and use ``flagged``.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = "cast(array() as array<string>)"


def _none() -> Column:
    return F.expr(NONE)


@dataclass(frozen=True)
class Rule:
    values: Column
    errors: Column

    @property
    def valid(self) -> Column:
        return F.size(self.errors) == 0

    def __and__(self, other: Rule) -> Rule:
        """Values of both; all errors of both."""
        errors = F.concat(self.errors, other.errors)
        return Rule(F.when(F.size(errors) == 0, F.concat(self.values, other.values)).otherwise(_none()), errors)

    def __or__(self, other: Rule) -> Rule:
        """Values of the valid sides; errors only if both fail."""
        errors = F.when(self.valid | other.valid, _none()).otherwise(F.concat(self.errors, other.errors))
        return Rule(F.concat(self.values, other.values), errors)


def _rule(passed: Column, value: Column, name: str) -> Rule:
    ok = F.coalesce(passed, F.lit(False))
    return Rule(
        F.when(ok, F.array(value.cast("string"))).otherwise(_none()),
        F.when(ok, _none()).otherwise(F.array(F.lit(f"{name} failed"))),
    )


def _member(column: str, members: Collection) -> Column:
    return F.coalesce(F.col(column).isin(list(members)), F.lit(False)) if members else F.lit(False)


def in_set(column: str, members: Collection, name: str) -> Rule:
    return _rule(_member(column, members), F.col(column), name)


def not_in_set(column: str, members: Collection, name: str) -> Rule:
    return _rule(~_member(column, members), F.col(column), name)


def in_map(column: str, members: Mapping, name: str) -> Rule:
    return in_set(column, members.keys(), name)


def optional_in_set(column: str, members: Collection, name: str) -> Rule:
    """A missing value passes."""
    return _rule(F.col(column).isNull() | _member(column, members), F.col(column), name)


def optional_in_map(column: str, members: Mapping, name: str) -> Rule:
    return optional_in_set(column, members.keys(), name)


def flagged(column: str, flag: str, name: str) -> Rule:
    """Passes where the boolean column ``flag`` is true."""
    return _rule(F.col(flag), F.col(column), name)


# The named rules; their names are part of the error texts (fixed values).


def unique_product(column: str, taken: Collection) -> Rule:
    return not_in_set(column, taken, "uniqueProductName")


def known_product(column: str, known: Collection) -> Rule:
    return in_set(column, known, "knownProductName")


def known_product_map(column: str, known: Mapping) -> Rule:
    return in_map(column, known, "knownProductMap")


def known_product_optional(column: str, known: Mapping) -> Rule:
    return optional_in_map(column, known, "knownProductOpt")


def known_spec(column: str, known: Collection) -> Rule:
    return in_set(column, known, "knownSpecSet")


def unique_spec(column: str, taken: Collection) -> Rule:
    return not_in_set(column, taken, "uniqueSpec")


def known_spec_map(column: str, known: Mapping) -> Rule:
    return in_map(column, known, "knownSpecMap")


def known_spec_optional(column: str, known: Mapping) -> Rule:
    return optional_in_map(column, known, "knownSpecOptMap")


def validate(df: DataFrame, rule: Rule) -> DataFrame:
    """Adds ``valid``, ``valid_values`` (empty when invalid) and ``errors``."""
    return df.withColumns(
        {
            "valid": rule.valid,
            "valid_values": F.when(rule.valid, rule.values).otherwise(_none()),
            "errors": rule.errors,
        }
    )
