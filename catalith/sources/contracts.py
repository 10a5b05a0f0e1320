"""Column contracts: what a table must hold, checked in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what counts as a decimal number.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@dataclass(frozen=True)
class Rule:
    column: str
    required: bool = True
    min_length: int = 0
    integer: bool = False
    minimum: int | None = None


MASTER = (
    Rule("scope"),
    Rule("group_id"),
    Rule("item_id"),
    Rule("title", min_length=1),
    Rule("workload", required=False, integer=True),
)
CHAPTERS = (
    Rule("scope"),
    Rule("group_id"),
    Rule("item_id"),
    Rule("chapter_number", integer=True, minimum=1),
    Rule("chapter_title", min_length=1),
    Rule("attestation", required=False),
)


class ContractError(ValueError):
    """Rows break a contract; ``counts`` maps each broken rule to its rows."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__("; ".join(f"{rule}: {n} rows" for rule, n in sorted(counts.items())))


def as_number(col: Column) -> Column:
    """The number a text holds, or null."""
    text = col.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def as_int(col: Column) -> Column:
    """The whole number a text holds; null for anything else."""
    number = as_number(col)
    return F.when(number == F.floor(number), number.try_cast("long"))


def _checks(rule: Rule) -> list[tuple[str, Column]]:
    col = F.col(rule.column)
    value = as_int(col) if rule.integer else col
    checks = []
    if rule.integer:
        number = as_number(col)
        checks.append(("whole_number", number.isNotNull() & value.isNull()))
    if rule.required:
        missing = as_number(col).isNull() if rule.integer else col.isNull()
        checks.append(("not_null", missing))
    if rule.min_length:
        checks.append((f"min_length_{rule.min_length}", F.length(col) < rule.min_length))
    if rule.minimum is not None:
        checks.append((f"at_least_{rule.minimum}", value < rule.minimum))
    return [(f"{rule.column}.{name}", failed) for name, failed in checks]


def failed_rules(contract: tuple[Rule, ...]) -> Column:
    """Names of the rules a row breaks. Run it before numbers are coerced."""
    names = [F.when(bad, F.lit(name)) for rule in contract for name, bad in _checks(rule)]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


def violations(df: DataFrame, contract: tuple[Rule, ...]) -> DataFrame:
    """Rows per broken rule, all rules in one pass: ``(rule, n)``."""
    broken = df.select(F.explode(failed_rules(contract)).alias("rule"))
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def enforce(df: DataFrame, contract: tuple[Rule, ...]) -> DataFrame:
    """Return ``df`` unchanged, or raise with the rows per broken rule."""
    counts = {row["rule"]: row["n"] for row in violations(df, contract).collect()}
    if counts:
        raise ContractError(counts)
    return df
