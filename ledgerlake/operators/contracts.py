"""Contracts: rules as data, compiled in one place to an array of reasons per row, and what follows from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import masked, present, pseudonym


class Rule(NamedTuple):
    """A reason for which a row is rejected: a kind of KINDS, the column that it looks at, the kind's argument, and a name if not the kind's own."""

    kind: str
    column: str
    argument: Any = None
    named: str = ""


def _unlike(c: Column, to: tuple[str, Mapping[str, str]]) -> Column:
    other, known = to
    return c != F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[F.col(other)]


#: By kind: when a row breaks the rule (null: it doesn't), and the reason's name, in which {} is the column's.
KINDS: dict[str, tuple[Callable[[Column, Any], Column], str]] = {
    "parsed": (lambda c, _: c.isNotNull(), "MALFORMED_ROW"),
    "required": (lambda c, _: present(c.cast("string")).isNull(), "MISSING_{}"),
    "one_of": (lambda c, values: ~c.isin(*values), "INVALID_{}"),
    "at_least": (lambda c, least: c < least, "NEGATIVE_{}"),
    "goes_with": (_unlike, "CURRENCY_COUNTRY_MISMATCH"),
}


@dataclass(frozen=True)
class Contract:
    """What a row must be like: rules in the order in which their reasons are told, and columns that hold personal values.

    Nulls break `required` alone, as do blanks. A rule `parsed` names the column with the text of what didn't parse.
    """

    rules: Sequence[Rule]
    personal: Sequence[str] = ()

    @property
    def corrupt(self) -> str | None:
        return next((r.column for r in self.rules if r.kind == "parsed"), None)

    def reasons(self) -> Column:
        """Every reason that holds, in order."""
        told = []
        for rule in self.rules:
            broken, name = KINDS[rule.kind]
            told.append(F.when(broken(F.col(rule.column), rule.argument), F.lit(rule.named or name.format(rule.column.upper()))))
        return F.array_compact(F.array(*told))


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons joined by commas)."""
    told, gone = df.withColumn("_reasons", contract.reasons()), [c for c in (contract.corrupt,) if c]
    fine = F.size("_reasons") == 0
    return told.where(fine).drop("_reasons", *gone), told.where(~fine).withColumn("reasons", F.array_join("_reasons", ",")).drop("_reasons")


def reject_records(rejected: DataFrame, contract: Contract, dataset: str, key: str, country: str, source: Column) -> DataFrame:
    """Rejects of any dataset in one shape. The raw record is the text that didn't parse, or else JSON without personal columns."""
    hidden = {*contract.personal, "reasons", contract.corrupt}
    raw = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in rejected.columns if c not in hidden]))
    raw = F.coalesce(F.col(contract.corrupt), raw) if contract.corrupt else raw
    return rejected.select(F.lit(dataset).alias("dataset"), source.alias("source_file"), F.col(country).cast("string").alias("country"), F.col(key).cast("string").alias("record_id"), "reasons", raw.alias("raw_record"))


def without_personal(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """df with <column>_masked and <column>_hash in the place of each personal column; values lose their white space first."""
    plain = {c: F.regexp_replace(F.col(c).cast("string"), r"\s+", "") for c in columns}
    df = df.withColumns({f"{c}_masked": masked(v) for c, v in plain.items()} | {f"{c}_hash": pseudonym(v, salt) for c, v in plain.items()})
    return df.drop(*columns)


def file_stats(valid: DataFrame, rejected: DataFrame, source: str) -> DataFrame:
    """Rows read, valid and rejected of each file."""
    both = valid.select(F.col(source), F.lit(0).alias("bad")).unionByName(rejected.select(F.col(source), F.lit(1).alias("bad")))
    return both.groupBy(source).agg(F.count("*").alias("rows_read"), F.count_if(F.col("bad") == 0).alias("rows_valid"), F.count_if(F.col("bad") == 1).alias("rows_rejected"))


def quality_metrics(df: DataFrame, dataset: str, country: str, flags: Sequence[str]) -> DataFrame:
    """Rows of each country, and how many have each flag, as JSON."""
    counts = F.struct(*[F.count_if(F.col(f)).alias(f) for f in flags])
    return df.groupBy(F.col(country).alias("country")).agg(F.count("*").alias("n_rows"), F.to_json(counts).alias("flags")).withColumn("dataset", F.lit(dataset))
