"""Who may see which rows and columns: views by role, denied unless allowed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import masked


@dataclass(frozen=True)
class Policy:
    """Rows by conditions of which one must hold (none: no row), columns left out, columns shown masked."""

    rows: Sequence[Column] = ()
    denied: Sequence[str] = ()
    hidden: Sequence[str] = field(default_factory=tuple)

    def view(self, df: DataFrame) -> DataFrame:
        seen = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in self.rows], F.lit(False))
        df = df.where(seen).drop(*self.denied)
        return df.withColumns({c: masked(F.col(c).cast("string")) for c in self.hidden})
