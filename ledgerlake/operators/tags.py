"""Tags of columns (personal, regulatory, terms of a glossary), kept in the columns' metadata.

Spark carries metadata through selections, renames, joins and Parquet files, so that a tag stays with its column by
whatever name it goes; a column that is worked out anew has none. Policies are derived from tags instead of names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ledgerlake.operators.policies import Policy

KEY = "ledgerlake.tags"


def tagged(df: DataFrame, tags: Mapping[str, Sequence[str]]) -> DataFrame:
    """df with these tags added to its columns."""
    for c, new in tags.items():
        field = df.schema[c]
        df = df.withMetadata(c, {**field.metadata, KEY: sorted({*field.metadata.get(KEY, []), *new})})
    return df


def tags_of(df: DataFrame) -> dict[str, list[str]]:
    return {f.name: list(f.metadata[KEY]) for f in df.schema.fields if f.metadata.get(KEY)}


def with_tag(df: DataFrame, *tags: str) -> list[str]:
    """Columns that have one of these tags; a tag stands for those below it too (personal: personal.name)."""
    below = lambda t: any(t == x or t.startswith(f"{x}.") for x in tags)
    return [c for c, have in tags_of(df).items() if any(map(below, have))]


def policy(df: DataFrame, rows: Sequence[Column], denied: Sequence[str] = (), hidden: Sequence[str] = ()) -> Policy:
    """The policy for df of a role that doesn't see columns with the tags `denied`, and sees those with `hidden` masked."""
    gone = with_tag(df, *denied)
    return Policy(rows, denied=gone, hidden=[c for c in with_tag(df, *hidden) if c not in gone])
