"""Where a frame comes from, as its plan says: files it scans and the columns that it reads of them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sources(df: DataFrame) -> dict[str, set[str]]:
    """Columns read, by table (the name of the scanned folder or file). Nothing is run."""
    leaves, out = df._jdf.queryExecution().sparkPlan().collectLeaves(), {}
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            path = leaf.relation().location().rootPaths().head().getName()
            out.setdefault(path.removesuffix(".parquet"), set()).update(leaf.requiredSchema().fieldNames())
    return out
