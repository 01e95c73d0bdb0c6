"""Writers for built datasets and reports."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from chorale.operators.profile import split_report


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_dataset(full: DataFrame, parts: DataFrame, label: str, path: str, mode: str) -> dict:
    """Write ``full`` and the split rows, and return the metadata.

    ``full`` is the balanced table before deduplication, so it may hold more
    rows than the three splits together. The splits are one table partitioned
    by ``split``, so reading one of them prunes the others.
    """
    path = path.rstrip("/")
    write_table(full, f"{path}/full")
    parts.write.mode("overwrite").partitionBy("split").parquet(f"{path}/splits")
    spark = full.sparkSession
    counts = split_report(spark.read.parquet(f"{path}/splits"), label).collect()
    totals = {r["split"]: r["n"] for r in counts if r["level"] == 1}
    metadata = {
        "mode": mode,
        "generated_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "row_counts": {
            "full": spark.read.parquet(f"{path}/full").count(),
            **{s: totals.get(s, 0) for s in ("train", "val", "test")},
        },
        "class_distribution": {
            s: {
                r[label]: r["n"]
                for r in sorted(counts, key=lambda r: -r["n"])
                if r["split"] == s and r["level"] == 0
            }
            for s in ("train", "val", "test")
        },
    }
    spark.createDataFrame([(json.dumps(metadata, indent=2),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/metadata")
    return metadata
