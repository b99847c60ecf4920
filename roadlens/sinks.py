"""Sinks: versioned datasets, manifests, findings and JSON reports. With ``dry_run`` the plan is returned and nothing written."""

from __future__ import annotations

import json
import subprocess
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_dataset(items: DataFrame, path: str, partition: str = "split", dry_run: bool = False) -> DataFrame:
    """A new version, partitioned; earlier versions are never changed. Label text ends in a newline only if it has lines."""
    out = items
    if "lines" in items.columns:
        out = items.withColumn("label_text", F.when(F.size("lines") > 0, F.concat(F.array_join("lines", "\n"), F.lit("\n"))).otherwise(""))
    if not dry_run:
        out.write.mode("error").partitionBy(partition).parquet(path)
    return out


def write_survivors(items: DataFrame, removed: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """The items that aren't removed, as a new version, by path."""
    return write_dataset(items.join(removed.select("path"), "path", "left_anti"), path, dry_run=dry_run)


def append_backgrounds(items: DataFrame, backgrounds: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Items and backgrounds (empty label) as a new version."""
    return write_dataset(items.unionByName(backgrounds, allowMissingColumns=True), path, dry_run=dry_run)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("error").option("header", True).csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("error").json(path)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON string a row, nulls written."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def write_findings(findings: DataFrame, path: str) -> dict:
    """Writes findings as Parquet and returns errors, warnings and passed, counted in the pass that writes: nothing is read twice."""
    seen = Observation()
    counted = findings.observe(seen, F.count_if(F.col("level") == "E").alias("errors"), F.count_if(F.col("level") == "W").alias("warnings"))
    counted.write.mode("error").parquet(path)
    return {**seen.get, "passed": seen.get["errors"] == 0}


def raise_on_errors(findings: DataFrame) -> int:
    """Number of warnings; raises if there is any error."""
    row = findings.agg(F.count_if(F.col("level") == "E").alias("e"), F.count_if(F.col("level") == "W").alias("w")).first()
    if row["e"]:
        raise ValueError(f"validation failed: {row['e']} errors, {row['w']} warnings")
    return row["w"]


def run_metadata(spark: SparkSession, counts: DataFrame, parameters: dict | None = None, output: str | None = None) -> str:
    """JSON of a run: time in UTC, Spark version, git commit if there is one, dataset counts (split, n), parameters."""
    try:
        commit = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=True).stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        commit = None
    return json.dumps(
        {
            "timestamp": datetime.now(UTC).isoformat(),
            "spark_version": spark.version,
            "git_commit": commit,
            "dataset_counts": {r["split"]: r["n"] for r in counts.collect()},  # one row per split
            "parameters": parameters or {},
            "output": output,
        },
        indent=2,
    )


#: Fixed value: what every evaluation report says.
NOTE = "mAP is not sufficient sign-off. Manually review false positives/negatives (see --fp-fn-dir) before recommending deployment."


def evaluation_report(row: DataFrame, weights: str, split: str) -> str:
    """JSON of the one row of ``evaluate.report``, with the weights and the split it was made with."""
    r = row.first()
    names = {"confidence_threshold": "confidence_threshold", "precision": "precision", "recall": "recall", "map50": "mAP50", "map50_95": "mAP50-95", "avg_ms": "avg_inference_latency_ms", "fps": "fps_estimate", "latency_sample": "latency_sample_size"}
    return json.dumps({"weights": weights, "split": split, **{out: r[c] for c, out in names.items()}, "note": NOTE}, indent=2)


def with_contents(items: DataFrame, root: str) -> DataFrame:
    """``items`` with the bytes of their files as ``content``, read from below ``root``: a dataset that holds its images, in any store."""
    files = items.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "content")
    return items.join(files, "path")
