"""Writers of annotation files and reports. Tables are written by Spark, which commits them whole;
small reports are rendered from collected summaries, first findings only."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as p


def write_table(df: DataFrame, path: str, fields: list[str]) -> None:
    """CSV with the fields in order; absent ones are empty and others are left out."""
    cells = [F.coalesce(df[f].cast("string"), F.lit("")).alias(f) if f in df.columns else F.lit("").alias(f) for f in fields]
    df.select(*cells).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line, keys sorted."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_cvat(images: DataFrame, path: str) -> None:
    """Images (seq, name, width, height, boxes) as CVAT XML, numbered from 0 in order of seq: two
    decimals, three for rotations."""
    box = lambda b: F.struct(b["label"].alias("_label"), *[F.format_string("%.2f", b[k]).alias(f"_{k}") for k in ("xtl", "ytl", "xbr", "ybr")], F.format_string("%.3f", b["rotation"]).alias("_rotation"))
    rows = images.select(F.col("seq").cast("string").alias("_id"), F.col("name").alias("_name"), F.col("width").cast("string").alias("_width"), F.col("height").cast("string").alias("_height"), F.transform("boxes", box).alias("box"))
    rows.write.mode("overwrite").format("xml").options(rootTag="annotations", rowTag="image").save(path)


def write_cvat_polygons(images: DataFrame, path: str, label: str = "ship") -> None:
    """Images (seq, name, width, height, polygons) as CVAT XML, with points to two decimals."""
    shape = lambda r: F.struct(F.lit(label).alias("_label"), F.lit("0").alias("_occluded"), F.lit("manual").alias("_source"), p.points_to_text(r).alias("_points"))
    rows = images.select(F.col("seq").cast("string").alias("_id"), F.col("name").alias("_name"), F.col("width").cast("string").alias("_width"), F.col("height").cast("string").alias("_height"), F.transform("polygons", shape).alias("polygon"))
    rows.write.mode("overwrite").format("xml").options(rootTag="annotations", rowTag="image").save(path)


def write_yolo(labels: DataFrame, path: str) -> None:
    """Label lines of tiles (tile_key, line, class_id, poly, tile_width, tile_height), in one folder for
    each tile, in order of line."""
    text = p.yolo_line(F.col("class_id"), F.col("poly"), F.col("tile_width"), F.col("tile_height"))
    rows = labels.withColumn("value", text).repartition("tile_key").sortWithinPartitions("tile_key", "line")
    rows.select("tile_key", "value").write.mode("overwrite").partitionBy("tile_key").text(path)


def write_json(path: str, value: object) -> None:
    """Sorted keys, indented; the file appears whole or not at all."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    held = target.with_suffix(target.suffix + ".tmp")
    held.write_text(json.dumps(value, indent=2, sort_keys=True, default=str) + "\n")
    os.replace(held, target)


def markdown_table(rows: list[dict], columns: list[str]) -> str:
    cell = lambda v: str("" if v is None else v).replace("|", "\\|")
    lines = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(r.get(c)) for c in columns) + " |" for r in rows]) + "\n"


def markdown_report(title: str, summary: dict, findings: DataFrame, columns: list[str], most: int = 100) -> str:
    """A report: the summary, and the first findings in the order given."""
    rows = [r.asDict() for r in findings.select(*columns).limit(most).collect()]
    facts = "\n".join(f"- {k}: {v}" for k, v in sorted(summary.items()))
    return f"# {title}\n\n{facts}\n\n## Findings\n\n{markdown_table(rows, columns)}"


def manifest(mode: str, args: dict, extra: dict | None = None, root: str = ".") -> dict:
    """What ran, when and from which revision."""
    revision = subprocess.run(["git", "-C", root, "rev-parse", "HEAD"], capture_output=True, text=True, check=False).stdout.strip() or None
    return {"schema_version": 1, "mode": mode, "created_at": datetime.now(UTC).isoformat(), "python": sys.version.split()[0], "revision": revision, "arguments": {k: str(v) for k, v in sorted(args.items())}, **(extra or {})}


def rejected_entries(entries: DataFrame, prefixes: tuple[str, ...], suffixes: tuple[str, ...]) -> DataFrame:
    """Entries (source, destination, text) of a copy list that a rule rejects, with the reason."""
    c = F.col
    secret = "|".join(f"(?:{x})" for x in p.SECRET_PATTERNS.values())
    reason = (
        F.when(c("source").startswith("/") | c("destination").startswith("/"), "absolute_path")
        .when(c("source").rlike(r"(^|/)\.\.(/|$)") | c("destination").rlike(r"(^|/)\.\.(/|$)"), "path_escape")
        .when(~F.coalesce(F.concat(F.lit("."), F.substring_index("source", ".", -1)).isin(*suffixes), F.lit(False)), "suffix")
        .when(~F.exists(F.array(*[F.lit(x) for x in prefixes]), lambda x: F.startswith(c("source"), x)), "prefix")
        .when(c("text").rlike(secret), "secret")
        .when(c("text").rlike("/home/"), "home_path")
    )
    return entries.withColumn("reason", reason).filter("reason IS NOT NULL").select("source", "destination", "reason")


def subset_manifest(rows: DataFrame, root: str, order: list[str]) -> DataFrame:
    """What a subset of a dataset (dataset, split, image_name) is made of: for each row its source image
    and label and the unique names that both get in the subset."""
    from ..operators.reports import unique_stems

    stem = p.stem(F.col("image_name"))
    named = unique_stems(rows.withColumns({"_stem": stem, "_order": F.struct(*order)}), "dataset", "_stem", "_order")
    suffix = F.regexp_extract("image_name", r"(\.[^.]*)$", 1)
    base = F.lit(root.rstrip("/"))
    return named.select(
        *rows.columns, F.concat_ws("/", base, F.lit("images"), "split", "image_name").alias("source_image"), F.concat_ws("/", base, F.lit("labels"), "split", F.concat("_stem", F.lit(".txt"))).alias("source_label"),
        F.concat("unique_stem", suffix).alias("subset_image"), F.concat("unique_stem", F.lit(".txt")).alias("subset_label"),
    )


def copy_files(spark, pairs: DataFrame, source: str, destination: str, dry_run: bool = True) -> int:
    """Copies files named by pairs (one narrow row each; made on executors, through any file system) into
    a folder, or with `dry_run` only counts them. A copy that was made before is made again, so lost
    tasks are harmless."""
    wanted = pairs.select(source, destination)
    if dry_run:
        return wanted.count()
    data = spark.read.format("binaryFile").load([r[0] for r in wanted.select(source).distinct().collect()]).select(F.col("path").alias("_from"), "content")
    listed = wanted.withColumn("_name", p.base_name(F.col(source)))
    both = listed.join(data.withColumn("_name", p.base_name(F.col("_from"))), "_name")

    def write(rows) -> None:
        for r in rows:
            target = Path(r[destination])
            target.parent.mkdir(parents=True, exist_ok=True)
            held = target.with_suffix(target.suffix + ".tmp")
            held.write_bytes(bytes(r["content"]))
            os.replace(held, target)

    both.foreachPartition(write)
    return wanted.count()


def write_yaml(path: str, value: dict) -> None:
    """A YAML mapping in the order of its keys; the file appears whole or not at all."""
    import yaml

    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    held = target.with_suffix(target.suffix + ".tmp")
    held.write_text(yaml.safe_dump(value, sort_keys=False))
    os.replace(held, target)


def write_lineage(path: str, stages: list[dict], notes: dict | None = None) -> None:
    """The stages of a dataset, in order, with what each was made from."""
    known: set[str] = set()
    for stage in stages:
        if missing := sorted(set(stage.get("inputs", [])) - known):
            raise ValueError(f"{stage['name']} is made from unknown stages: {', '.join(missing)}")
        known.add(stage["name"])
    write_json(path, {"schema_version": 1, "stages": stages, "notes": notes or {}})
