"""Readers of annotation files: each gives a DataFrame with a declared schema."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..policy import MARITIME_TYPES

BOX = "struct<_label:string,_xtl:string,_ytl:string,_xbr:string,_ybr:string,_rotation:string>"
CVAT = f"_name string, _width string, _height string, box array<{BOX}>, polygon array<struct<_label:string,_points:string>>, mask array<struct<_label:string>>"
INSTANCES = "instance_id string, parent_group_key string, parent_image_filename string, obb_cxcywhr array<double>, obb_vertices_xy array<array<double>>, image_width int, image_height int, obb_source string, coordinate_system string"


def require_columns(df: DataFrame, names: set[str]) -> DataFrame:
    if missing := sorted(names - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_table(spark: SparkSession, path: str, required: set[str] = frozenset()) -> DataFrame:
    """A CSV table as text cells, quoted line feeds included."""
    return require_columns(spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False).csv(path), set(required))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the last in order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_n = 1").drop("_n")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, name and size of every file below a folder, empty ones too (which Spark's readers pass over)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, rows = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True), []
    while found.hasNext():
        f = found.next()
        rows.append((f.getPath().toString(), f.getPath().getName(), f.getLen()))
    return spark.createDataFrame(rows, "path string, name string, size long")


def read_cvat(spark: SparkSession, path: str, labels: tuple[str, ...] = ("ship",)) -> DataFrame:
    """Named images with their boxes: name, width, height, boxes. Labels are compared with white space
    collapsed (none given: all); missing numbers are 0, boxes with other text for a number go."""
    raw = spark.read.format("xml").option("rowTag", "image").schema(CVAT).load(path)
    number = lambda b, k: F.coalesce(b[k], F.lit("0")).try_cast("double")

    def box(b: Column) -> Column:
        return F.struct(p.normalize_whitespace(F.coalesce(b["_label"], F.lit(""))).alias("label"), *[number(b, f"_{k}").alias(k) for k in ("xtl", "ytl", "xbr", "ybr", "rotation")])

    boxes = F.transform(F.coalesce("box", F.array().cast(f"array<{BOX}>")), box)
    good = lambda b: b["xtl"].isNotNull() & b["ytl"].isNotNull() & b["xbr"].isNotNull() & b["ybr"].isNotNull() & b["rotation"].isNotNull() & (b["label"].isin(*labels) if labels else F.lit(True))
    named = raw.filter(F.coalesce("_name", F.lit("")) != "")
    return named.select(F.col("_name").alias("name"), p.parse_int(F.col("_width")).alias("width"), p.parse_int(F.col("_height")).alias("height"), F.filter(boxes, good).alias("boxes"))


def count_cvat_shapes(spark: SparkSession, path: str) -> DataFrame:
    """images and shapes (boxes, polygons and masks) of a file."""
    raw = spark.read.format("xml").option("rowTag", "image").schema(CVAT).load(path)
    shapes = sum((F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) for c in ("box", "polygon", "mask")), F.lit(0))
    return raw.agg(F.count("*").alias("images"), F.coalesce(F.sum(shapes), F.lit(0)).alias("shapes"))


def count_objects(spark: SparkSession, path: str) -> DataFrame:
    """file, objects: <object> elements at any depth of each XML file, files without any too. What
    stands in comments and CDATA is no element."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.regexp_replace("value", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "").alias("value"))
    counts = files.select("file", F.size(F.regexp_extract_all("value", F.lit(r"<object[\s/>]"), F.lit(0))).cast("long").alias("objects"))
    return list_files(spark, path).select(F.col("name").alias("file")).join(counts, "file", "left").fillna(0, ["objects"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), text. Files are read whole, so that lines can be numbered."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    lines = raw.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("at", "text"))
    return lines.select("file", (F.col("at") + 1).cast("long").alias("line"), "text").filter(F.trim("text") != "")


def read_yolo(spark: SparkSession, path: str, tiles: DataFrame) -> DataFrame:
    """Labels of tiles (label_file, tile_key, tile_width, tile_height): tile_key, line, class_id, poly,
    errors, text."""
    lines = read_lines(spark, path).join(tiles, F.col("file") == F.col("label_file"))
    parsed = lines.withColumn("v", p.parse_yolo(F.col("text"), F.col("tile_width"), F.col("tile_height")))
    return parsed.select("tile_key", "line", "v.class_id", F.col("v.points").alias("poly"), "v.errors", "text")


def read_dota(spark: SparkSession, path: str, label: str = "ship") -> DataFrame:
    """file, line, poly, difficulty of rows of eight numbers and the label; other rows go."""
    lines = read_lines(spark, path).withColumn("f", F.split(F.trim("text"), r"\s+")).filter(F.size("f") >= 9)
    at = lambda k: F.get("f", F.lit(k)).try_cast("double")
    rows = lines.filter(F.get("f", F.lit(8)) == label)
    poly = F.array(*[F.struct(at(k).alias("x"), at(k + 1).alias("y")) for k in (0, 2, 4, 6)])
    rows = rows.withColumn("poly", poly).filter(F.forall("poly", lambda q: q["x"].isNotNull() & q["y"].isNotNull()))
    return rows.select("file", "line", "poly", F.get("f", F.lit(9)).alias("difficulty"))


def count_dota(spark: SparkSession, path: str, names: DataFrame | None = None, label: str = "ship") -> DataFrame:
    """file, objects of each label file, those without any too. With `names` (file) only those, and
    missing tells which of them aren't there."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    fields = F.transform(F.split("value", r"\r?\n"), lambda x: F.split(F.trim(x), r"\s+"))
    counts = raw.select("file", F.size(F.filter(fields, lambda f: (F.size(f) >= 9) & (F.get(f, F.lit(8)) == label))).cast("long").alias("objects"))
    there = list_files(spark, path).select(F.col("name").alias("file"), F.lit(False).alias("missing")).join(counts, "file", "left")
    if names is None:
        return there.drop("missing").fillna(0, ["objects"])
    return names.select("file").distinct().join(there, "file", "left").select("file", "objects", F.coalesce("missing", F.lit(True)).alias("missing")).fillna(0, ["objects"])


def count_geojson(spark: SparkSession, path: str, types: tuple[int, ...] = MARITIME_TYPES) -> DataFrame:
    """image, objects: features of wanted types of each image, whatever their bounds."""
    schema = "features array<struct<properties:struct<type_id:string,image_id:string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features.properties").alias("p")).select("p.*")
    image = p.base_name(F.col("image_id"))
    return rows.filter(F.col("type_id").try_cast("int").isin(*types) & (image != "")).groupBy(image.alias("image")).agg(F.count("*").alias("objects"))


def read_removed(spark: SparkSession, path: str, tiles: DataFrame) -> DataFrame:
    """Labels that a filter removed (CSV with image_name and label_line) of known tiles (tile_key,
    tile_width, tile_height): tile_key, line (0), poly. Lines with errors go; an absent file is empty."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "tile_key string, line long, poly array<struct<x:double,y:double>>")
    rows = read_table(spark, path, {"image_name", "label_line"}).select(F.col("image_name").alias("tile_key"), "label_line")
    parsed = rows.join(tiles, "tile_key").withColumn("v", p.parse_yolo(F.col("label_line"), F.col("tile_width"), F.col("tile_height")))
    return parsed.filter(F.size("v.errors") == 0).select("tile_key", F.lit(0).cast("long").alias("line"), F.col("v.points").alias("poly"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Training logs (folder of a run / results.csv): run, epoch, map50, map95, time. Heads may be padded;
    cells that are no numbers are null and rows without an epoch go."""
    raw = spark.read.options(header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, inferSchema=False).csv(path)
    found = {c.strip(): c for c in raw.columns}
    require_columns(raw.toDF(*[c.strip() for c in raw.columns]), {"epoch", "metrics/mAP50(B)", "metrics/mAP50-95(B)", "time"})
    number = lambda c: F.col(f"`{found[c]}`").try_cast("double")
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = raw.select(run.alias("run"), number("epoch").cast("long").alias("epoch"), number("metrics/mAP50(B)").alias("map50"), number("metrics/mAP50-95(B)").alias("map95"), number("time").alias("time"))
    return rows.filter("epoch IS NOT NULL")


def read_yaml(path: str, frozen: dict | None = None) -> dict:
    """A YAML mapping; other documents are an error, and so are settings that differ from `frozen` ones."""
    import yaml

    with open(path) as f:
        value = yaml.safe_load(f)
    if not isinstance(value, dict):
        raise ValueError(f"{path} holds no mapping")
    if changed := sorted(k for k, v in (frozen or {}).items() if value.get(k) != v):
        raise ValueError(f"{path} changes {', '.join(changed)}")
    return value


def require_single_class(config: dict, name: str = "ship") -> dict:
    """A dataset's configuration, if it has the one class."""
    names = config.get("names")
    names = list(names.values()) if isinstance(names, dict) else names
    if names != [name] or config.get("nc", 1) != 1:
        raise ValueError(f"expected the one class {name}, found {names}")
    return config


def settings(environment: dict[str, str], ranges: dict[str, tuple[type, object, float, float]]) -> dict:
    """Values of an environment by name (kind, default, least, most); one that is no number or out of
    its range is an error that names it."""
    out = {}
    for name, (kind, default, least, most) in ranges.items():
        try:
            value = kind(environment.get(name, default))
        except ValueError as e:
            raise ValueError(f"{name} must be a {kind.__name__}") from e
        if not least <= value <= most:
            raise ValueError(f"{name} must lie between {least} and {most}")
        out[name] = value
    return out


def upload_problems(files: DataFrame, most_bytes: int, most_pixels: int = 24_000_000) -> DataFrame:
    """Files (path, size, width, height) with the first rule that refuses them: too_large, not_an_image
    (no size in the header) or too_many_pixels; null if none does."""
    reason = F.when(F.col("size") > most_bytes, "too_large").when(F.col("width").isNull() | F.col("height").isNull(), "not_an_image").when(F.col("width").cast("long") * F.col("height") > most_pixels, "too_many_pixels")
    return files.withColumn("problem", reason)


def inventory(files: DataFrame, root: str, skip: tuple[str, ...] = (".git",), relevant: tuple[str, ...] = (), large_bytes: int = 10 << 20) -> DataFrame:
    """Files (path, size) below `root` without those in folders to skip: path (from the root), name, size,
    is_large, and is_relevant (the first folder is one of `relevant`)."""
    base = root.rstrip("/") + "/"
    rest = F.substring_index("path", base, -1)
    folders = F.slice(F.split(rest, "/"), F.lit(1), F.size(F.split(rest, "/")) - 1)
    held = files.select(rest.alias("path"), F.element_at(F.split(rest, "/"), -1).alias("name"), "size", folders.alias("_folders")).filter(~F.arrays_overlap("_folders", F.array(*[F.lit(x) for x in skip])))
    first = F.get("_folders", F.lit(0))
    return held.select("path", "name", "size", (F.col("size") >= large_bytes).alias("is_large"), F.coalesce(first.isin(*relevant) if relevant else F.lit(False), F.lit(False)).alias("is_relevant"))


def absolute_references(lines: DataFrame, word: str) -> DataFrame:
    """file, line, value: absolute paths in lines (file, line, text) that name the word, in any case."""
    pattern = rf"(?i)(?:[A-Za-z]:\\|/)[^\s\"']*{word}[^\s\"']*"
    return lines.select("file", "line", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("value"))


def read_geojson(spark: SparkSession, path: str, types: tuple[int, ...] = MARITIME_TYPES) -> DataFrame:
    """image, type_id, x0, y0, x1, y1 of the features of wanted types with four bounds."""
    schema = "features array<struct<properties:struct<type_id:string,image_id:string,bounds_imcoords:string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features.properties").alias("p")).select("p.*")
    b = F.split("bounds_imcoords", ",")
    numbers = {n: F.get(b, F.lit(k)).try_cast("double") for k, n in enumerate(("x0", "y0", "x1", "y1"))}
    rows = rows.withColumn("_n", F.size(b)).withColumns(numbers).withColumn("type_id", F.col("type_id").try_cast("int"))
    whole = F.lit(True)
    for n in numbers:
        whole &= F.col(n).isNotNull()
    return rows.filter(F.col("type_id").isin(*types) & (F.col("_n") == 4) & whole).select(F.col("image_id").alias("image"), "type_id", *numbers)


def read_instances(spark: SparkSession, path: str, dataset: str | None = None, split: str | None = None) -> DataFrame:
    """Parent boxes: instance_id, group_key, dataset, split, parent_id, poly, width, height. The split
    only selects among dota's; records without four corners or of no size go."""
    raw = spark.read.schema(INSTANCES).json(path)
    parts = F.split("parent_group_key", ":", 3)
    rows = raw.select("instance_id", F.col("parent_group_key").alias("group_key"), F.get(parts, F.lit(0)).alias("dataset"), F.get(parts, F.lit(1)).alias("split"), F.get(parts, F.lit(2)).alias("parent_id"), F.transform("obb_vertices_xy", lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))).alias("poly"), F.col("image_width").alias("width"), F.col("image_height").alias("height"), F.col("obb_cxcywhr").alias("box"), "coordinate_system")
    rows = rows.filter((F.size("poly") == 4) & (F.get("box", F.lit(2)) > 0) & (F.get("box", F.lit(3)) > 0))
    if dataset:
        rows = rows.filter(F.col("dataset") == dataset)
    if split:
        rows = rows.filter((F.col("dataset") != "dota") | (F.col("split") == split))
    return rows.drop("box")


def read_roi(spark: SparkSession, path: str) -> DataFrame:
    """image, grids (sorted distinct ids 1 to 9, also from digit texts). The file is a list of records or
    one record; commas before a closing bracket are forgiven; images without ids go."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r",(\s*[\]}])", "$1").alias("v"))
    record = "struct<image:string,grids:array<string>>"
    listed = F.from_json(F.when(F.ltrim("v").startswith("["), F.col("v")).otherwise(F.concat(F.lit("["), F.col("v"), F.lit("]"))), f"array<{record}>")
    rows = text.select(F.explode(listed).alias("r")).select("r.*")
    ids = F.filter(F.transform("grids", lambda x: F.when(x.rlike("^[0-9]+$"), x.try_cast("int"))), lambda x: x.between(1, 9))
    return rows.select("image", F.array_sort(F.array_distinct(ids)).alias("grids")).filter(F.size("grids") > 0)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (instance_id, tile_key) of a suppression ledger: a list, or entries in an object."""
    text = spark.read.text(path, wholetext=True)
    entry = "array<struct<parent_annotation_id:string,suppressed_tile:string>>"
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", entry)).otherwise(F.from_json("value", f"struct<entries:{entry}>")["entries"])
    return text.select(F.explode(listed).alias("e")).select(F.col("e.parent_annotation_id").alias("instance_id"), F.col("e.suppressed_tile").alias("tile_key")).distinct()


def read_recovery_metadata(spark: SparkSession, path: str) -> DataFrame:
    """image_name, covered (ids, also from a list held as text), recovery_reason."""
    rows = spark.read.schema("image_name string, covered_instance_ids string, recovery_reason string").json(path)
    return rows.select("image_name", F.coalesce(F.from_json("covered_instance_ids", "array<string>"), F.array().cast("array<string>")).alias("covered"), "recovery_reason")


def read_qa_tags(spark: SparkSession, path: str) -> DataFrame:
    """parent, qa_tag: the last known tag of each parent (small, low or bad)."""
    rows = read_table(spark, path, {"parent_image_id", "qa_tag"}).withColumn("seq", F.monotonically_increasing_id())
    tagged = rows.withColumn("qa_tag", F.lower(F.trim("qa_tag"))).filter(F.col("qa_tag").isin("small", "low", "bad"))
    return last_wins(tagged, "parent_image_id", "seq").select(F.col("parent_image_id").alias("parent"), "qa_tag")


def read_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """path, name, size of every file below a folder, and its content if asked for (then without empty
    files)."""
    if not content:
        return list_files(spark, path)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return raw.select("path", p.base_name(F.col("path")).alias("name"), F.col("length").alias("size"), "content")


def image_sizes(files: DataFrame) -> DataFrame:
    """path, width, height of PNG and JPEG files, from the header bytes; null if there are none."""
    @F.pandas_udf("struct<width:int,height:int>")
    def size(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_header(bytes(c)) for c in contents], columns=["width", "height"]).astype("Int32")

    return files.select("path", size("content").alias("s")).select("path", "s.width", "s.height")


def _header(data: bytes) -> tuple[int | None, int | None]:
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind = data[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None, None
