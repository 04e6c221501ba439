"""String and cell parsing as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..policy import CONFIDENCE_EDGES, IMAGE_SUFFIXES


def normalize_whitespace(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def parse_int(value: Column, default: int = 0) -> Column:
    """Text to int by way of a number, towards zero; `default` if it isn't one."""
    number = value.try_cast("double")
    return F.coalesce(F.when(F.abs(number) < 2.0**31, number.try_cast("int")), F.lit(default))


def parse_int_list(value: Column) -> Column:
    """"[1, 2, x]" to [1, 2]: the parts that are digits only."""
    parts = F.transform(F.split(F.regexp_replace(value, r"[\[\]]", ""), ","), lambda p: F.trim(p))
    return F.transform(F.filter(parts, lambda p: p.rlike("^[0-9]+$")), lambda p: p.cast("int"))


def parse_flag(value: Column) -> Column:
    return F.lower(F.trim(value)).isin("true", "1", "yes")


def first_text(*values: Column) -> Column:
    """The first value that isn't null or blank: the fallback chains of optional cells."""
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def is_image(path: Column) -> Column:
    return F.lower(F.substring_index(path, ".", -1)).isin(*IMAGE_SUFFIXES) & path.contains(".")


def source_group_key(name: Column) -> Column:
    """Image stem without its tile suffix: _rowN_colM first, then _N_N."""
    base = stem(name)
    found = [F.nullif(F.regexp_extract(base, p, 1), F.lit("")) for p in (r"^(.+?)_row\d+_col\d+$", r"^(.+?)_\d+_\d+$")]
    return F.coalesce(*found, base)


def grid_origin(name: Column) -> Column:
    """Struct parent, x, y from parent_X_Y; null if the name has no such form."""
    part = lambda k: F.regexp_extract(stem(name), r"^(.+?)_(\d+)_(\d+)$", k)
    return F.when(part(1) != "", F.struct(part(1).alias("parent"), part(2).try_cast("long").alias("x"), part(3).try_cast("long").alias("y")))


def row_col_origin(name: Column, stride: int = 824) -> Column:
    """Struct parent, x, y from parent_rowR_colC, rows and columns being `stride` apart."""
    part = lambda k: F.regexp_extract(stem(name), r"^(.+?)_row(\d+)_col(\d+)$", k)
    return F.when(part(1) != "", F.struct(part(1).alias("parent"), (part(3).try_cast("long") * stride).alias("x"), (part(2).try_cast("long") * stride).alias("y")))


def parent_of_group(key: Column) -> Column:
    return F.substring_index(key, ":", -1)


def recovery_name(dataset: Column, parent: Column, x: Column, y: Column) -> Column:
    return F.format_string("%s__%s_%04d_%04d_recovery_audit_v1.png", dataset, stem(parent), x.cast("long"), y.cast("long"))


def confidence_bucket(value: Column) -> Column:
    """Half-open buckets by the fixed edges."""
    text = [f"{e:.3f}".rstrip("0") for e in CONFIDENCE_EDGES]
    text = [t if len(t.split(".")[1]) > 1 else t + "0" for t in text]
    out = F.when(value < CONFIDENCE_EDGES[0], f"<{text[0]}")
    for low, high, a, b in zip(CONFIDENCE_EDGES, CONFIDENCE_EDGES[1:], text, text[1:], strict=False):
        out = out.when((value >= low) & (value < high), f"{a}-{b}")
    return out.otherwise(f">={text[-1]}")


def normalized_class(name: Column) -> Column:
    return F.when(name == "Dock", "non_vessel").otherwise(name)


def points_from_text(value: Column) -> Column:
    """ "x,y;x,y" to points."""
    number = lambda p, k: F.get(F.split(p, ","), F.lit(k)).try_cast("double")
    return F.transform(F.split(value, ";"), lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y")))


def points_to_text(poly: Column, digits: int = 2) -> Column:
    return F.array_join(F.transform(poly, lambda p: F.format_string(f"%.{digits}f,%.{digits}f", p["x"], p["y"])), ";")


def yolo_line(class_id: Column, poly: Column, width: Column, height: Column) -> Column:
    """A label line: class and eight coordinates over the tile's size, to six decimals."""
    cells = F.flatten(F.transform(poly, lambda p: F.array(F.format_string("%.6f", p["x"] / width), F.format_string("%.6f", p["y"] / height))))
    return F.when((width > 0) & (height > 0) & (F.size(poly) >= 3), F.concat_ws(" ", class_id.cast("string"), F.array_join(cells, " ")))


def yolo_fields(line: Column) -> Column:
    return F.filter(F.split(F.trim(line), r"\s+"), lambda t: t != "")


def parse_yolo(line: Column, width: Column, height: Column) -> Column:
    """Struct class_id, points (tile pixels) and errors of a label line.

    wrong_field_count and non_numeric end the checks; of the others each that applies is listed:
    invalid_class_id, non_finite, normalized_out_of_bounds, non_distinct_corners,
    self_intersection_or_invalid_polygon, zero_area.
    """
    from .geometry import area, let, point, polygon_is_valid

    def checked(f: Column) -> Column:
        numbers = F.transform(f, lambda t: t.try_cast("double"))

        def judged(v: Column) -> Column:
            get = lambda k: F.get(v, F.lit(k))
            poly = F.array(*[point(get(k) * width, get(k + 1) * height) for k in (1, 3, 5, 7)])
            cells = F.slice(v, 2, 8)
            finite = F.forall(cells, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
            inside = F.forall(cells, lambda x: (x >= -1e-6) & (x <= 1 + 1e-6))

            def listed(p: Column) -> Column:
                distinct = F.size(F.array_distinct(p)) == 4
                found = [(get(0) != 0, "invalid_class_id"), (~finite, "non_finite"), (~inside, "normalized_out_of_bounds"), (~distinct, "non_distinct_corners"), (finite & ~polygon_is_valid(p, 0.0), "self_intersection_or_invalid_polygon"), (finite & (area(p) <= 1e-6), "zero_area")]
                errors = F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in found]), lambda e: e.isNotNull())
                return F.struct(get(0).cast("int").alias("class_id"), p.alias("points"), errors.alias("errors"))

            return let(poly, listed)

        failed = lambda name: F.struct(F.lit(None).cast("int").alias("class_id"), F.lit(None).cast("array<struct<x:double,y:double>>").alias("points"), F.array(F.lit(name)).alias("errors"))
        return F.when(F.size(f) != 9, failed("wrong_field_count")).when(F.exists(numbers, lambda x: x.isNull()), failed("non_numeric")).otherwise(let(numbers, judged))

    return let(yolo_fields(line), checked)


#: What a secret looks like in a line of text.
SECRET_PATTERNS = {
    "huggingface_token": r"\bhf_[A-Za-z0-9]{24,}\b",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{20,}\b",
    "generic_secret_assignment": r"(?i)\b(?:token|secret|api[_-]?key|password)\b\s*[:=]\s*(?:['\"][^'\"]{8,}['\"]|[A-Za-z0-9_-]{20,})",
}
#: Categories of a path by its first folder, in the order in which they are tried.
PATH_CATEGORIES = (
    (("data", "datasets"), "private_dataset_or_annotation"),
    (("models", "outputs"), "private_model_or_generated_output"),
    (("reports",), "historical_or_local_report"),
    (("release",), "release_metadata_or_local_artifact"),
    (("scripts", "configs", "tests", "docs"), "code_or_public_documentation_candidate"),
)


def path_category(path: Column, deployment: tuple[str, ...], categories=PATH_CATEGORIES) -> Column:
    """The category of the path's first folder; `deployment` names the folders of what is deployed."""
    first = F.when(path.contains("/"), F.substring_index(path, "/", 1))
    out = F.when(first.isin(*deployment), "deployment_candidate") if deployment else F.when(F.lit(False), "")
    for folders, name in categories:
        out = out.when(first.isin(*folders), name)
    return out.otherwise("requires_manual_classification")


def secret_findings(lines):
    """Rows (source, line, kind) of the lines of a table (source, line, text) that hold a secret or a
    local absolute path; the value itself is never returned."""
    kinds = {**SECRET_PATTERNS, "absolute_local_path": r"/home/|[A-Za-z]:\\\\Users\\"}
    found = F.filter(F.array(*[F.when(F.col("text").rlike(p), F.lit(k)) for k, p in kinds.items()]), lambda k: k.isNotNull())
    return lines.select("source", "line", F.explode(found).alias("kind"))


def json_list(value: Column) -> Column:
    """A JSON list of texts held in a cell; an empty list if it is null or no list."""
    return F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))


def class_map(config: dict) -> dict[int, str]:
    """Class names by id: of id2label, else of label2id turned round."""
    if config.get("id2label"):
        return {int(k): str(v) for k, v in config["id2label"].items()}
    return {int(v): str(k) for k, v in (config.get("label2id") or {}).items()}


def resolve_class_ids(wanted: list[str], names: dict[int, str]) -> list[int]:
    """Ids of classes given by id or by name in any case; an unknown one is an error."""
    by_name = {v.casefold(): k for k, v in names.items()}
    out = []
    for w in map(str, wanted):
        found = int(w) if w.isdigit() and int(w) in names else by_name.get(w.casefold())
        if found is None:
            raise ValueError(f"unknown class: {w}")
        out.append(found)
    return sorted(set(out))


def class_label(class_id: Column, names: dict[int, str]) -> Column:
    """The name of an id, or the id as text."""
    if not names:
        return class_id.cast("string")
    table = F.create_map(*[F.lit(x) for k, v in sorted(names.items()) for x in (k, v)])
    return F.coalesce(F.try_element_at(table, class_id.cast("int")), class_id.cast("string"))


def frame_time(frame: Column, fps: Column) -> Column:
    """Seconds into a video, to six decimals; null without a positive rate."""
    return F.when(fps > 0, F.floor(frame / fps * 1e6 + 0.5) / 1e6)
