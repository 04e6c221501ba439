"""Annotation views over the star-schema tables: geometry derived by integer arithmetic.

The same texts make the views in Spark and, as common table expressions, in the checking engine;
only integer division is spelled differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_VIEWS = {
    "parents": """
        SELECT s_suppkey AS s, CASE s_suppkey % 3 WHEN 0 THEN 'dota' WHEN 1 THEN 'xview' ELSE 'hrsc' END AS dataset,
               CASE WHEN s_suppkey % 4 = 3 THEN 'val' ELSE 'train' END AS split,
               CAST(1024 + 512 * (s_suppkey % 5) AS INT) AS width, CAST(1024 + 512 * ({div:s_suppkey,5} % 4) AS INT) AS height,
               'P' || lpad(CAST(s_suppkey AS STRING), 4, '0') AS parent_id,
               CASE s_nationkey % 5 WHEN 0 THEN 'small' WHEN 1 THEN 'low' WHEN 2 THEN 'bad' ELSE 'unflagged' END AS qa_tag,
               CAST(1 + (s_suppkey * 37) % 511 AS INT) AS grid_mask,
               CASE s_suppkey % 3 WHEN 0 THEN 'dota' WHEN 1 THEN 'xview' ELSE 'hrsc' END || ':' || CASE WHEN s_suppkey % 4 = 3 THEN 'val' ELSE 'train' END || ':P' || lpad(CAST(s_suppkey AS STRING), 4, '0') AS group_key
        FROM supplier""",
    "obbs": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING) AS instance_id,
               p.group_key, p.s, p.dataset, p.split, p.width AS parent_width, p.height AS parent_height, l_orderkey AS o, l_linenumber AS n, l_partkey AS p,
               (l_partkey * 37 + l_linenumber * 131) % p.width + CAST(0.37 AS DOUBLE) AS cx, (l_orderkey * 53 + l_partkey * 17) % p.height + CAST(0.61 AS DOUBLE) AS cy,
               CAST(8 AS DOUBLE) + 2 * l_quantity AS w, CAST(4 AS DOUBLE) + l_quantity / 2 AS h, CAST((l_partkey * 7 + l_orderkey) % 180 AS DOUBLE) AS rot
        FROM lineitem JOIN parents p ON p.s = l_suppkey""",
    "boxes": """
        SELECT l_suppkey AS s, l_returnflag AS cls, l_extendedprice / 110000 AS conf,
               CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST((l_orderkey * 7) % 500 AS DOUBLE) AS y0,
               l_partkey % 500 + 10 + l_quantity AS x1, (l_orderkey * 7) % 500 + 10 + l_quantity AS y1,
               l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS k
        FROM lineitem""",
    "frames": """
        SELECT CAST(floor((epoch_us(ts) - 1704067200000000) / 600000000.0) AS BIGINT) AS frame, event_id, event_type AS cls, value / 500 AS conf,
               CAST(user_id AS BIGINT) AS user_id, CAST(user_id * 37 % 1800 AS DOUBLE) + event_id % 7 AS cx, CAST(user_id * 53 % 1000 AS DOUBLE) + event_id % 5 AS cy
        FROM events""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")


def _spelled(text: str, spark: bool) -> str:
    import re

    text = re.sub(r"\{div:(\w+),(\w+)\}", r"(\1 div \2)" if spark else r"(\1 // \2)", text)
    return text.replace("epoch_us(ts)", "unix_micros(CAST(ts AS TIMESTAMP))") if spark else text.replace("AS STRING", "AS VARCHAR")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views, over the tables in a folder."""
    tables = {}
    for table in TABLES:
        if table in _VIEWS[name].split():
            tables[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if "parents" in _VIEWS[name].split():
        tables["parents"] = view(spark, sf_dir, "parents")
    import re

    text = _spelled(_VIEWS[name], True)
    for table in tables:
        text = re.sub(rf"(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    return spark.sql(text, **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ctes(*names: str) -> str:
    """The views as common table expressions of the checking engine, parents first."""
    wanted = [n for n in _VIEWS if n in names or n == "parents" and "obbs" in names]
    return ",\n".join(f"{n} AS ({_spelled(_VIEWS[n], False)})" for n in wanted)
