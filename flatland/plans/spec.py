"""Mapping spec: the table that drives landing types, stage casts, keys and publish.

A spec is an ordinary DataFrame with one row per column per layer plus one
"Create Table" row per layer. It is small (columns, not data), so building
plans from it collects it to the driver; building the spec itself from a
profile is a Spark job over the profile rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland.functions.casts import spark_type
from flatland.functions.names import landing_name, landing_name_col, stage_name_col
from flatland.operators.land import LandingField
from flatland.operators.stage import ColumnMap

# The spec's columns, in order, as the loader names them after
# cleaning the sheet headers; plus our explicit layer and position.
SPEC_HEADERS = ["Action", "Schema", "Target Table", "Target Field", "Comment", "Type",
                "Char Encoding", "PK", "FK", "Source System", "Source Table", "Source Field(s)"]
SPEC_COLUMNS = [landing_name(h) for h in SPEC_HEADERS] + ["layer", "position"]
SPEC_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c == "position" else T.StringType())
                            for c in SPEC_COLUMNS])

# Texts the spec builder writes.
FLAT_FILE = "Flat File"
DB_INTERNAL = "DB Internal"
SYSTEM_GENERATED = "System Generated"
AUTO_COMMENT = "Automatically added by the application"
NULL_COLUMN_COMMENT = "All records are NULL value, fix data type"
LAYERS = ["wrk", "stg", "tgt"]
#: How the comment of a landing row names the layout of a date column.
LAYOUT_COMMENT = "date layout: "


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """Read a spec CSV and normalise its headers."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = raw.toDF(*[landing_name(c) for c in raw.columns])
    for c in SPEC_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(*[F.col(c).cast("int" if c == "position" else "string") for c in SPEC_COLUMNS])


def write_spec(spec: DataFrame, path: str) -> None:
    """Write the spec as one CSV with the sheet's own headers (K9)."""
    out = spec.orderBy(F.expr("array_position(array('wrk','stg','tgt'), layer)"), "position")
    renamed = out.select(*[F.col(landing_name(h)).alias(h) for h in SPEC_HEADERS], "layer", "position")
    (renamed.coalesce(1).write.mode("overwrite").option("header", True)
     .option("escape", '"').csv(path))


def flat_file_rows(spec: DataFrame) -> DataFrame:
    return spec.filter(F.col("source_system") == FLAT_FILE)


def spec_layers(spec: DataFrame) -> DataFrame:
    """Distinct (layer, schema, table) in spec order."""
    return (spec.filter(F.col("target_table").isNotNull())
            .groupBy("layer", "schema", "target_table")
            .agg(F.min("position").alias("first_position"))
            .orderBy(F.expr("array_position(array('wrk','stg','tgt'), layer)"), "first_position"))


def build_spec(spark: SparkSession, inferred: DataFrame, names: dict[str, str]) -> DataFrame:
    """Three-layer spec from inferred column types.

    ``inferred`` has ``column_name`` (file header), ``position``,
    ``landing_type`` and ``db_type``. ``names`` gives wrk/stg/tgt schema and
    table names: keys ``wrk_schema, wrk_table, stg_schema, stg_table,
    tgt_schema, tgt_table``.
    """
    for k in ("wrk_schema", "wrk_table", "stg_schema", "stg_table", "tgt_schema", "tgt_table"):
        if not names.get(k):
            raise ValueError(f"setting {k} is required before profiling")  # V12
    n = inferred.agg(F.max("position")).first()[0] or 0
    lit = F.lit

    def header(layer):
        row = {c: None for c in SPEC_COLUMNS}
        row.update(action="Create Table", schema=names[f"{layer}_schema"],
                   target_table=names[f"{layer}_table"], layer=layer, position=0)
        return row

    def audit(layer, pos, field, typ, comment, system, table, source):
        row = {c: None for c in SPEC_COLUMNS}
        row.update(action="Add Field", schema=names[f"{layer}_schema"], target_table=names[f"{layer}_table"],
                   target_field=field, comment=comment, type=typ, source_system=system,
                   source_table=table, source_fields=source, layer=layer, position=pos)
        return row

    fixed = [
        header("wrk"),
        audit("wrk", n + 1, "load_file_name", "string", AUTO_COMMENT, FLAT_FILE, SYSTEM_GENERATED, "load_file_name"),
        audit("wrk", n + 2, "load_timestamp", "timestamp", AUTO_COMMENT, FLAT_FILE, SYSTEM_GENERATED, "load_timestamp"),
        header("stg"),
        audit("stg", n + 1, "load_file_name", "varchar(255)", "", DB_INTERNAL, names["wrk_table"], "load_file_name"),
        audit("stg", n + 2, "load_timestamp", "timestamp(0)", "", DB_INTERNAL, names["wrk_table"], "load_timestamp"),
        header("tgt"),
        audit("tgt", n + 1, "modify_date_time", "timestamp(0)", None, SYSTEM_GENERATED, SYSTEM_GENERATED,
              SYSTEM_GENERATED),
        audit("tgt", n + 2, "load_file_name", "varchar(255)", None, DB_INTERNAL, names["stg_table"], "load_file_name"),
        audit("tgt", n + 3, "load_timestamp", "timestamp(0)", None, DB_INTERNAL, names["stg_table"], "load_timestamp"),
    ]
    fixed_df = spark.createDataFrame([tuple(r[c] for c in SPEC_COLUMNS) for r in fixed], SPEC_SCHEMA)

    src = F.col("column_name")
    wrk_field = landing_name_col(src)
    stg_field = stage_name_col(src)
    common = dict(action=lit("Add Field"), char_encoding=lit(None).cast("string"), pk=lit(None).cast("string"),
                  fk=lit(None).cast("string"), position=F.col("position").cast("int"))

    def layer_rows(layer, field, comment, typ, system, table, source):
        cols = dict(common)
        cols.update(schema=lit(names[f"{layer}_schema"]), target_table=lit(names[f"{layer}_table"]),
                    target_field=field, comment=comment, type=typ, source_system=lit(system),
                    source_table=lit(table), source_fields=source, layer=lit(layer))
        return inferred.select(*[cols[c].cast("int" if c == "position" else "string").alias(c) for c in SPEC_COLUMNS])

    layout = F.concat(lit(LAYOUT_COMMENT), F.col("date_layout")) if "date_layout" in inferred.columns else lit(None)
    wrk = layer_rows("wrk", wrk_field, layout, F.col("landing_type"), FLAT_FILE, FLAT_FILE, src)
    stg = layer_rows("stg", stg_field,
                     F.when(F.col("db_type") == "varchar(?)", lit(NULL_COLUMN_COMMENT)),
                     F.col("db_type"), DB_INTERNAL, names["wrk_table"], wrk_field)
    tgt = layer_rows("tgt", stg_field, lit(None), F.col("db_type"), DB_INTERNAL, names["stg_table"], stg_field)
    return fixed_df.unionByName(wrk).unionByName(stg).unionByName(tgt)


@dataclass
class SpecPlan:
    """Everything the load needs, derived from a spec alone."""

    landing: list[LandingField]
    stage: list[ColumnMap]
    target: list[ColumnMap]
    keys: list[str]
    stage_schema: T.StructType
    target_schema: T.StructType
    tables: dict[str, str]


def _layer_rows(rows, layer):
    return sorted([r for r in rows if r["layer"] == layer and r["target_field"]], key=lambda r: r["position"])


def plan_from_spec(spec: DataFrame) -> SpecPlan:
    """Collect the (small) spec and derive the load plan from it.

    Keys are the target rows with PK set, named by their stage source field,
    in spec order (I10); a stage-only spec is allowed (no target mapping).
    """
    rows = [r.asDict() for r in spec.collect()]
    wrk, stg, tgt = (_layer_rows(rows, l) for l in LAYERS)
    # Numbers that the stage holds as integers or decimals land with all their digits.
    exact = {landing_name(r["source_fields"]) for r in stg
             if isinstance(spark_type(r["type"]), (T.IntegralType, T.DecimalType))}
    landing = []
    for r in wrk:
        if r["source_system"] == FLAT_FILE:
            name, kind = landing_name(r["source_fields"]), (r["type"] or "string").strip()
            note = r["comment"] or ""
            layout = note[len(LAYOUT_COMMENT):] if kind in ("date", "timestamp") and note.startswith(LAYOUT_COMMENT) else None
            landing.append(LandingField(name, "number" if kind == "float64" and name in exact else kind, layout))
    stage = [ColumnMap(landing_name(r["source_fields"]), r["target_field"], r["type"]) for r in stg]
    target = [ColumnMap(r["source_fields"], r["target_field"], r["type"]) for r in tgt
              if r["source_system"] != SYSTEM_GENERATED]
    keys = [r["source_fields"] for r in tgt if r["pk"] not in (None, "", "nan")]
    pk_targets = {r["target_field"] for r in tgt if r["pk"] not in (None, "", "nan")}
    stg_keys = set(keys)

    def schema(layer_rows, key_names):
        return T.StructType([T.StructField(r["target_field"], spark_type(r["type"]), r["target_field"] not in key_names)
                             for r in layer_rows if r["type"]])

    tables = {r["layer"]: f"{r['schema']}.{r['target_table']}" for r in rows if r["action"] == "Create Table"}
    return SpecPlan(landing, stage, target, keys, schema(stg, stg_keys), schema(tgt, pk_targets), tables)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types and refuse nulls in NOT NULL (key) columns."""
    out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        any_null = F.lit(False)
        for c in required:
            any_null = any_null | F.col(f"`{c}`").isNull()
        out = out.filter(F.when(any_null, F.raise_error(F.lit("null in a key column"))).isNull())
    return out
