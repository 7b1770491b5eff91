"""Scans (S1-S6) and column checks."""

from __future__ import annotations

import os
from collections.abc import Iterable

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

# The driver's table set.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json", "orc": "orc"}
_EXTENSIONS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".jsonl": "json", ".orc": "orc"}


def load_config(path: str) -> dict:
    """YAML job config, parsed on the driver."""
    with open(path, encoding="utf-8") as fh:
        cfg = yaml.safe_load(fh) or {}
    if not isinstance(cfg, dict):
        raise ValueError(f"config {path} is not a mapping")
    return cfg


def _resolve_format(path: str, file_type: str | None) -> str:
    if file_type:
        ft = file_type.lower()
        if ft in ("excel", "xlsx", "xls"):
            raise ValueError("excel input is not read on Spark; convert it to csv or parquet first")
        if ft not in _FORMATS:
            raise ValueError(f"Unsupported file type: {file_type}")
        return _FORMATS[ft]
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext in (".xlsx", ".xls"):
        raise ValueError("excel input is not read on Spark; convert it to csv or parquet first")
    return _EXTENSIONS.get(ext, "parquet")


def read_table(spark: SparkSession, path: str, file_type: str | None = None,
               columns: Iterable[str] | None = None, schema: StructType | str | None = None,
               base_dir: str | None = None, nan_as_null: bool = True) -> DataFrame:
    """Read a table; project ``columns`` so pruning reaches the scan.

    NaN in float columns is a missing value (null) unless ``nan_as_null`` is
    off. A relative path that is missing is retried under ``base_dir`` (S4); a
    missing file raises FileNotFoundError, an unknown type ValueError (S5).
    """
    fmt = _resolve_format(path, file_type)
    candidates = [path]
    if base_dir and not os.path.isabs(path) and "://" not in path:
        candidates.append(os.path.join(base_dir, path))
    last_error: Exception | None = None
    for candidate in candidates:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
            if schema is None:
                reader = reader.option("inferSchema", True)
        if schema is not None:
            reader = reader.schema(schema)
        try:
            df = reader.load(candidate)
            if columns is not None:
                df = df.select(*list(columns))
            return nan_to_null(df) if nan_as_null else df
        except AnalysisException as exc:  # path missing, or column missing
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
            last_error = exc
    raise FileNotFoundError(f"data file not found: {path}") from last_error


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> null in every float and double column (one projection; none without such columns)."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(float("nan")).cast(df.schema[c].dataType)) for c in floats}) if floats else df


def clean_name(name: str) -> str:
    """P7 for one name, as configs use it: stripped, spaces to underscores."""
    return str(name).strip().replace(" ", "_")


def load_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip names and turn spaces into underscores; collisions are an error."""
    new = [clean_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({c for c in new if new.count(c) > 1})
        raise ValueError(f"column names collide after cleaning: {dup}")
    return df.toDF(*new)


def required_feature_columns(data_cfg: dict) -> list[str]:
    """feature_columns, else columns_needed minus the target, else error."""
    target = clean_name(data_cfg.get("target_column") or "")
    if data_cfg.get("feature_columns"):
        cols = list(data_cfg["feature_columns"])
    elif data_cfg.get("columns_needed"):
        cols = [c for c in data_cfg["columns_needed"] if clean_name(c) != target]
    else:
        raise ValueError("config lists neither feature_columns nor columns_needed")
    return [clean_name(c) for c in cols]


def validate_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail with the missing names, else select in the fitted order."""
    required = list(required)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*required)
