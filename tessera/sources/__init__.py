from .readers import (TABLES, clean_column_names, load_config, load_tables, read_table,
                      required_feature_columns, validate_columns)
from .sinks import RunLog, load_model, model_family, save_model, write_table

__all__ = [
    "TABLES", "clean_column_names", "load_config", "load_tables", "read_table",
    "required_feature_columns", "validate_columns", "RunLog", "load_model",
    "model_family", "save_model", "write_table",
]
