"""Sources and sinks: tables, reports, fitted models, proxy views."""

from cohortlens.sources.tables import (
    load_table,
    save_table,
    rewrite_versioned,
    optional_table,
    roundtrip_csv,
)
from cohortlens.sources.reports import json_report, write_json_report
from cohortlens.sources.models_io import save_model, load_model

__all__ = [
    "load_table",
    "save_table",
    "rewrite_versioned",
    "optional_table",
    "roundtrip_csv",
    "json_report",
    "write_json_report",
    "save_model",
    "load_model",
]
