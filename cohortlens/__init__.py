"""Labelled-table analytics on Spark.

Validation, redundancy profiling, stratified splits and folds, fit/apply
feature preparation, SMOTE oversampling, cross-validated scoring, cohort
error metrics and strategy-comparison reports, all expressed as DataFrame
plans keyed by an explicit ``row_id``.
"""

__version__ = "0.1.0"
