"""tabforge: tabular data preparation and ensemble regression on Spark DataFrames.

Sub-packages
------------
sources    scans and sinks (parquet, CSV with ``NA`` markers, prediction files)
functions  Column-expression helpers (pandas-compatible null semantics, Box-Cox, rounding)
operators  DataFrame -> DataFrame operators and fitted transformers
models     Gram-statistics linear models, boosted trees, stacking, blending
plans      column-role registry, the end-to-end pipelines and the registered queries
streaming  applying fitted transformers to streaming DataFrames
"""

__version__ = "0.1.0"
