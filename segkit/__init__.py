"""segkit — customer segmentation on Spark DataFrames.

Subpackages: ``sources`` (tables, CSV/parquet, fixtures, artefacts), ``functions``
(hash draws, scalar expressions), ``operators`` (quality, slicing, joins, dedup,
imputation, analytics, features, k-means, Ward, validation, model choice),
``plans`` (cleaning, the end-to-end run, report, dashboard, query catalogue) and
``streaming`` (scoring of arriving records).
"""

__version__ = "0.1.0"
