"""outcomelab: outcome analytics on Spark DataFrames.

Items (rows keyed by an id, with a date and entity keys) are joined with
boolean outcomes, split chronologically, turned into entity / price /
location / categorical features, ranked by mutual information, and used to
train and score MLlib classifiers.  Every operator is a function from
DataFrame to DataFrame; column names are arguments.

Sub-packages
------------
sources    reading tables, the test-table fixture mapping, result sinks
functions  Column-level helpers (smoothing, safe ratios, digamma, ...)
operators  relational building blocks (split, entity statistics, encoders,
           imputation, ordered running totals, mutual information, metrics)
plans      composite feature sets, dataset assembly, models, sweeps
streaming  (intentionally empty: the reference has no streaming operator)
"""

import sys as _sys

# Functions of this package that run inside Python workers (mapInPandas
# passes) are pickled by value, so executors need no copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from outcomelab.session import build_session, ensure_checkpoint_dir  # noqa: E402,F401

__all__ = ["build_session", "ensure_checkpoint_dir"]
