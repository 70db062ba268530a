"""candlewick: Spark-native feature engineering for daily equity bars and macro series.

One long table per entity (all symbols, all sectors, all macro series) replaces the
file-per-ticker / folder-per-sector layout; every operator is a DataFrame transform.
"""

import sys as _sys

try:  # ship this package's grouped-map functions by value, so Python workers need no install
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files instead
    pass

from candlewick.session import checkpoint_dir, get_spark  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
