"""cellscape: single-cell expression analytics as Spark DataFrame operators.

A count matrix is kept as three DataFrames (see :class:`cellscape.matrix.CountMatrix`):
``cells`` (one row per cell), ``genes`` (one row per gene) and ``expr`` (one row per
non-zero entry).  Every operator is a function over DataFrames that can be chained
with ``DataFrame.transform``; no operator pulls cell-sized data to the driver.
"""

import sys as _sys

# Functions of this package used inside pandas UDFs are shipped to the Python workers by
# value, so executors do not need the package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from cellscape.matrix import CountMatrix  # noqa: E402

__all__ = ["CountMatrix"]
