"""lapse: churn datasets, training and evaluation as Spark DataFrame jobs.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is
lazy: nothing runs until the caller triggers an action.  The few steps that
need a bounded scalar from the data (scaler statistics, class share) say so
in their docstring.
"""

from lapse.conf import Settings, Windows, resolve, EXPERIMENTS  # noqa: F401

__version__ = "0.1.0"
