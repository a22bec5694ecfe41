"""odoflow: Spark-native analytics for odometer-style counter readings.

Weekly reading files are ingested (batch or incremental), de-duplicated and
relabelled, differenced per series, cleaned of anomalies, rolled up to
station x day x 4-hour bucket and queried as filtered cohort comparisons.
Every step is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; there are no Python UDFs.
"""

from odoflow.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
__version__ = "0.1.0"
