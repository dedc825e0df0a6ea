"""auditlens: database audit-log analytics on Spark.

Raw PostgreSQL log rows (a table or a stream) are parsed, tied to their
session, rolled into windowed metric tables and scanned by security
detectors, a seasonal baseline model, dashboards and alert rules. Every
operator is a DataFrame -> DataFrame function planned by Catalyst.
"""

from auditlens.config import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
