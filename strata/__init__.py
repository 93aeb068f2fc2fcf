"""strata: a Spark-native medallion engine.

Landed pages and dated JSON Lines partitions go in; typed bronze records,
latest-version silver tables, dimensions with stable surrogate keys and
exploded fact tables come out. Every transformation is a DataFrame
function; I/O lives in ``strata.sources``.
"""

from strata.session import get_session, workspace_path

__all__ = ["get_session", "workspace_path"]
