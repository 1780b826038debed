"""candlewright: a Spark-native tick-to-bar market-data engine.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
built-in Spark SQL expressions, usable with ``df.transform(...)``.
"""

from candlewright.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
