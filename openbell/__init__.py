"""openbell: point-in-time market, news and calendar features on Spark.

Every public function takes DataFrames and returns a DataFrame; nothing runs
until the caller writes or counts. Tables are keyed by ``symbol`` and ``date``.
"""

from openbell.session import recommended_conf, shared_dir

__all__ = ["recommended_conf", "shared_dir"]
