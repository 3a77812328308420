"""Session factory with the settings the engine is designed for."""

from __future__ import annotations

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: What is set where neither the caller, nor spark-submit, nor spark-defaults.conf says anything. The number of shuffle
#: partitions is the cluster's affair: adaptive execution coalesces them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. `conf` is the caller's own wish; of the defaults those count that nothing outside sets.

    A session that runs already keeps its settings but for `conf`.
    """
    builder = SparkSession.builder
    given = conf | ({"spark.master": master} if master else {})
    if SparkSession.getActiveSession() is None:
        wished = SparkConf(loadDefaults=False).setAll(list(given.items()))
        SparkContext._ensure_initialized(conf=wished)  # only then are the settings from outside known
        outer = SparkConf()
        builder = builder.appName(outer.get("spark.app.name", app) if outer.contains("spark.app.name") and outer.get("spark.app.name") != "pyspark-shell" else app)
        given = {k: v for k, v in DEFAULTS.items() if not outer.contains(k)} | given
    return builder.config(map=given).getOrCreate()
