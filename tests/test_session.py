"""Sessions and stored tables."""

import os
import subprocess
import sys

from docloom.sources import store

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
from docloom.session import get_session
s = get_session("own", "local[1]", **{"spark.sql.ansi.enabled": "false", "spark.driver.host": "127.0.0.1"})
keys = ["spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.ansi.enabled"]
print("GOT", *[s.conf.get(k) for k in keys])
again = get_session("other", **{"spark.sql.shuffle.partitions": "5"})
print("AGAIN", *[again.conf.get(k) for k in keys])
"""


def test_outer_settings_win(tmp_path):
    (tmp_path / "spark-defaults.conf").write_text("spark.sql.shuffle.partitions 2000\nspark.sql.session.timeZone CET\n")
    out = subprocess.run([sys.executable, "-c", PROBE], cwd=ROOT, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=120).stdout
    assert "GOT 2000 CET true false" in out and "AGAIN 5 CET true false" in out


def test_stored_tables_are_removed(spark):
    df, path = store.stored(spark.sql("SELECT named_struct('a b', 1) AS `x y`, 2 AS n"))
    assert df.first()["x y"]["a b"] == 1 and os.path.isdir(path) and path.startswith(store.session_dir(spark))
    other, kept = store.stored(df)
    store.drop_stored(spark, path)
    assert not os.path.exists(path) and other.count() == 1
    store.clean(spark)
    assert not os.path.exists(kept)
