"""Session for local runs, the bench and the tests, and for jobs that a cluster submits.

What the submit command or the configuration names always wins: only open
settings are filled in, and the local ones only where no master is named.
"""

from __future__ import annotations

import os
import re
import shlex
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

FLAGS = {"--master": "spark.master", "--name": "spark.app.name", "--driver-memory": "spark.driver.memory"}
ALWAYS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def submitted() -> dict[str, str]:
    """What the submit command, its environment and the defaults file have set."""
    if "PYSPARK_GATEWAY_PORT" in os.environ or SparkContext._gateway is not None:
        SparkContext._ensure_initialized()  # the JVM runs and knows all settings
        return dict(SparkConf().getAll())
    found: dict[str, str] = {}
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(home, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults) as lines:
            found |= dict(re.split(r"[\s=:]+", x.strip(), maxsplit=1) for x in lines if re.match(r"\s*spark\.\S+[\s=:]+\S", x))
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    for flag, value in zip(args, args[1:]):
        if flag in ("--conf", "-c"):
            found |= dict([value.split("=", 1)])
        elif flag in FLAGS:
            found[FLAGS[flag]] = value
    return found


def spark_session(app: str = "clipwell", cores: int | str | None = None) -> SparkSession:
    """The active session as it is, else a new one.

    Without a named master it is a local one: ``cores`` threads and shuffle
    partitions, and a checkpoint folder of its own below the temporary folder. A
    cluster job must name ``spark.checkpoint.dir``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    given, wanted = submitted(), dict(ALWAYS)
    if "spark.master" not in given:
        cores = str(cores or os.environ.get("BENCH_CPUS", "8"))
        wanted |= {
            "spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "12g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        }
        if "spark.checkpoint.dir" not in given:
            wanted["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="clipwell-")
    wanted["spark.app.name"] = app
    spark = SparkSession.builder.config(map={k: v for k, v in wanted.items() if k not in given}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
