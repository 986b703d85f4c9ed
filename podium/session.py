"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "podium", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the models rely on; ``conf`` overrides any of them.

    Broadcasts are left to Spark: no model carries a broadcast hint, so a side is only sent to
    every executor when its planned or measured size is under ``autoBroadcastJoinThreshold``,
    and the join falls back to a shuffled one (split by AQE when skewed) beyond it.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even when the rows have to be shuffled again afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # A generated method above 8000 bytes is never compiled by the JVM; the wide projections
        # here are several times faster in smaller, compiled pieces.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Models of fifty columns are put together call by call; recording the Python line of each
        # call would double the time a plan takes to build.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar keys are defined in UTC, whatever the zone of the session handed to us."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every node must reach.

    Only a local session may leave the setting empty; it gets a temporary folder instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster has nodes of its own
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all nodes")
        root = _LOCAL_SCRATCH.get(context.applicationId)
        if root is None:
            root = _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="podium-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
