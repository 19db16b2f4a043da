"""Session settings and the shared checkpoint folder."""

import tempfile

from pyspark.sql import SparkSession

# Fixed value: the offset (not a daylight-saving zone) in which trip clocks are read.
TRIP_ZONE = "-04"


def build_session(app: str = "wayfare", zone: str = TRIP_ZONE, **settings: str) -> SparkSession:
    """A session with the trip clock's zone; other settings are passed through unchanged.

    Executor sizes, shuffle partitions and the checkpoint folder belong to the cluster,
    so nothing else is fixed here except that AQE stays on and that checkpoints nobody
    refers to any more are removed.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without
    that setting (tests) gets a temporary folder: on a cluster a machine-local path would
    not be visible to the other executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="wayfare-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder
