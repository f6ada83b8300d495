"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for results (not for speed): ANSI stays on, the
# session zone is UTC so text and date parts of timestamps are stable.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that matter for speed at scale.  AQE re-plans joins and
# coalesces or splits shuffle partitions at run time; skew join splits
# oversized partitions of a hot key.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tributary", extra: dict | None = None) -> SparkSession:
    """Return a session with the result and scale settings applied.

    On a cluster ``master`` is left to spark-submit; in tests pass
    ``local[N]``.  The UI stays off: no server is opened.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**RESULT_CONF, **SCALE_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and staged tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a
    shared folder there).  When it is unset, a local master gets a fresh
    local folder; on a cluster that is an error, since executors do not
    share local disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tributary-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship_package(spark: SparkSession) -> bool:
    """Make sure that the workers can import this package: where they can't (the
    program started from another folder, the package isn't installed) it is sent
    to them, through the shared folder.  Asked once a session; returns whether
    it was sent."""
    sc, name = spark.sparkContext, __package__
    if getattr(sc, "_tributary_ready", None) is not None:
        return sc._tributary_ready
    known = sc.parallelize([name], 1).map(lambda n: __import__("importlib.util").util.find_spec(n) is not None).first()
    if not known:
        root, made = os.path.dirname(os.path.abspath(__file__)), io.BytesIO()
        with zipfile.ZipFile(made, "w") as z:
            for folder, _, files in sorted(os.walk(root)):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.join(name, os.path.relpath(full, root)))
        path = f"{checkpoint_dir(spark).rstrip('/')}/code/{uuid.uuid4().hex}/{name}.zip"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(made.getvalue()))
        out.close()
        sc.addPyFile(path)
    sc._tributary_ready = not known
    return not known


def cut_lineage(df, how: str = "table"):
    """Materialise ``df`` in the shared checkpoint folder and return a frame
    reading it back.  ``table`` writes parquet (columnar, fast; the read
    back has no partitioning), ``checkpoint`` uses a reliable RDD checkpoint
    (keeps the partitioning, so a following join on the same keys does not
    shuffle again)."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
