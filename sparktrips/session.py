"""SparkSession construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole-stage codegen can emit methods above HotSpot's 8000-byte JIT
    # limit (wide projections, JSON decoding); without this flag such methods
    # stay in the bytecode interpreter. Pass the same on spark-submit.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str | None = None, app: str = "sparktrips",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, spark-submit supplies the
    master, the options and the shared ``spark.checkpoint.dir``; ``DEFAULT_CONF``
    only fills options that spark-submit left unset."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # under spark-submit its options are in the JVM
        SparkContext._ensure_initialized()
    submitted = SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not submitted.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Bytecode of a generated method up to which Spark runs a whole stage as one, unless the
#: session sets its own number: HotSpot leaves longer methods in the interpreter.
HUGE_METHODS = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def small_methods(spark: SparkSession) -> None:
    """For sessions made elsewhere, without the flag of ``DEFAULT_CONF``: stages whose code
    HotSpot would not compile run operator by operator, in methods that it does compile."""
    name, default, ours = HUGE_METHODS
    flags = spark.sparkContext.getConf().get("spark.executor.extraJavaOptions", "")
    if "-XX:-DontCompileHugeMethods" not in flags and spark.conf.get(name, default) == default:
        spark.conf.set(name, ours)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a ``local[...]`` master (tests) gets a fresh temporary
    folder, removed at exit; any other master is refused, since a folder on
    one machine is not seen by the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is unset on {master}: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sparktrips-checkpoints-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python
    workers can import it wherever they were started. Local workers find it by path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or sc.master.startswith("local"):
        return
    root = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="sparktrips-package-")  # the driver serves the archive from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{folder}/sparktrips", "zip", root.parent, root.name))
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sparktrips/{name}-{uuid.uuid4().hex[:12]}"
