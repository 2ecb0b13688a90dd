"""SparkSession set-up and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcasts are decided only from measured sizes: the static estimate (a
# Parquet file's compressed size) is not a bound on the table in memory, so
# it is switched off; AQE converts a join to a broadcast once the shuffled
# side has been measured below this size. Literal lookups carry a hint.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}

# Settings every job relies on: UTC event time, AQE, RocksDB state.
DEFAULT_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "eventide",
                  shuffle_partitions: int | None = None, input_bytes: int | None = None,
                  conf: dict | None = None,
                  catalogs: dict | None = None,
                  packages: list[str] | None = None,
                  hive: bool = False) -> SparkSession:
    """Return a session with the library defaults.

    ``catalogs`` maps a catalog name to (implementation class, options) so that
    three-part names ``cat.db.table`` resolve (external JDBC or lake catalogs).
    ``packages`` lands in ``spark.jars.packages`` (connector jars).
    ``input_bytes`` (the size of the data a job reads) sizes the initial
    shuffle partitions when ``shuffle_partitions`` is not given.
    """
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, (impl, opts) in (catalogs or {}).items():
        b = b.config(f"spark.sql.catalog.{name}", impl)
        for k, v in (opts or {}).items():
            b = b.config(f"spark.sql.catalog.{name}.{k}", v)
    if packages:
        b = b.config("spark.jars.packages", ",".join(packages))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    if hive:
        b = b.enableHiveSupport()
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20,
                           min_partitions: int = 8) -> int:
    """Initial shuffle partition count for an input size: about
    ``target_bytes`` of input per partition (AQE then coalesces small ones
    and splits skewed ones). 100 TB -> ~400k partitions."""
    return max(min_partitions, -(-int(input_bytes) // int(target_bytes)))


SCRATCH_KEY = "eventide.scratch.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (an HDFS / object-store path that
    all executors see). Only when it is unset (tests, local runs) do we pick a
    scratch folder, on a local master only (a cluster without the setting is
    an error); ``spark.checkpoint.dir`` cannot be changed on a running
    session, so the choice is kept under the library's own key so that
    later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not d:
        # ``local[...]`` runs one machine; ``local-cluster[...]`` does not count
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.conf.set(SCRATCH_KEY, d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return d


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    path = "/".join([base, "eventide", *parts, uuid.uuid4().hex])
    _SCRATCH.setdefault(spark.conf.get("spark.app.id", ""), []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application has named so far and return how
    many were there. Results are lazy: call it only when every DataFrame that stands on them
    has been written or read. Folders of other applications are left alone."""
    gone = 0
    for path in _SCRATCH.pop(spark.conf.get("spark.app.id", ""), []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
    return gone


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can use the path."""
    return path[5:] if path.startswith("file:") else path


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings the operators rely on in a session built
    elsewhere (UTC event time, broadcasts from measured sizes only)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing the plan) and lets a table used several times be computed
    once. Never a machine-local folder on a cluster."""
    path = scratch_path(df.sparkSession, "tables", name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hint_if_small(table, max_bytes: int = 32 << 20):
    """Hint a broadcast of a written table of fixed-width columns if its rows, counted
    from the file footers and taken at 16 bytes and 8 more a column, stay within ``max_bytes``;
    otherwise the shuffled join is left to Spark, which can split a hot key of a plain table."""
    from pyspark.sql import functions as F
    return F.broadcast(table) if table.count() * (16 + 8 * len(table.columns)) <= max_bytes else table


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable in the Python workers.

    Only the stateful stream operators run library Python code in tasks. If
    the workers cannot import the package (it was not installed on the
    cluster or passed with ``--py-files``), it is zipped once and handed to
    ``SparkContext.addPyFile``, which sends it to every executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship with the client's artifacts instead
        return
    if sc.applicationId in _SHIPPED:
        return

    def probe(_):
        import importlib.util
        yield importlib.util.find_spec("eventide") is not None

    if all(sc.parallelize([0], 1).mapPartitions(probe).collect()):
        _SHIPPED.add(sc.applicationId)
        return
    import shutil

    import eventide
    root = os.path.dirname(os.path.dirname(os.path.abspath(eventide.__file__)))
    base = checkpoint_dir(spark)
    local = base[5:] if base.startswith("file:") else base
    if "://" in local:  # a cluster file system: build the zip on the driver
        local = tempfile.mkdtemp(prefix="eventide-pkg-")
    out = os.path.join(local, "eventide-pkg", uuid.uuid4().hex)
    os.makedirs(out, exist_ok=True)
    zip_path = shutil.make_archive(os.path.join(out, "eventide"), "zip", root_dir=root,
                                   base_dir="eventide")
    sc.addPyFile(zip_path)
    _SHIPPED.add(sc.applicationId)


def register_source(spark: SparkSession, source: type) -> None:
    """Register a data source of this package. Its code is sent by value: the process
    that plans its batches on the driver's side does not see files added with ``addPyFile``."""
    from pyspark import cloudpickle

    import eventide
    cloudpickle.register_pickle_by_value(eventide)
    try:
        spark.dataSource.register(source)
    finally:
        cloudpickle.unregister_pickle_by_value(eventide)
