"""Session construction and shared scratch space.

Jobs never use a machine-local folder on a cluster: intermediate tables and checkpoints
go below the shared folder named by ``spark.checkpoint.dir``.  Only on a local master without
that setting (local runs, tests) do we create one of our own.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job on any cluster size wants; everything size-dependent stays adaptive.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # binary columns (archive entries, images) cross into Python in batches of bounded bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # collect_set per image: keep up to 64k keys in the hash map per task (each holds one
    # small set of category names) before the spill-safe sort-based fallback
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # streaming state (dedup ids) lives in RocksDB on local disk, not on the executor heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry", extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # small data on one box: AQE targets 8 MiB partitions, so a rebalance before a
        # write and coalesced shuffles still spread over the cores
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(8 << 20))
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="quarry-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  A folder of our own is made only on a
    local master, where all tasks share the machine's disk; anywhere else it must be set."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
    elif re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/quarry-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value):
    """The session's setting ``key`` while the block runs; a query planned or a stream started in it keeps the value."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def listing_by_the_core(spark: SparkSession):
    """While it holds, a list of many paths is looked up by some tasks per core.  Spark's own choice is a task per path,
    up to 10,000, and each sends the driver more about itself than about its file."""
    return setting(spark, _LISTING_TASKS, 8 * spark.sparkContext.defaultParallelism)


def listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that always lists by the core: a stream's source lists files for as long
    as the stream runs, under the session it was made in."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(_LISTING_TASKS, str(8 * spark.sparkContext.defaultParallelism))
    return own


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme, as Spark resolves it: Python code on the executors then opens the same
    place (a path without scheme would be the executor's own disk there)."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hp).toString()


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Size-dependent settings for a cluster run: shuffle partitions of about
    ``target_partition_bytes`` if the whole input were shuffled (at least 3 per core, at
    most 100,000: past that the map x reduce block count dominates, and every shuffle here
    is combined map-side, so it is far smaller than the input); AQE coalesces small ones
    and splits skewed ones.  File splits of the same size.  Example: 100 TB on 8,000
    cores -> 100,000 shuffle partitions, 256 MiB splits (~400,000 scan tasks)."""
    parts = min(max(3 * total_cores, -(-input_bytes // target_partition_bytes)), 100_000)
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
    }


_SHIPPED: set[str] = set()


def _write_shared(path: str, data: bytes) -> None:
    if path.startswith("file:") or "://" not in path:
        local = path[len("file:") :] if path.startswith("file:") else path
        while local.startswith("//"):
            local = local[1:]
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as fh:
            fh.write(data)
        return
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as fh:
        fh.write(data)


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile``), once per
    application.  The zip is written below the shared checkpoint folder, so executors on
    other machines fetch it the same way as locally."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    info = zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(pkg)), (2024, 1, 1, 0, 0, 0))
                    with open(full, "rb") as src:
                        zf.writestr(info, src.read())
    data = buf.getvalue()
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarry-code/quarry-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    _write_shared(path, data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
