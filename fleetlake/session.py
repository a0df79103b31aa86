"""Session settings and the shared folder for data a job writes for itself."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_folders = {}

# Rough cost of one row in a broadcast table besides its text.
ROW_OVERHEAD = 64

# Tasks for each core that list folders.
LISTING_TASKS = 8

# Bytes that are read in about the time that it takes to open a file.
OPEN_COST = 64 * 1024


def build_session(app_name, zone="Asia/Seoul", master=None, **conf):
    """A session with the settings these jobs rely on; ``conf`` uses ``__`` for dots.

    The session zone decides how zone-less send times are read. Stored times are
    written as microseconds because the older 96-bit form carries no column
    statistics, so a recency filter could not skip any row group.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": zone,
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def object_store_conf(access_key, secret_key, endpoint):
    """Settings that let any path of this library be an ``s3a://`` address."""
    return {
        "spark__hadoop__fs__s3a__access__key": access_key,
        "spark__hadoop__fs__s3a__secret__key": secret_key,
        "spark__hadoop__fs__s3a__endpoint": endpoint,
    }


def scratch(spark, purpose):
    """A new, not yet existing folder that every executor can reach.

    It lies below the folder named in ``spark.checkpoint.dir`` and goes when the application
    ends. Only a local-mode session may go without that setting; it gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            base = tempfile.mkdtemp(prefix="fleetlake-")
        _folders[app] = f"{base}/fleetlake/{app}"
        files, folder = _files(spark, _folders[app])
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{_folders[app]}/{purpose}-{uuid.uuid4().hex}"


def _files(spark, path):
    """The Hadoop file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def local_path(spark, path):
    """The path as programs of a machine name it, or None if it lies on no mounted file system."""
    files, folder = _files(spark, path)
    place = files.makeQualified(folder).toUri()
    return place.getPath() if place.getScheme() == "file" else None


@contextmanager
def _at_most(spark, name, value):
    """Meanwhile a session setting is no larger than ``value``."""
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before.rstrip("b")), value) if before.rstrip("b").isdigit() else value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_listing_tasks(spark):
    """Meanwhile very many folders are listed by a few tasks for each core, not by one task for each folder."""
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    return _at_most(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def packed_files(spark):
    """Meanwhile a job's tasks take many small files each: a task of a shuffle has a cost for every task that follows."""
    return _at_most(spark, "spark.sql.files.openCostInBytes", OPEN_COST)


def drop_scratch(spark, path):
    """Remove a folder that ``scratch`` named."""
    files, folder = _files(spark, path)
    files.delete(folder, True)


def claim(spark, path):
    """Create the empty file ``path``; False if it is there already. Only one of several callers gets True."""
    files, place = _files(spark, path)
    try:
        files.create(place, False).close()
    except Exception:
        if files.exists(place):
            return False
        raise
    return True


def put_new(spark, path, text):
    """Write ``text`` to a new file; False if the file is there already."""
    files, place = _files(spark, path)
    try:
        stream = files.create(place, False)
    except Exception:
        if files.exists(place):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark, path):
    """The text of a small file."""
    files, place = _files(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark, path):
    """Whether a file or folder is there."""
    files, place = _files(spark, path)
    return files.exists(place)


def list_folder(spark, path):
    """Names of the entries of a folder."""
    files, folder = _files(spark, path)
    return [item.getPath().getName() for item in files.listStatus(folder)]


def move(spark, path, target):
    """Give a file a new name that no other file has."""
    files, place = _files(spark, path)
    if not files.rename(place, _files(spark, target)[1]):
        raise OSError(f"{path} could not be moved to {target}")


def file_sizes(spark, path):
    """Bytes of each file of a folder, by name."""
    files, folder = _files(spark, path)
    return {item.getPath().getName(): item.getLen() for item in files.listStatus(folder) if item.isFile()}


def broadcast_limit(spark):
    """Largest side, in bytes, that this library broadcasts after measuring it."""
    return max(0, spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
