"""The folder every executor can reach, and tables written there to cut lineage."""

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Spark's own switch: shuffle files go when the query that wrote them ends, not when the driver next collects garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_base: dict[str, str] = {}
_dropping: dict[tuple[str, int], int] = {}
_set_before: dict[tuple[str, int], str | None] = {}
_dropping_lock = threading.Lock()
_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_base:
        _local_base[app] = "file:" + tempfile.mkdtemp(prefix="starmill-")
    return _local_base[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing exists there yet."""
    path = f"{shared_dir(spark)}/starmill/{label}-{uuid.uuid4().hex}"
    if (scope := _open_scope.get()) is not None:
        scope.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables written inside the block when it ends.

    For blocks whose results are stored elsewhere; a table that is still to be
    read afterwards must be written outside.
    """
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        files = Files(spark)
        for path in paths:
            files.remove(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result once and go on from the written table.

    Lost executors cannot undo it, later readers pick only the columns they
    need, and the optimizer knows its real size when it chooses joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries inside the block drop their shuffle files as soon as they end.

    For queries that run once, such as the write of a table: whoever reads it
    goes on from the files, so nothing asks for the shuffle again. A query counts
    as inside if its DataFrame is made there, or written. Loads that run
    side by side share the setting; it is as it was once the last of them is through.
    """
    # A stream's batches have sessions of their own.
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    with _dropping_lock:
        _dropping[key] = _dropping.get(key, 0) + 1
        if _dropping[key] == 1:
            _set_before[key] = spark.conf.get(FILE_CLEANUP, None)
            spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            _dropping[key] -= 1
            if not _dropping[key]:
                del _dropping[key]
                before = _set_before.pop(key)
                spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A result written once; the intermediate tables that ``make`` writes go when it is."""
    path = scratch_path(spark, label)
    with temporary_tables(spark):
        df = make()
        with shuffles_dropped(spark):
            df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


class Files:
    """The few file-system calls Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def is_dir(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def remove(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        """Names of the entries of a folder, sorted; a missing folder has none."""
        fs, p = self._open(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p))

    def read_text(self, path: str) -> str:
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder."""
        fs, p = self._open(path)
        return fs.getContentSummary(p).getLength()

    def first_file(self, path: str) -> str:
        """The path itself, or the first data file if it is a folder."""
        if not self.is_dir(path):
            return path
        return next(f"{path}/{n}" for n in self.names(path) if n[0] not in "._")

    def lines(self, path: str) -> Iterator[str]:
        """Lines of a text file, a character for each byte; closed when the reader stops."""
        fs, p = self._open(path)
        reader = self._jvm.java.io.BufferedReader(
            self._jvm.java.io.InputStreamReader(fs.open(p), "ISO-8859-1")
        )
        try:
            while (line := reader.readLine()) is not None:
                yield line
        finally:
            reader.close()

    def first_char(self, path: str) -> str:
        """First character of a text file that is not white space."""
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            while (byte := stream.read()) >= 0:
                char = chr(byte)
                if not char.isspace() and byte not in (0xEF, 0xBB, 0xBF):
                    return char
        finally:
            stream.close()
        return ""

    def create_once(self, path: str, text: str) -> None:
        """Write a small file under a name nobody has taken; raise if it is taken."""
        fs, p = self._open(path)
        _, temp = self._open(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(temp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self._name_once(fs, temp, p)
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error):
                raise
            raise FileExistsError(path) from error
        finally:
            fs.delete(temp, False)

    def _name_once(self, fs, temp, p) -> None:
        """Give a file its final name, in one step that fails if the name is taken."""
        if fs.getUri().getScheme() == "file":
            nio = self._jvm.java.nio.file
            at = [nio.Paths.get(self._jvm.java.io.File(x.toUri().getPath()).toURI()) for x in (p, temp)]
            nio.Files.createLink(*at)
            return
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf)
        context.rename(temp, p, options)
