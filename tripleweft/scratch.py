"""Where intermediate tables go: the shared folder the session names."""

import tempfile
import uuid
from contextlib import contextmanager

SETTING = "spark.checkpoint.dir"

#: With it, Spark deletes the shuffle files of a query when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs = {}
# Lists that take down the folders of tables written now.
_noting = []


def base_dir(spark):
    """The session's shared folder; a fresh temporary one only for a local master."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tripleweft-")
    return _local_dirs[app]


def new_path(spark, label):
    """A path below the shared folder that no other run uses."""
    return f"{base_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark):
    """Shuffle files of queries that end meanwhile go with them; for writes, which nothing is read from but their table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def write_and_read(df, label):
    """Cut lineage: write `df` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    for made in _noting:
        made.append(path)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark, path):
    """Delete a folder below the shared folder that nothing will read again."""
    inside = base_dir(spark)
    if not path.startswith(inside + "/"):
        raise ValueError(f"{path} is not below {inside}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def untracked():
    """Note the folders of tables written meanwhile for the caller alone, who deletes them."""
    outer, made = list(_noting), []
    _noting[:] = [made]
    try:
        yield made
    finally:
        _noting[:] = outer


def note(paths):
    """Note folders for all who take them down, as if they were written now."""
    for made in _noting:
        made += paths


class Steps:
    """Tables of a loop that each follow from the one before, which goes once the next is written."""

    def __init__(self, label):
        self._label, self._path = label, None

    def write(self, df):
        spark = df.sparkSession
        with untracked() as made:
            out = write_and_read(df, self._label)
        self.drop(spark)
        [self._path] = made
        for noted in _noting:
            noted.append(self._path)
        return out

    def drop(self, spark):
        """Delete the last table too."""
        if self._path:
            drop_path(spark, self._path)
        self._path = None


def result_alone(spark, make, label):
    """The rows that `make()` returns, written to the shared folder; all tables that it wrote on the way are deleted."""
    with untracked() as made:
        out = write_and_read(make(), label)
    for path in made[:-1]:
        drop_path(spark, path)
    for noted in _noting:
        noted.append(made[-1])
    return out


class BatchScratch:
    """Folders that the micro-batches of a stream make: those of a batch go once a later one begins, when it is committed."""

    def __init__(self):
        self._made, self._batch = [], None

    def begin(self, spark, batch_id):
        """Call at the start of a batch: folders of earlier batches are deleted, further ones noted."""
        if batch_id != self._batch:
            for path in self._made:
                drop_path(spark, path)
            self._made, self._batch = [], batch_id
        _noting.append(self._made)

    def end(self):
        """Call at the end of a batch."""
        _noting.pop()
