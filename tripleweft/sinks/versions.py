"""Results that are replaced in one step: a folder for each version, and a file that names the one in force."""

import uuid

_CURRENT = "_current"


def _files(spark, path):
    """The file context of a path: its rename replaces a file in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)


def _published(spark, path):
    """Names of the version in force and of those before it that are kept."""
    jvm, system, _ = _files(spark, path)
    named = jvm.org.apache.hadoop.fs.Path(f"{path}/{_CURRENT}")
    if not system.exists(named):
        return []
    stream = system.open(named)
    try:
        return stream.readUTF().split("\n")
    finally:
        stream.close()


def current_version(spark, path):
    """The folder that readers use now; None before the first version is published."""
    names = _published(spark, path)
    return f"{path}/{names[0]}" if names else None


def publish(spark, path, write, keep=1):
    """Call `write(folder)` for a new version and put it in force; the folder.

    Readers see the old version whole until the new one is complete, also if `write` fails midway. `keep` versions before
    the new one stay for readers that have begun; older ones, and what failed writes left, are deleted. One writer at a time.
    """
    jvm, system, context = _files(spark, path)

    def place(name):
        return jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")

    name = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    names = [name, *_published(spark, path)[:keep]]
    noted = place(f".{_CURRENT}-{uuid.uuid4().hex}")
    stream = system.create(noted)
    stream.writeUTF("\n".join(names))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(noted, place(_CURRENT), options)
    for status in system.listStatus(place("")):
        if status.isDirectory() and status.getPath().getName() not in names:
            system.delete(status.getPath(), True)
    return f"{path}/{name}"


def read_published(spark, path, fmt="parquet", **options):
    """The version in force; an error before the first."""
    folder = current_version(spark, path)
    if folder is None:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.format(fmt).options(**options).load(folder)
