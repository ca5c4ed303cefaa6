"""Small file-system questions, asked through the Hadoop API so they work on any storage."""


def _path(spark, name):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark, name):
    path, fs = _path(spark, name)
    return fs.exists(path)


def children(spark, name):
    """Names of the entries of a folder, none when it does not exist."""
    path, fs = _path(spark, name)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def delete(spark, name):
    path, fs = _path(spark, name)
    fs.delete(path, True)


def committed(spark, parent, prefix):
    """Numbers of the folders ``<prefix><n>`` whose write job finished, in ascending order."""
    numbers = [int(n[len(prefix):]) for n in children(spark, parent) if n.startswith(prefix)]
    return sorted(n for n in numbers if exists(spark, f"{parent}/{prefix}{n}/_SUCCESS"))


def size(spark, name):
    """Bytes of a folder and all below it."""
    path, fs = _path(spark, name)
    return fs.getContentSummary(path).getLength()


def date_files(spark, name, millis):
    """Give the files of a folder one time of modification (milliseconds since 1970)."""
    path, fs = _path(spark, name)
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), millis, -1)


def read_text(spark, name):
    path, fs = _path(spark, name)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark, name, text):
    """A small file that appears as a whole, by a rename."""
    path, fs = _path(spark, name)
    hidden, _ = _path(spark, f"{name.rsplit('/', 1)[0]}/.{name.rsplit('/', 1)[1]}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(path, False)
    if not fs.rename(hidden, path):
        raise OSError(f"cannot name {name}")
