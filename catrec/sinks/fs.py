"""Driver-side file-system metadata operations through Hadoop's FileSystem,
so the same code works on local disk, HDFS and object stores.

Only listings, renames, deletes and small documents (manifests) go
through here; data is always written by Spark tasks.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

RENAMING_THREADS = 32


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Local file systems come wrapped (checksums, proxies) and hide and drag
    # along ``.crc`` side files; work on the raw one so listings show (and
    # cleanup removes) them.  Other schemes are used as configured.
    wrapper = jvm.java.lang.Class.forName("org.apache.hadoop.fs.FilterFileSystem")
    while wrapper.isInstance(filesystem) and filesystem.getUri().getScheme() == "file":
        filesystem = filesystem.getRawFileSystem()
    return filesystem, hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _filesystem(spark, path)
    return bool(fs.exists(hpath))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """``(name, length, is_file)`` of the direct children of ``path``."""
    fs, hpath = _filesystem(spark, path)
    return [(s.getPath().getName(), int(s.getLen()), bool(s.isFile())) for s in fs.listStatus(hpath)]


def rename(spark: SparkSession, directory: str, source: str, target: str) -> None:
    fs, hpath = _filesystem(spark, directory)
    jvm = spark.sparkContext._jvm
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(hpath, source), jvm.org.apache.hadoop.fs.Path(hpath, target)):
        raise OSError(f"could not rename {source} to {target} in {directory}")


def rename_all(spark: SparkSession, directory: str, targets: dict[str, str]) -> None:
    """Rename many files of a directory; the calls wait for the file system, so they run side by side."""
    with ThreadPoolExecutor(max_workers=RENAMING_THREADS) as pool:
        list(pool.map(lambda names: rename(spark, directory, *names), [x for x in targets.items() if x[0] != x[1]]))


def delete(spark: SparkSession, directory: str, name: str, recursive: bool = True) -> None:
    fs, hpath = _filesystem(spark, directory)
    fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath, name), recursive)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _filesystem(spark, path)
    fs.mkdirs(hpath)


def write_bytes(spark: SparkSession, path: str, data: bytes, overwrite: bool = False) -> None:
    fs, hpath = _filesystem(spark, path)
    stream = fs.create(hpath, overwrite)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def list_tree(spark: SparkSession, path: str) -> list[str]:
    """All files below ``path`` (or ``path`` itself when it is a file),
    skipping files whose own name starts with ``_`` or ``.``."""
    fs, hpath = _filesystem(spark, path)
    if not fs.exists(hpath):
        raise FileNotFoundError(path)
    status = fs.getFileStatus(hpath)
    if status.isFile():
        return [status.getPath().toString()]
    found = []
    iterator = fs.listFiles(hpath, True)
    while iterator.hasNext():
        item = iterator.next()
        full = item.getPath().toString()
        if full.rsplit("/", 1)[-1].startswith(("_", ".")):
            continue
        found.append(full)
    return sorted(found)
