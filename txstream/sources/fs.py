"""Small file-system helpers that work on any Hadoop path (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one non-hidden file (recursively)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-directories of ``path`` (empty if it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def modification_ms(spark: SparkSession, path: str) -> int:
    fs, p = _fs_path(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty if it does not exist)."""
    fs, p = _fs_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small text file, visible under its name only when complete."""
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.tmp")
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(tmp, p):
        raise OSError(f"cannot name {path}")
