"""Folders of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def delete_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder with all it holds; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory())


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all; it replaces one of the same name."""
    names = spark._jvm.org.apache.hadoop.fs
    whole, part = names.Path(path), names.Path(f"{path}.part")
    files = whole.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(part, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    files.delete(whole, False)
    if not files.rename(part, whole):
        raise OSError(f"could not write {path}")


def read_notes(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """The small files of a folder by name; none if it is not there. They are read by the driver, which takes no job."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    held = {}
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        if name.endswith(suffix):
            stream = files.open(entry.getPath())
            try:
                held[name.removesuffix(suffix)] = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return held
