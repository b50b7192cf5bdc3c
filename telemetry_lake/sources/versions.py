"""Versioned folders: a dataset is replaced by switching one pointer file.

A dataset ``root`` holds version folders and a file ``_CURRENT`` with the name
of the one that counts.  A new version is written beside the old one and the
pointer is switched last, so a run that fails half-way leaves the previous
version readable, and a reader sees one version whole.  A root without pointer
is its own only version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "_CURRENT"
PREFIX = "version_"


def hadoop(spark: SparkSession, path: str):
    """(configuration, file system, path) of a path of any scheme."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return conf, p.getFileSystem(conf), p


def new_version(stamp: str) -> str:
    """Name of a version folder; unique, also for runs of the same second."""
    return f"{PREFIX}{stamp}_{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """Name of the version that counts; None for a root without pointer."""
    _, fs, pointer = hadoop(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def current_path(spark: SparkSession, root: str) -> str:
    """Folder of the version that counts, or the root itself."""
    version = current_version(spark, root)
    root = root.rstrip("/")
    return f"{root}/{version}" if version else root


def publish(spark: SparkSession, root: str, version: str, keep: int = 1) -> str:
    """Let ``version`` count from now on; returns its folder.

    The pointer is written beside its place and renamed onto it in one step.
    ``keep`` versions that counted before stay, for readers still at work;
    other version folders, those of failed runs too, are removed.  A dataset
    has one writer at a time.
    """
    root = root.rstrip("/")
    before = current_version(spark, root)
    jvm = spark.sparkContext._jvm
    conf, fs, draft = hadoop(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    _, _, pointer = hadoop(spark, f"{root}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(draft), fs.makeQualified(pointer), options
    )
    names = [s.getPath().getName() for s in fs.listStatus(hadoop(spark, root)[2]) if s.isDirectory()]
    older = sorted(n for n in names if n.startswith(PREFIX) and n not in (version, before))
    stay = keep - (before is not None)
    for name in older[: len(older) - max(0, stay)]:
        fs.delete(hadoop(spark, f"{root}/{name}")[2], True)
    return f"{root}/{version}"
