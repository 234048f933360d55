"""Parquet artefacts: enforced-schema reads, fail-if-present and overwrite writes,
records that appear whole or not at all, and reuse-or-compute of saved data and
models as committed versions.

A versioned artefact is a folder. Every build goes to a folder of its own inside
it, and only then a small record is published that names that folder and the
fingerprint of what it was built from. What a failed build leaves has no record
and is never read; a reader that has opened a version keeps it while the next
one is written; a record with another fingerprint is not reused.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

T = TypeVar("T")

RECORDS = "_versions"


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> str:
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return path


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return bool(fs.exists(jpath))


# --- records ---------------------------------------------------------------------

def publish(spark: SparkSession, path: str, record: dict) -> bool:
    """Writes a small JSON record that appears whole or not at all; False if one is there already.

    Written aside and renamed without overwriting, which is one step on HDFS and on
    local disks. A store without such a rename needs a committer of its own."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    out.close()
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def records(spark: SparkSession, folder: str) -> list[dict]:
    """The published records of a folder in the order of their names."""
    fs, target = _file_system(spark, folder)
    if not fs.exists(target):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(target))
    out = []
    for name in names:
        if name.endswith(".json") and not name.startswith("_"):
            stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, name))
            try:
                out.append(json.loads(bytes(stream.readAllBytes()).decode()))
            finally:
                stream.close()
    return out


# --- reuse or compute ----------------------------------------------------------------

def fingerprint(*inputs: DataFrame, **parameters) -> str:
    """Of the files behind some tables (name, length, time of change) and of parameters."""
    found = []
    for df in inputs:
        for file in sorted(df.inputFiles()):
            fs, path = _file_system(df.sparkSession, file)
            status = fs.getFileStatus(path)
            found.append([file, status.getLen(), status.getModificationTime()])
    text = json.dumps([found, parameters], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def current(spark: SparkSession, path: str) -> dict | None:
    """The last published version of an artefact."""
    found = records(spark, f"{path.rstrip('/')}/{RECORDS}")
    return found[-1] if found else None


def load_or_build(spark: SparkSession, path: str, build: Callable[[], T],
                  save: Callable[[T, str], None], load: Callable[[str], T],
                  reuse: bool = True, made_from: str = "") -> T:
    """Reuse the published version when allowed and made from the same (``fingerprint``),
    else build, save and publish the next one. Who publishes second uses what the first
    one published, if that is made from the same."""
    root = path.rstrip("/")
    last = current(spark, root)
    if reuse and last is not None and last["made_from"] == made_from:
        return load(f"{root}/{last['folder']}")
    value = build()
    while True:
        number = (last["version"] if last else 0) + 1
        folder = f"data-{number:08d}-{uuid.uuid4().hex[:8]}"
        save(value, f"{root}/{folder}")
        record = {"version": number, "folder": folder, "made_from": made_from}
        if publish(spark, f"{root}/{RECORDS}/{number:08d}.json", record):
            return load(f"{root}/{folder}")
        last = current(spark, root)
        if reuse and last["made_from"] == made_from:
            return load(f"{root}/{last['folder']}")


def load_or_build_frame(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                        schema: StructType | None = None, reuse: bool = True, made_from: str = "") -> DataFrame:
    return load_or_build(spark, path, build, save=lambda df, p: write_parquet(df, p),
                         load=lambda p: read_parquet(spark, p, schema), reuse=reuse, made_from=made_from)


def versions(spark: SparkSession, path: str) -> list[dict]:
    """All published versions, the oldest first."""
    return records(spark, f"{path.rstrip('/')}/{RECORDS}")


def release(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Removes the data of all but the last ``keep`` published versions and what failed builds
    left before the last one; returns the folders. For times when nobody reads an older version."""
    root = path.rstrip("/")
    published = versions(spark, root)
    if not published:
        return []
    kept = {r["folder"] for r in published[-keep:]}
    fs, target = _file_system(spark, root)
    gone = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in kept and int(name.split("-")[1]) <= published[-1]["version"]:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
