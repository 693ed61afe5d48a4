"""Commit records: what a reader goes by, so that writes that died half way are passed over.

A table's folder holds `_commits/<name>.json` for everything finished in it. A record is written beside and then
renamed into place, which fails if it is there already: of two writers of one name, one loses. Spark's readers ignore
the folder. Data of a writer that died stays unseen until `reclaim` deletes it.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

RECORDS = "_commits"
# Unfinished data younger than this may belong to a writer that still runs.
GRACE_SECONDS = 24 * 3600


class AlreadyCommitted(RuntimeError):
    """Another writer was first."""


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark's own readers see them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def children(spark: SparkSession, path: str) -> list:
    system, place = folder(spark, path)
    return list(system.listStatus(place)) if system.exists(place) else []


def data_names(spark: SparkSession, path: str) -> list[str]:
    """What Spark would read in a folder: no job's temporary files, no marks."""
    return sorted(n for n in (c.getPath().getName() for c in children(spark, path)) if not n.startswith(("_", ".")))


def commit(spark: SparkSession, path: str, name: str, content: dict, replace: bool = False) -> None:
    """Record `name` as finished; without `replace`, it must not be yet."""
    target = f"{path}/{RECORDS}/{name}.json"
    system, _ = folder(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{RECORDS}/.{uuid.uuid4().hex}")
    out = system.create(beside)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if replace else kinds.NONE
    _, end = folder(spark, target)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf())
    try:
        files.rename(system.makeQualified(beside), system.makeQualified(end), how)
    except Exception as error:
        system.delete(beside, False)
        if "FileAlreadyExistsException" not in str(error):
            raise
        raise AlreadyCommitted(f"{name} of {path} is committed already") from None


def committed(spark: SparkSession, path: str) -> list[str]:
    """The names of all records."""
    names = (c.getPath().getName() for c in children(spark, f"{path}/{RECORDS}"))
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))


def record(spark: SparkSession, path: str, name: str) -> dict:
    system, place = folder(spark, f"{path}/{RECORDS}/{name}.json")
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def forget(spark: SparkSession, path: str, name: str) -> None:
    system, place = folder(spark, f"{path}/{RECORDS}/{name}.json")
    system.delete(place, False)


def commit_files(spark: SparkSession, path: str, name: str) -> None:
    """Record the folder `name` of a table as finished, with the files it has now."""
    commit(spark, path, name, {"files": data_names(spark, f"{path}/{name}")}, replace=True)


def finished(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Those of the table's folders that are whole.

    Where the table has records, these are the recorded ones whose files are all there; without any record
    (a table that others write), those that hold data.
    """
    known = set(committed(spark, path))
    if not known:
        return [n for n in names if data_names(spark, f"{path}/{n}")]
    whole = []
    for n in names:
        if n in known:
            files = record(spark, path, n).get("files")
            if files is None or set(files) <= set(data_names(spark, f"{path}/{n}")):
                whole.append(n)
    return whole


def reclaim(spark: SparkSession, path: str, older_than: float = GRACE_SECONDS) -> list[str]:
    """Delete attempts at versions that were never committed and are older than so many seconds; their paths."""
    used = {f for n in committed(spark, path) for f in record(spark, path, n).get("folders", {}).values()}
    gone = []
    for version in (c.getPath().getName() for c in children(spark, path)):
        if not version.startswith("version="):
            continue
        for attempt in children(spark, f"{path}/{version}"):
            name = f"{version}/{attempt.getPath().getName()}"
            young = time.time() - attempt.getModificationTime() / 1000 < older_than
            if not young and not any(f == name or f.startswith(f"{name}/") for f in used):
                folder(spark, path)[0].delete(attempt.getPath(), True)
                gone.append(name)
    return sorted(gone)
