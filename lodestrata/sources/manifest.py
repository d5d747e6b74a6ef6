"""Which loads of a table are finished: each table names them in a manifest, written after the files and before anybody reads them.

A manifest is a small file ``_manifesto/<number>.json`` below the table. The highest number holds; an earlier one is never changed, so a reader sees the
loads of one moment, and a run that dies while writing leaves folders that no manifest names. Folders that a manifest replaces are deleted by the one
after it: readers that began before a publication may finish. One writer at a time publishes to a table; a second one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from lodestrata.session import delete_folder

FOLDER = "_manifesto"
KEPT = 10


class NothingPublished(LookupError):
    """No load of the table was ever finished."""


class PublicationConflict(RuntimeError):
    """Another writer published to the table meanwhile."""


@dataclass(frozen=True)
class Manifest:
    """Parts of a table by name, each with its folder (below the table, or a full path), none for a part without rows.

    ``state`` holds what the writer wants to know next time; ``replaced`` names folders that readers may still use.
    """

    number: int = 0
    parts: Mapping[str, str | None] = field(default_factory=dict)
    state: Mapping[str, int] = field(default_factory=dict)
    replaced: tuple[str, ...] = ()


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    files, target = _files(spark, f"{table}/{FOLDER}")
    if not files.exists(target):
        return []
    names = [f.getPath().getName() for f in files.listStatus(target)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name.removesuffix(".json").isdigit())


def _named(number: int) -> str:
    return f"{number:012d}.json"


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    """What the table's last publication says; NothingPublished where there was none."""
    numbers = _numbers(spark, table)
    if not numbers:
        raise NothingPublished(f"no finished load under {table}")
    files, target = _files(spark, f"{table}/{FOLDER}/{_named(numbers[-1])}")
    stream = files.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    told = json.loads(text)
    return Manifest(numbers[-1], told["parts"], told["state"], tuple(told["replaced"]))


def manifest_or_empty(spark: SparkSession, table: str) -> Manifest:
    try:
        return read_manifest(spark, table)
    except NothingPublished:
        return Manifest()


def folder_of(table: str, part: str) -> str:
    return part if "/" in part and (part.startswith("/") or "://" in part or part.startswith("file:")) else f"{table}/{part}"


def publish(spark: SparkSession, table: str, changes: Mapping[str, str | None], state: Mapping[str, int] | None = None, before: Manifest | None = None) -> Manifest:
    """Writes the next manifest: the parts of ``before`` (the last one by default) with ``changes``.

    The file is written under another name and renamed, so nobody reads half of it. With ``before`` the publication fails if another came since.
    """
    last = manifest_or_empty(spark, table) if before is None else before
    replaced = tuple(last.parts[name] for name, part in changes.items() if last.parts.get(name) not in (None, part))
    new = Manifest(last.number + 1, {**last.parts, **changes}, dict(last.state if state is None else state), replaced)
    files, target = _files(spark, f"{table}/{FOLDER}/{_named(new.number)}")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{FOLDER}/.{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(json.dumps({"parts": new.parts, "state": new.state, "replaced": list(new.replaced)}).encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise PublicationConflict(f"{table}: publication {new.number} exists")
    for old in last.replaced:
        if old not in new.parts.values():
            delete_folder(spark, folder_of(table, old))
    for number in _numbers(spark, table)[:-KEPT]:
        delete_folder(spark, f"{table}/{FOLDER}/{_named(number)}")
    return new
