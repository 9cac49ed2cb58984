"""Published data on plain paths: whole versions, named by manifests.

A publication writes its data beside what is there, under a name of its own,
and then adds one small file, the manifest, which lists the directories that
make up the new version.  Manifests are numbered and never changed; the
newest whole one is the published version.  Nothing is renamed or deleted to
publish, so there is no moment without a version, on file systems and object
stores alike, and a writer that dies before its manifest is whole leaves the
published version as it was: a manifest carries the digest of its content, and
readers skip one that does not have it.

With a partition column a version may keep directories of the version before
and replace others (``replace_partitions``): late changes rewrite only the
partitions they fall in.  Readers see the column as a partition column, so
Spark prunes directories by filters on it, and by joins at run time.

Two writers can't publish over each other: both try to create the same next
number, and the second one fails (on object stores this needs a store with
conditional creation).

Layout: ``<root>/manifest/<number>.json``, ``<root>/data/publication=<id>/...``.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .sinks import _filesystem, delete_path

_PUBLICATION = "publication"


@dataclasses.dataclass(frozen=True)
class Manifest:
    """One version: its directories (relative to ``data``), by partition."""
    number: int
    schema: str
    partition: str | None
    parts: dict[str, str]
    notes: dict[str, str]

    def to_bytes(self) -> bytes:
        content = json.dumps(dataclasses.asdict(self), sort_keys=True)
        return f"{hashlib.sha256(content.encode()).hexdigest()}\n{content}".encode()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Manifest | None":
        """None if the file is not whole."""
        digest, _, content = raw.partition(b"\n")
        if hashlib.sha256(content).hexdigest().encode() != digest:
            return None
        return cls(**json.loads(content))


class PublishedElsewhere(RuntimeError):
    """Another writer published the next version first."""


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _filesystem(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(root: str, number: int) -> str:
    return f"{root}/manifest/{number:012d}.json"


def load(spark: SparkSession, root: str, number: int) -> Manifest | None:
    """The version of a number; None if its manifest is not whole."""
    fs, path = _filesystem(spark, _file(root, number))
    stream = fs.open(path)
    try:
        return Manifest.from_bytes(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def latest(spark: SparkSession, root: str) -> Manifest | None:
    """The published version: the newest whole manifest."""
    for number in reversed(_numbers(spark, root)):
        found = load(spark, root, number)
        if found:
            return found
    return None


def _add(spark: SparkSession, root: str, manifest: Manifest) -> None:
    fs, path = _filesystem(spark, _file(root, manifest.number))
    try:
        stream = fs.create(path, False)
    except Exception as e:
        if "AlreadyExists" in str(e) or "already exists" in str(e):
            raise PublishedElsewhere(f"version {manifest.number} of {root} was published by another writer") from e
        raise
    try:
        stream.write(bytearray(manifest.to_bytes()))
    finally:
        stream.close()


def _write(df: DataFrame, root: str, partition: str | None) -> dict[str, str]:
    """The data of a publication, and its directories by partition."""
    spark, name = df.sparkSession, f"{_PUBLICATION}={uuid.uuid4().hex}"
    path = f"{root}/data/{name}"
    writer = df.write.mode("errorifexists")
    try:
        (writer.partitionBy(partition) if partition else writer).parquet(path)
    except Exception:
        delete_path(spark, path)
        raise
    if not partition:
        return {"": name}
    fs, folder = _filesystem(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return {part: f"{name}/{part}" for part in found if part.startswith(f"{partition}=")}


def _as_read(schema: StructType) -> list:
    """What must agree for files to be parts of one version: read back, every
    column may be null."""
    return [(f.name, f.dataType) for f in schema.fields]


def publish_files(df: DataFrame, root: str, partition: str | None = None, notes: dict[str, str] | None = None,
                  before_commit: Callable[[], None] | None = None) -> Manifest:
    """Publish ``df`` as the next version under ``root``.  ``before_commit``
    is called when the data is written and the version not yet there."""
    spark, root = df.sparkSession, root.rstrip("/")
    if _PUBLICATION in df.columns:
        raise ValueError(f"{_PUBLICATION} can't be a column of published data")
    number = max(_numbers(spark, root), default=0) + 1
    parts = _write(df, root, partition)
    if before_commit:
        before_commit()
    manifest = Manifest(number, df.schema.json(), partition, parts, notes or {})
    _add(spark, root, manifest)
    return manifest


def replace_partitions(df: DataFrame, root: str, base: Manifest, replaced: Iterable[str] | Callable[[str], bool],
                       notes: dict[str, str] | None = None) -> Manifest:
    """Publish a version that has ``df`` for the partitions ``replaced`` (their
    directory names, or a test of them; those without rows in ``df`` go) and
    the directories of ``base`` for all others."""
    spark, root = df.sparkSession, root.rstrip("/")
    is_replaced = replaced if callable(replaced) else set(replaced).__contains__
    if _as_read(df.schema) != _as_read(StructType.fromJson(json.loads(base.schema))):
        raise ValueError("the schema differs from the published one: publish all of it")
    new = _write(df, root, base.partition)
    outside = sorted(k for k in new if not is_replaced(k))
    if outside:
        raise ValueError(f"rows outside the partitions to replace: {outside[:5]}")
    parts = {k: v for k, v in base.parts.items() if not is_replaced(k)} | new
    manifest = Manifest(base.number + 1, base.schema, base.partition, parts, notes or {})
    _add(spark, root, manifest)
    return manifest


def read_published(spark: SparkSession, root: str, manifest: Manifest | None = None) -> DataFrame:
    """The published version (or the one of ``manifest``)."""
    root = root.rstrip("/")
    manifest = manifest or latest(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    schema = StructType.fromJson(json.loads(manifest.schema))
    if not manifest.parts:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/{d}" for d in manifest.parts.values()]
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths).select(schema.names)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete data and manifests that neither the published version nor the
    ``keep`` whole ones before it name.  No publication may be under way."""
    root = root.rstrip("/")
    whole = [m for m in (load(spark, root, n) for n in _numbers(spark, root)) if m]
    kept = whole[-keep - 1:]
    if not kept:
        return
    named = {d for m in kept for d in m.parts.values()}
    fs, data = _filesystem(spark, f"{root}/data")
    for publication in [s.getPath().getName() for s in fs.listStatus(data)]:
        if publication in named:
            continue
        inside = {d for d in named if d.startswith(f"{publication}/")}
        if not inside:
            delete_path(spark, f"{root}/data/{publication}")
            continue
        _, folder = _filesystem(spark, f"{root}/data/{publication}")
        for part in [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]:
            if f"{publication}/{part}" not in inside:
                delete_path(spark, f"{root}/data/{publication}/{part}")
    for number in _numbers(spark, root):
        if number < kept[0].number:
            delete_path(spark, _file(root, number))
