"""Layer sinks: bronze, silver and gold as versioned Parquet under one lake root.

A table's folder holds one folder per written version, ``{layer}/{model}/v=<id>``,
and versions are never changed; a table that is appended to consists of several. Which version is current is said by releases:
small JSON files ``_releases/<number>.json`` with a version for every table of the
lake. A release is published by renaming a finished file to the next free number,
which fails if another writer took it, so readers see the tables of one release,
never a mixture, and a build that dies half-way has changed nothing. Readers take
the release with the highest number.

The files of old versions stay readable until ``vacuum`` removes them.
"""

from __future__ import annotations

import dataclasses
import json
import os
import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import Files

LAYERS = ("bronze", "silver", "gold")
RELEASES = "_releases"
CODEC = "zstd"  # of the layers' files: about two thirds of the default codec's bytes


def layer_name(custom: str | None, default: str) -> str:
    """Schema name of a layer: the configured name used verbatim (trimmed);
    without one (none, or a blank one) the default."""
    return (custom or "").strip() or default


class ReleaseConflict(RuntimeError):
    """Another writer published one of a build's tables while it ran."""


@dataclasses.dataclass(frozen=True)
class Release:
    """What the lake holds: the version ids of each ``layer.model``, and facts kept with them."""

    number: int = 0
    tables: Mapping[str, list[str]] = dataclasses.field(default_factory=dict)
    settings: Mapping[str, object] = dataclasses.field(default_factory=dict)

    def versions(self, layer: str, model: str) -> list[str]:
        try:
            return self.tables[f"{layer}.{model}"]
        except KeyError:
            raise LookupError(f"no release has a table {layer}.{model}") from None


class Layout:
    """Where each layer lives: ``{root}/{schema}/{model}/v=<id>``.

    ``schemas`` maps a layer to its own schema name, which is both the folder's
    and the catalog database's name; a layer without one has its own name.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str] | None = None):
        self.spark, self.root = spark, root
        unknown = set(schemas or {}) - set(LAYERS)
        if unknown:
            raise ValueError(f"unknown layer {sorted(unknown)}")
        self.schemas = {x: layer_name((schemas or {}).get(x), x) for x in LAYERS}
        if len(set(self.schemas.values())) < len(LAYERS):
            raise ValueError(f"two layers of one name: {self.schemas}")
        self.files = Files(spark)

    # paths
    def schema(self, layer: str) -> str:
        if layer not in self.schemas:
            raise ValueError(f"unknown layer {layer!r}")
        return self.schemas[layer]

    def path(self, layer: str, model: str) -> str:
        return os.path.join(self.root, self.schema(layer), model)

    def version_path(self, layer: str, model: str, version: str) -> str:
        return os.path.join(self.path(layer, model), f"v={version}")

    # releases
    def releases(self) -> list[int]:
        names = self.files.names(os.path.join(self.root, RELEASES))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def release(self, number: int | None = None) -> Release:
        """A release by number; without one the current one (an empty one before the first)."""
        if number is None:
            numbers = self.releases()
            if not numbers:
                return Release()
            number = numbers[-1]
        text = self.files.read(self._release_path(number))
        return Release(**json.loads(text))

    def _release_path(self, number: int) -> str:
        return os.path.join(self.root, RELEASES, f"{number:012d}.json")

    def begin(self) -> Build:
        return Build(self)

    # tables
    def write(self, df: DataFrame, layer: str, model: str,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Replace one table with ``df`` by a release of its own, and return a scan of it."""
        build = self.begin()
        out = build.write(df, layer, model, partition_by)
        build.publish()
        return out

    def read(self, layer: str, model: str, release: Release | None = None) -> DataFrame:
        versions = (release or self.release()).versions(layer, model)
        return self.spark.read.parquet(*[self.version_path(layer, model, v) for v in versions])

    # catalog
    def database(self, layer: str) -> str:
        """The catalog database of a layer, located at its folder."""
        name = self.schema(layer)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` "
                       f"LOCATION '{os.path.join(self.root, name)}'")
        return name

    def register(self, layer: str, model: str, release: Release | None = None) -> str:
        """Make the current version of a table queryable as ``{schema}.{model}``
        (a table of one version: appended ones are read by ``read``).

        An external Parquet table over the version's folder; a table that is
        there already is pointed at the new version by one catalog change, so
        it can be read by name all the time, unless its columns changed. With a
        persistent metastore it survives the session; otherwise it lasts for it.
        """
        version, *more = (release or self.release()).versions(layer, model)
        if more:
            raise ValueError(f"{layer}.{model} has been appended to: merge it first")
        path = self.version_path(layer, model, version)
        db = self.database(layer)
        name = f"`{db}`.`{model}`"
        schema = self.spark.read.parquet(path).schema
        if self.spark.catalog.tableExists(f"{db}.{model}"):
            if self.spark.table(name).schema == schema:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(name)
                return f"{db}.{model}"
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.catalog.createTable(f"{db}.{model}", path=path, source="parquet")
        return f"{db}.{model}"

    def vacuum(self, keep: int = 2, older_than: timedelta = timedelta(days=1)) -> list[str]:
        """Remove versions that none of the last ``keep`` releases has and that
        are older than ``older_than`` (younger ones may belong to a running
        build). Returns their folders. Older releases can no longer be read."""
        if keep < 1:
            raise ValueError("the current release has to be kept")
        numbers = self.releases()
        kept = {f"{t}/v={v}" for n in numbers[-keep:]
                for t, versions in self.release(n).tables.items() for v in versions}
        limit = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
        gone = []
        for layer in LAYERS:
            for folder, stamp in self.files.versions(os.path.join(self.root, self.schema(layer))):
                table = os.path.relpath(folder, os.path.join(self.root, self.schema(layer)))
                if f"{layer}.{table}" not in kept and stamp <= limit:
                    gone.append(folder)
        for number in numbers[:-keep]:
            self.files.delete(self._release_path(number))
        for folder in gone:
            self.files.delete(folder)
        return gone


class Build:
    """Tables written together and published together by one release.

    ``write`` adds a version that nobody sees yet; ``publish`` makes all of them
    current at once. A build is never half visible: without ``publish`` the lake
    stays as it was, and what was written is left for ``vacuum``.
    """

    def __init__(self, layout: Layout):
        self.layout = layout
        self.base = layout.release()
        self.id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + f"-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, list[str]] = {}

    def write(self, df: DataFrame, layer: str, model: str,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.layout.version_path(layer, model, self.id)
        writer = df.write.mode("errorifexists").format("parquet").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
        self.tables[f"{layer}.{model}"] = [self.id]
        return self.layout.spark.read.parquet(path)

    def append(self, df: DataFrame, layer: str, model: str) -> DataFrame:
        """Add ``df`` to a table as one more version, and return a scan of ``df``."""
        out = self.write(df, layer, model)
        self.tables[f"{layer}.{model}"] = [*self.base.tables.get(f"{layer}.{model}", []), self.id]
        return out

    def publish(self, only: tuple[str, ...] | None = None, **settings) -> Release:
        """Make the written tables (or ``only`` some, as ``layer.model``) current.

        Other writers' releases in between are kept; if one of them changed a
        table of this build, nothing is published and ``ReleaseConflict`` raised.
        """
        mine = {t: v for t, v in self.tables.items() if only is None or t in only}
        while True:
            now = self.layout.release()
            changed = [t for t in mine if now.tables.get(t) != self.base.tables.get(t)]
            if changed:
                raise ReleaseConflict(f"published by another build meanwhile: {sorted(changed)}")
            release = Release(now.number + 1, {**now.tables, **mine}, {**now.settings, **settings})
            text = json.dumps(dataclasses.asdict(release), indent=1, sort_keys=True)
            if self.layout.files.create(self.layout._release_path(release.number), text):
                self.base = release
                return release
