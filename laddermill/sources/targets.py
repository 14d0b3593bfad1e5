"""Targets that batches are upserted into: bucketed by their key, kept as versions of few layers.

A version is a list of layers, oldest first, in a manifest file of its own number. A layer holds, for some tables, the
rows of the keys that it owns, and counts as the state of those keys from then on: a key's rows are those of the newest
layer that owns it. A batch adds a layer and a manifest; nothing written is ever changed, so a reader that has opened a
version ends with it undisturbed. Layers are merged as soon as an older one is no more than FANOUT times as large as all
that came after it: so their number grows with the logarithm of the batches, and a row is rewritten as often.

All tables of all layers have the same buckets. A batch is shuffled into them to meet the layers; the layers are not.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from laddermill.operators.ingest import first_of

#: How many times as large as all newer ones together a layer must be to stay as it is.
FANOUT = 2
KEYS = "_keys"


class Conflict(RuntimeError):
    """Another writer has made the version that this one wanted to make."""


class Target:
    """Tables that share a key, under a folder that driver and executors share.

    tables: the schema of each, with the key. The number of buckets stays what it was when the folder was first used.
    """

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, StructType], key: str = "match_id", buckets: int = 8):
        self.spark, self.root, self.tables, self.key = spark, root.rstrip("/"), dict(tables), key
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)
        number, manifest = self._manifest()
        self.buckets = manifest["buckets"] if number else buckets

    # Versions

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _manifest(self, number: int | None = None) -> tuple[int, dict]:
        """A version's number and manifest; None: the newest. Before the first, 0 and no layers."""
        found = {int(s.getPath().getName()): s for s in self._fs.listStatus(self._hadoop(f"{self.root}/versions")) if s.getPath().getName().isdigit() and s.getLen()}
        number = max(found, default=0) if number is None else number
        if not number:
            return 0, {"layers": [], "applied": {}}
        if number not in found:
            raise ValueError(f"there is no version {number}")
        stream = self._fs.open(found[number].getPath())
        try:
            return number, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, number: int, manifest: dict) -> None:
        """Makes the version `number`: a file that must be new, so one of two writers at once fails."""
        try:
            # written aside and renamed, so that no reader sees half a manifest; a rename onto a file does nothing
            aside = self._hadoop(f"{self.root}/versions/.{uuid.uuid4().hex}")
            stream = self._fs.create(aside, False)
            stream.write(json.dumps(manifest | {"buckets": self.buckets}).encode())
            stream.close()
            at = self._hadoop(f"{self.root}/versions/{number:012d}")
            if self._fs.exists(at) or not self._fs.rename(aside, at):
                self._fs.delete(aside, False)
                raise Conflict(f"version {number} is there already")
        except PySparkException as error:
            raise Conflict(f"version {number} could not be made") from error

    @property
    def version(self) -> int:
        return self._manifest()[0]

    # Layers

    def _schema(self, name: str) -> StructType:
        return StructType([StructField(self.key, next(s[self.key] for s in self.tables.values()).dataType)]) if name == KEYS else self.tables[name]

    @staticmethod
    def _name(layer: dict, name: str) -> str:
        return f"{layer['folder'].replace('-', '_')}_{name}".lower()

    def _layer(self, layer: dict, name: str) -> DataFrame:
        """A table of a layer, declared in this session with its buckets if it is not yet."""
        table = self._name(layer, name)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(name))
            self.spark.sql(f"create table {table} ({columns}) using parquet clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets location '{self.root}/{layer['folder']}/{name}'")
        return self.spark.table(table)

    def _write(self, rows: Mapping[str, DataFrame], keys: DataFrame, replaces: bool) -> dict:
        layer = {"folder": f"layer-{uuid.uuid4().hex}", "tables": sorted(rows), "replaces": replaces}
        for name, df in {**rows, KEYS: keys}.items():
            there = self._layer(layer, name)
            # dealt into the buckets first: one file for each bucket
            df.select(*there.columns).repartition(self.buckets, self.key).sortWithinPartitions(self.key).write.insertInto(self._name(layer, name))
            self.spark.catalog.refreshTable(self._name(layer, name))  # a stream's batches belong to a session of their own
        return layer | {"rows": self._layer(layer, KEYS).count()}

    def _view(self, layers: Sequence[dict], name: str) -> DataFrame:
        """A table as these layers, oldest first, say it is."""
        parts = []
        for i, layer in enumerate(layers):
            if name in layer["tables"]:
                rows = self._layer(layer, name)
                for newer in layers[i + 1 :]:
                    if newer["replaces"] and name in newer["tables"]:
                        rows = rows.join(self._layer(newer, KEYS), self.key, "left_anti")
                parts.append(rows.select(*self.tables[name].names))
        if not parts:
            return self.spark.createDataFrame([], self.tables[name])
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables as they are in a version (None: the newest), whatever comes after."""
        layers = self._manifest(version)[1]["layers"]
        return {name: self._view(layers, name) for name in self.tables}

    # Batches

    def _commit(self, number: int, manifest: dict, layer: dict | None, source: str, batch: int | None) -> int:
        applied = manifest["applied"] | ({source: batch} if batch is not None else {})
        layers = manifest["layers"] + ([layer] if layer else [])
        self._publish(number + 1, {"layers": layers, "applied": applied})
        return self.compact()

    def upsert(self, batch: Mapping[str, DataFrame], policy: str = "skip", parent: str = "matches", better: str | None = None, order: Sequence[str | Column] = (), source: str = "batch", number: int | None = None) -> int:
        """Takes parents and their children in; gives the new version.

        skip: parents that are there stay. upgrade: one that is `better` takes the place of one that is not, with all its
        children; others stay. Of equal keys in the batch the first by order counts, better ones before. Tables that the
        batch lacks have no rows for the parents that it brings. number: a batch of a source that is no later than the
        last one taken changes nothing.
        """
        version, manifest = self._manifest()
        if number is not None and number <= manifest["applied"].get(source, -1):
            return version
        good = F.coalesce(F.expr(better), F.lit(False)) if better and policy == "upgrade" else F.lit(False)
        rows = first_of(batch[parent].withColumn("_good", good), [self.key], [F.desc("_good"), *(order or [self.key])])
        for i, layer in enumerate(x for x in manifest["layers"] if parent in x["tables"]):
            there = self._layer(layer, parent).select(self.key, good.alias(f"_good_{i}"), F.lit(True).alias(f"_there_{i}"))
            rows = rows.join(there, self.key, "left")
        n = sum(parent in x["tables"] for x in manifest["layers"])
        there, had = (F.coalesce(*(F.col(f"_{what}_{i}") for i in range(n)), F.lit(False)) if n else F.lit(False) for what in ("there", "good"))
        if n > 1:
            had = F.greatest(*(F.coalesce(F.col(f"_good_{i}"), F.lit(False)) for i in range(n)))
        from laddermill.sources.archives import saved

        taken = saved(rows.withColumn("_replaces", there).filter(~there | (F.col("_good") & ~had)).select(*self.tables[parent].names, "_replaces"), "taken")
        seen = taken.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or("_replaces"), F.lit(False)).alias("replaces")).first()
        if not seen.n:
            return self._commit(version, manifest, None, source, number)
        keys = taken.select(self.key)
        new = {parent: taken.drop("_replaces")} | {name: df.join(keys, self.key, "left_semi") for name, df in batch.items() if name != parent}
        new |= {name: self.spark.createDataFrame([], schema) for name, schema in self.tables.items() if name not in new}
        return self._commit(version, manifest, self._write(new, keys, seen.replaces), source, number)

    def replace(self, name: str, batch: DataFrame, source: str = "batch", number: int | None = None) -> int:
        """Puts the batch's rows of one table in the place of all rows of their keys; gives the new version."""
        version, manifest = self._manifest()
        if number is not None and number <= manifest["applied"].get(source, -1):
            return version
        return self._commit(version, manifest, self._write({name: batch}, batch.select(self.key).distinct(), True), source, number)

    def compact(self, fanout: float = FANOUT) -> int:
        """Merges the newest layers of similar size into one, if there are such; gives the newest version."""
        number, manifest = self._manifest()
        layers = manifest["layers"]
        first, rows = len(layers) - 1, layers[-1]["rows"] if layers else 0
        while first > 0 and layers[first - 1]["rows"] <= fanout * rows:
            first -= 1
            rows += layers[first]["rows"]
        if first >= len(layers) - 1:
            return number
        tail = layers[first:]
        names = sorted({name for layer in tail for name in layer["tables"]})
        if any(layer["tables"] != names for layer in tail):  # a layer owns its keys in all its tables: others are merged among themselves
            return number
        keys = self._layer(tail[0], KEYS)
        for layer in tail[1:]:
            keys = keys.union(self._layer(layer, KEYS))
        whole = self._write({name: self._view(tail, name) for name in names}, keys.distinct(), first > 0 and any(x["replaces"] for x in tail))
        self._publish(number + 1, manifest | {"layers": [*layers[:first], whole]})
        return number + 1

    def vacuum(self, keep: int = 10) -> list[str]:
        """Deletes the layers that none of the newest `keep` versions has; readers of older ones fail from then on."""
        numbers = sorted(int(s.getPath().getName()) for s in self._fs.listStatus(self._hadoop(f"{self.root}/versions")) if s.getPath().getName().isdigit())
        held = {layer["folder"] for n in numbers[-keep:] for layer in self._manifest(n)[1]["layers"]}
        there = [s.getPath().getName() for s in self._fs.listStatus(self._hadoop(self.root)) if s.getPath().getName().startswith("layer-")]
        gone = sorted(x for x in there if x not in held)
        for n in numbers[:-keep]:
            self._fs.delete(self._hadoop(f"{self.root}/versions/{n:012d}"), False)
        for folder in gone:
            self._fs.delete(self._hadoop(f"{self.root}/{folder}"), True)
        return gone
