"""Tables kept as whole versions: a merge is written to a folder of its own and then published in one step.

    path/data/<writer>            the rows of a version, as Parquet; never written to again
    path/versions/<number>/       what makes the folder the table: commit.json names it, its rows and its parent

A version is published by renaming a prepared folder to its number. Renaming refuses a number that is taken, so of two
writers that started from the same version the second one gets Conflict and nothing of it is seen. Readers take the
highest number, whose folder was whole before it got there; a merge that fails leaves a folder that nothing names.
This needs a file system with such a rename, as HDFS or a local disk; an object store without one needs a lock around it.

With keys and buckets, versions are written as bucketed tables. A merge by these keys then joins the target where it
lies: only the source is shuffled, and the result of the join is already dealt as the next version wants it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer has published a version since this one's parent was read."""


class Snapshots:
    """A table at a path, by version. keys and buckets hold for versions that are written from now on."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = (), buckets: int = 0):
        if bool(keys) != bool(buckets):
            raise ValueError("buckets need keys, and keys need a number of buckets")
        self._spark, self._keys, self._buckets = spark, tuple(keys), buckets
        self._path = path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self._path}/{name}" if name else self._path)

    def versions(self) -> list[int]:
        """Published versions, the oldest first."""
        folder = self._at("versions")
        found = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        return sorted(int(x.getPath().getName()) for x in found if x.getPath().getName().isdigit())

    def version(self) -> int:
        """The current version; 0 where nothing was published yet."""
        return max(self.versions(), default=0)

    def described(self, version: int) -> dict:
        """commit.json of a version: folder, rows, parent, schema, keys and buckets."""
        stream = self._fs.open(self._at(f"versions/{version:08d}/commit.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows, the current ones if none is named."""
        version = self.version() if version is None else version
        if version == 0:
            raise ValueError(f"nothing was published at {self._path}")
        commit = self.described(version)
        schema = StructType.fromJson(json.loads(commit["schema"]))
        if not commit["buckets"]:
            return self._spark.read.schema(schema).parquet(commit["folder"])
        # buckets are known to Spark by a table's entry; its name is the folder's, so a session makes it once
        name = commit["table"]
        if not self._spark.catalog.tableExists(name):
            keys = ", ".join(f"`{k}`" for k in commit["keys"])
            self._spark.sql(
                f"create table if not exists {name} ({schema.toDDL()}) using parquet clustered by ({keys}) sorted by ({keys}) into {commit['buckets']} buckets location '{commit['folder']}'"
            )
        return self._spark.table(name)

    def commit(self, rows: DataFrame, parent: int) -> int:
        """Write rows as the version after `parent`; Conflict if another one took its place meanwhile."""
        if parent != self.version():
            raise Conflict(f"version {self.version()} came after {parent}")
        writer = uuid.uuid4().hex
        folder, table = f"{self._path}/data/{writer}", f"snapshot_{writer}"
        seen = Observation()
        if self._buckets and not parent:
            # a first load comes in any order: dealt as buckets are, each task writes one file. Merges come dealt already
            rows = rows.repartition(self._buckets, *self._keys)
        out = rows.observe(seen, F.count(F.lit(1)).alias("n")).write
        if self._buckets:
            out.bucketBy(self._buckets, *self._keys).sortBy(*self._keys).option("path", folder).format("parquet").saveAsTable(table)
        else:
            out.parquet(folder)
        commit = {"folder": folder, "table": table, "writer": writer, "parent": parent, "rows": seen.get["n"], "at": time.time()}
        commit |= {"schema": rows.schema.json(), "keys": self._keys, "buckets": self._buckets}
        self._publish(parent + 1, writer, commit)
        return parent + 1

    def _publish(self, version: int, writer: str, commit: dict) -> None:
        ready, place = self._at(f"versions/_{writer}"), self._at(f"versions/{version:08d}")
        self._fs.mkdirs(ready)
        stream = self._fs.create(self._hadoop.Path(ready, "commit.json"), False)
        try:
            stream.write(bytearray(json.dumps(commit).encode()))
        finally:
            stream.close()
        options = self._spark.sparkContext._gateway.new_array(self._spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._hadoop.FileContext.getFileContext(place.toUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(ready), self._fs.makeQualified(place), options)
        except Exception as error:
            self._fs.delete(ready, True)
            raise Conflict(f"version {version} was published by another writer") from error
        # where a rename may move a folder into one that was made at the same moment, the file tells who was first
        if self.described(version)["writer"] != writer:
            raise Conflict(f"version {version} was published by another writer")

    def merge(self, step: Callable[[DataFrame], DataFrame], attempts: int = 3) -> int:
        """Publish step(current rows). After a conflict the step runs again on what the other writer published."""
        for last in range(attempts - 1, -1, -1):
            parent = self.version()
            try:
                return self.commit(step(self.read(parent)), parent)
            except Conflict:
                if not last:
                    raise
        raise ValueError("at least one attempt is needed")

    def vacuum(self, keep: int = 2, older_than: float = 7 * 86400) -> int:
        """Delete all but the last versions, and folders of failed writers that weren't touched for so many seconds.

        Readers of a version that goes must have ended; so many seconds must be longer than any write takes.
        """
        numbers = self.versions()
        named, gone = set(), 0
        for v in numbers:
            folder = self.described(v)["folder"]
            if v in numbers[-max(1, keep) :]:
                named.add(folder.rsplit("/", 1)[-1])
                continue
            # the entry goes first, so that no reader finds a version without its rows
            self._fs.delete(self._at(f"versions/{v:08d}"), True)
            gone += self._fs.delete(self._hadoop.Path(folder), True)
        data, now = self._at("data"), time.time()
        for x in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if x.getPath().getName() not in named and now - x.getModificationTime() / 1000 > older_than:
                gone += self._fs.delete(x.getPath(), True)
        return gone
