"""A table that a running stream extends and compacts, as folders under a versioned manifest.

A batch writes a folder of its own and then a manifest that lists it; readers take the newest
manifest, so they see whole batches only. A manifest is written aside and renamed to the next
version's name, which fails where another writer was faster; the change is then made again on top
of that version. So compaction needs no pause: it merges folders that are listed, and its manifest
replaces exactly these, whatever batches came in between.

Folders are merged in tiers: ``every`` folders of one level become one of the next. A row is
rewritten once a level, and a reader opens fewer than ``every`` folders a level, which is the
logarithm of the number of batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.operators.state import latest_per_key

SEQ = "_seq"
Merge = Callable[[DataFrame], DataFrame]


def newest_rows(key: str, order: str) -> Merge:
    """Merge that keeps the newest row per key; of equal ``order`` the row written last."""
    return lambda rows: latest_per_key(rows, key, order, SEQ).drop(SEQ)


def all_rows(files: int = 1) -> Merge:
    """Merge that keeps every row, in ``files`` files."""
    return lambda rows: rows.drop(SEQ).coalesce(files)


class Manifests:
    """Numbered JSON files of a folder; a number is written once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self.folder = folder
        root = self._path(folder)
        self.fs = root.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        self._never_over = spark.sparkContext._gateway.new_array(rename, 1)
        self._never_over[0] = rename.NONE
        self.fs.mkdirs(root)

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.folder))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def _name(self, version: int):
        return self._path(f"{self.folder}/{version:012d}.json")

    def read(self, version: int) -> dict:
        stream = self.fs.open(self._name(version))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, version: int, content: dict) -> bool:
        """Whether ``content`` became that version."""
        aside = self._path(f"{self.folder}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        try:
            self._context.rename(self.fs.makeQualified(aside), self.fs.makeQualified(self._name(version)), self._never_over)
        except Py4JJavaError as error:
            self.fs.delete(aside, False)
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def drop(self, version: int) -> None:
        self.fs.delete(self._name(version), False)


class StateLog:
    """Batches below ``path``, merged by ``merge``."""

    def __init__(self, spark: SparkSession, path: str, merge: Merge, every: int = 16) -> None:
        if every < 2:
            raise ValueError("a merge takes two folders at least")
        self.spark, self.path, self.merge, self.every = spark, path, merge, every
        self.manifests = Manifests(spark, f"{path}/_manifests")

    def current(self) -> tuple[int, dict]:
        versions = self.manifests.versions()
        if not versions:
            return 0, {"entries": [], "done": {}}
        return versions[-1], self.manifests.read(versions[-1])

    def _commit(self, change: Callable[[int, dict], dict | None]) -> bool:
        while True:
            version, content = self.current()
            changed = change(version + 1, json.loads(json.dumps(content)))
            if changed is None:
                return False
            if self.manifests.write(version + 1, changed):
                return True

    def append(self, batch: DataFrame, run: str, epoch: int, facts: dict[str, int] | None = None) -> bool:
        """Adds a batch; one that its run has added already is left out.

        ``facts`` are numbers the manifest keeps with the batch; of one name the largest stays.
        """
        if self.current()[1]["done"].get(run, -1) >= epoch:
            return False
        folder = f"level-0/{run}-{epoch}-{uuid.uuid4().hex[:8]}"
        self.merge(batch.withColumn(SEQ, F.lit(0))).write.parquet(f"{self.path}/{folder}")

        def add(version: int, content: dict) -> dict | None:
            if content["done"].get(run, -1) >= epoch:
                return None
            content["entries"].append({"folder": folder, "seq": version, "level": 0})
            content["done"][run] = epoch
            for name, value in (facts or {}).items():
                content[name] = max(value, content.get(name, value))
            return content

        added = self._commit(add)
        self.compact()
        return added

    def _rows(self, entries: list[dict]) -> DataFrame:
        one = lambda e: self.spark.read.parquet(f"{self.path}/{e['folder']}").withColumn(SEQ, F.lit(e["seq"]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, entries))

    def compact(self, everything: bool = False) -> int:
        """Merges full tiers (or all folders into one); returns how many merges were made."""
        merges = 0
        while True:
            entries = self.current()[1]["entries"]
            if everything:
                chosen = entries if len(entries) > 1 else []
            else:
                levels = sorted({e["level"] for e in entries})
                full = [[e for e in entries if e["level"] == k] for k in levels]
                chosen = next((x[: self.every] for x in full if len(x) >= self.every), [])
            if not chosen:
                return merges
            level = max(e["level"] for e in chosen) + 1
            folder = f"level-{level}/{uuid.uuid4().hex}"
            self.merge(self._rows(chosen)).write.parquet(f"{self.path}/{folder}")
            old = {e["folder"] for e in chosen}
            merged = {"folder": folder, "seq": max(e["seq"] for e in chosen), "level": level}

            def replace(version: int, content: dict) -> dict | None:
                if not old <= {e["folder"] for e in content["entries"]}:
                    return None  # merged by another writer
                content["entries"] = sorted([merged, *[e for e in content["entries"] if e["folder"] not in old]], key=lambda e: e["seq"])
                return content

            merges += self._commit(replace)

    def read(self) -> DataFrame:
        """All rows of the newest manifest, merged."""
        entries = self.current()[1]["entries"]
        if not entries:
            raise ValueError(f"nothing was written to {self.path}")
        return self.merge(self._rows(entries))

    def vacuum(self, keep: int = 8, older_than: float = 86_400.0) -> int:
        """Removes folders that none of the last ``keep`` manifests lists and that are older than ``older_than`` seconds.

        The age spares batches that are written but not listed yet.
        """
        fs, path = self.manifests.fs, self.spark._jvm.org.apache.hadoop.fs.Path
        versions = self.manifests.versions()
        listed = {e["folder"] for v in versions[-keep:] for e in self.manifests.read(v)["entries"]}
        for version in versions[:-keep]:
            self.manifests.drop(version)
        newest = self.spark._jvm.java.lang.System.currentTimeMillis() - older_than * 1000
        removed = 0
        for level in fs.listStatus(path(self.path)):
            if not level.getPath().getName().startswith("level-"):
                continue
            for folder in fs.listStatus(level.getPath()):
                name = f"{level.getPath().getName()}/{folder.getPath().getName()}"
                if name not in listed and folder.getModificationTime() <= newest:
                    removed += fs.delete(folder.getPath(), True)
        return removed

    def handler(self, run: str) -> Callable[[DataFrame, int], None]:
        """Batch handler; ``run`` names the checkpoint, so that replays are known after a restart too."""
        return lambda batch, epoch: self.append(batch, run, epoch) and None
