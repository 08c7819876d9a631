"""A commit log over folders of files: what a reader may see.

A writer puts its files into a folder of its own and then commits the folder under a name. The commit is one small file, written aside
and renamed, so it is there as a whole or not at all; folders without a commit, as a killed writer leaves them, are never read. A
name is committed once: a writer that is run again for the same name changes nothing. A commit may replace earlier ones,
which readers then leave out; this is how many small folders become one.

Renaming has to be atomic in the shared file system, as it is in HDFS and local ones. The log is read whole by the driver: a line for
each batch since the last compaction.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._file = jvm.org.apache.hadoop.fs.Path
        self.fs = self._file(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def commit(self, name: str, folder: str, replaces: list[str] | None = None) -> bool:
        """Make ``folder`` visible; False if the name was committed before."""
        target = self._file(f"{self.path}/{name}.json")
        if self.fs.exists(target):
            return False
        aside = self._file(f"{self.path}/.{name}-{uuid.uuid4().hex}")
        out = self.fs.create(aside, False)
        out.write(bytearray(json.dumps({"folder": folder, "replaces": replaces or []}).encode()))
        out.close()
        done = self.fs.rename(aside, target)
        if not done:
            self.fs.delete(aside, False)
        return done

    def entries(self) -> dict[str, dict]:
        """All commits by name, replaced ones too."""
        if not self.fs.exists(self._file(self.path)):
            return {}
        files = [s.getPath().getName() for s in self.fs.listStatus(self._file(self.path))]
        if not any(f.endswith(".json") for f in files):
            return {}
        rows = self.spark.read.text(f"{self.path}/*.json", wholetext=True).selectExpr("_metadata.file_name AS file", "value")
        return {r.file.removesuffix(".json"): json.loads(r.value) for r in rows.collect()}

    def live(self) -> dict[str, str]:
        """Folders that count, by the name of their commit."""
        entries = self.entries()
        gone = {name for e in entries.values() for name in e["replaces"]}
        return {name: e["folder"] for name, e in sorted(entries.items()) if name not in gone}

    def compact(self, read, write) -> str | None:
        """Turn all live folders into one: ``read(folders)`` gives their rows, ``write(rows, folder)`` writes them.

        Readers see the old folders until the new one is committed, and the new one from then on. Another compaction or batch
        that is committed meanwhile stays as it is: only what was read is replaced.
        """
        live = self.live()
        if len(live) < 2:
            return None
        name = f"compact-{uuid.uuid4().hex}"
        folder = f"{name}-data"
        write(read(list(live.values())), folder)
        return name if self.commit(name, folder, list(live)) else None

    def vacuum(self, base: str) -> int:
        """Delete folders below ``base`` that were replaced; not to be run while old readers are at work."""
        entries, live = self.entries(), self.live()
        old = [e["folder"] for name, e in entries.items() if name not in live]
        for folder in old:
            self.fs.delete(self._file(f"{base}/{folder}"), True)
        return len(old)


def read_folders(spark: SparkSession, base: str, folders: list[str]) -> DataFrame | None:
    """The Parquet rows of these folders below ``base``; None without any."""
    return spark.read.parquet(*[f"{base}/{f}" for f in folders]) if folders else None
