"""A store whose batches count only once their manifest entry is written.

A store is a folder with any number of *outputs* (``raw``, ``late``,
``documents``, ...).  Every batch of a job writes its rows under a fresh
commit id, day first (``<output>/index_date=.../commit=...``), and then one
small file into ``_commits``.  Readers take the rows of live commits only, so

* a batch that failed half-way is not there, in any of its outputs;
* a batch that is repeated after a restart finds its entry and does nothing
  (:meth:`Store.done`), or replaces what it wrote (a later attempt wins);
* a compaction is one entry that names the commits it stands for: it appears
  and they disappear in the same moment, while other batches go on;
* expired days are whole folders.

A *run* is one checkpoint's life.  Its number is claimed by creating a file
that must not exist yet, so two starts at once get two numbers; a restart
from the same checkpoint keeps its run.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRY = "commit string, run bigint, batch_id bigint, attempt bigint, replaces array<string>"
#: Columns that every stored row has besides its own.
VERSION = ["run", "batch_id"]


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- files ---------------------------------------------------------------
    def _at(self, name: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, pattern: str) -> list[str]:
        """Paths that match a pattern, relative to the store."""
        p, fs = self._at(pattern)
        root = fs.makeQualified(self._at("")[0]).toUri().getPath().rstrip("/")
        return [s.getPath().toUri().getPath()[len(root) + 1:] for s in fs.globStatus(p) or []]

    def _put(self, name: str, text: str) -> None:
        """Write a file so that it is there as a whole or not at all."""
        tmp, fs = self._at(f"_tmp/{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        out.write(bytearray(text.encode()))
        out.close()
        to, _ = self._at(name)
        fs.mkdirs(to.getParent())
        if not fs.rename(tmp, to):
            raise RuntimeError(f"{to} can't be written")

    def _claim(self, name: str, text: str) -> bool:
        """Create a file that must not exist; false if it does."""
        p, fs = self._at(name)
        if fs.exists(p):
            return False
        try:
            out = fs.create(p, False)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    # -- runs and commits ----------------------------------------------------
    def open_run(self, checkpoint: str) -> int:
        """Run number of a checkpoint; a checkpoint not seen before gets the next one."""
        while True:
            names = self._names("_runs/*")
            own = {}
            if names:
                rows = self.spark.read.text(f"{self.path}/_runs").select("value", F.col("_metadata.file_name").alias("f")).collect()
                own = {r.value: int(r.f) for r in rows}
            if checkpoint in own:
                return own[checkpoint]
            run = max((int(n.rsplit("/", 1)[1]) for n in names), default=-1) + 1
            if self._claim(f"_runs/{run}", checkpoint):
                return run

    def _entries(self, run: int, batch_id: int) -> list[str]:
        return self._names(f"_commits/{run}-{batch_id}-*")

    def done(self, run: int, batch_id: int) -> bool:
        return bool(self._entries(run, batch_id))

    def begin(self, run: int, batch_id: int) -> str:
        """A fresh commit id; its rows count from :meth:`commit` on."""
        return f"r{run}b{batch_id}-{uuid.uuid4().hex[:12]}"

    def write(self, output: str, rows: DataFrame, commit: str, run: int | None, batch_id: int | None,
              partitions: tuple[str, ...] = ("index_date",)) -> None:
        """Add rows to an output under a commit; with ``run`` None they keep the versions they have."""
        if run is not None:
            rows = rows.withColumns({"run": F.lit(run).cast("bigint"), "batch_id": F.lit(batch_id).cast("bigint")})
        rows.withColumn("commit", F.lit(commit)).write.mode("append").partitionBy(*partitions, "commit").parquet(f"{self.path}/{output}")

    def commit(self, commit: str, run: int, batch_id: int, replaces: list[str] = ()) -> None:
        attempt = len(self._entries(run, batch_id))
        entry = {"commit": commit, "run": run, "batch_id": batch_id, "attempt": attempt, "replaces": list(replaces)}
        self._put(f"_commits/{run}-{batch_id}-{attempt}", json.dumps(entry))

    def live(self) -> DataFrame:
        """The commits that count: the last attempt of each batch, without those that a compaction replaced."""
        try:
            entries = self.spark.read.schema(ENTRY).json(f"{self.path}/_commits")
        except AnalysisException:  # no batch yet
            entries = self.spark.createDataFrame([], ENTRY)
        last = entries.groupBy("run", "batch_id").agg(F.max_by(F.struct("commit", "attempt"), "attempt").alias("e")).select("e.commit")
        return last.join(entries.select(F.explode("replaces").alias("commit")), "commit", "left_anti")

    # -- rows ----------------------------------------------------------------
    def read(self, output: str, schema: StructType | str | None = None) -> DataFrame:
        """Rows of all live commits.  ``schema`` is that of the result while the output has no folder."""
        path = f"{self.path}/{output}"
        try:
            rows = self.spark.read.option("basePath", path).parquet(path)
        except AnalysisException:
            if schema is None:
                raise
            return self.spark.createDataFrame([], schema)
        return rows.join(self.live(), "commit", "left_semi")

    def compact(self, output: str, fold, partitions: tuple[str, ...]) -> None:
        """Put ``fold(rows)`` of the live commits in their place.

        ``fold`` keeps the version columns, so that rows of later batches go
        on replacing older ones.  The store must hold this output only.
        Batches committed meanwhile stay as they are.
        """
        commits = sorted(r.commit for r in self.live().collect())  # one for each batch since the last compaction
        if not commits:
            return
        path = f"{self.path}/{output}"
        rows = self.spark.read.option("basePath", path).parquet(path).where(F.col("commit").isin(commits))
        run, number = -1, len(self._names("_commits/-1-*"))  # compactions are a run of their own
        new = self.begin(run, number)
        self.write(output, fold(rows.drop("commit")), new, None, None, partitions)
        self.commit(new, run, number, commits)

    def _drop(self, output: str, gone) -> int:
        """Delete the folders of the commits that ``gone`` (a function of the id) names; returns how many."""
        names = [n for depth in ("*", "*/*", "*/*/*") for n in self._names(f"{output}/{depth}") if (c := n.rsplit("/", 1)[1]).startswith("commit=") and gone(c[7:])]
        for n in names:
            p, fs = self._at(n)
            fs.delete(p, True)
        return len(names)

    def sweep(self, output: str) -> int:
        """Delete the folders of commits that no longer count; returns how many.  Run it while no job writes."""
        live = {r.commit for r in self.live().collect()}
        return self._drop(output, lambda c: c not in live)

    def drop_earlier(self, output: str, commit: str, run: int, batch_id: int) -> None:
        """Delete what earlier attempts of a batch wrote."""
        if len(self._entries(run, batch_id)) > 1:
            self._drop(output, lambda c: c.startswith(f"r{run}b{batch_id}-") and c != commit)

    def days(self, output: str) -> dict[date, list[str]]:
        """The day folders of an output."""
        found: dict[date, list[str]] = {}
        for depth in ("index_date=*", "*/index_date=*"):
            for n in self._names(f"{output}/{depth}"):
                found.setdefault(date.fromisoformat(n.rsplit("index_date=", 1)[1]), []).append(n)
        return found

    def expire(self, output: str, as_of: date, days: int) -> list[date]:
        """Delete the days of an output that are more than ``days`` old; returns them."""
        old = {d: names for d, names in self.days(output).items() if as_of - d > timedelta(days=days)}
        for names in old.values():
            for n in names:
                p, fs = self._at(n)
                fs.delete(p, True)
        return sorted(old)
