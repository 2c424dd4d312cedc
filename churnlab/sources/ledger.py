"""A table fed from files, with a ledger of the files that are in it.

A file is known by its path, length and modification time.  A commit adds a
part (a folder of rows) and the entries of the files that the part was made of.
The part is written first, under a name of its own; then the entries are written
beside the log and moved into it by one rename that fails if another commit
took the number.  Readers follow the log alone: a part without a commit is not
seen, a file in the log is not taken again.  Neither a lost stream checkpoint, nor
other micro-batches, nor a replayed one adds or loses a row.

``root/log/<number>`` holds entries; ``<number>.all`` holds all entries up to that
number and stands for them.  ``root/parts/part=<name>`` holds rows, tagged with
their file's ``_file``.  The log must be on a file system whose rename is atomic
(HDFS and local disks; plain object stores are not).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE = "_file"
#: What a file is known by.
PLACE = ("_path", "_length", "_modified")
#: Log entries after which a commit writes all entries anew.
LOG_RUN = 16


def place_columns() -> list[Column]:
    """What ``_file`` stands for, of a scan's rows: constant within a file, nothing is computed per row."""
    return [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_length"),
            F.col("_metadata.file_modification_time").alias("_modified")]


def file_key(path: Column, length: Column, modified: Column) -> Column:
    key = F.sha2(F.concat_ws("|", path, length.cast("string"), F.unix_micros(modified).cast("string")), 256)
    return F.substring(key, 1, 32).alias(FILE)


def file_columns() -> list[Column]:
    """``_file`` and what it stands for, of a scan's rows."""
    meta = [F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")]
    return [file_key(*meta), *place_columns()]


def latest(entries: DataFrame) -> DataFrame:
    """Of files rewritten under one path, the last."""
    newest = F.max_by(F.struct(*entries.columns), F.struct("_modified", FILE))
    return entries.groupBy(F.col("_path").alias("_p")).agg(newest.alias("e")).select("e.*")


class Moved(RuntimeError):
    """Another commit took the number."""


class Log:
    """Numbered entries below ``root/log``, each published by one rename that fails if the number is taken."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _context(self):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(self.root).toUri(), conf)

    def _numbers(self, up_to: int | None = None) -> tuple[int, int]:
        """The last number in the log (no further than ``up_to``), and that of the last ``.all`` (0 without)."""
        path, fs, _ = self._context()
        folder = path(f"{self.root}/log")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        names = [n for n in names if up_to is None or int(n.split(".")[0]) <= up_to]
        numbers = [int(n.split(".")[0]) for n in names]
        return max(numbers, default=0), max((int(n[:-4]) for n in names if n.endswith(".all")), default=0)

    def _rename(self, staged: str, target: str) -> None:
        """Move a folder to a place that must be free; :class:`Moved` if it is not."""
        path, fs, context = self._context()
        fs.mkdirs(path(target).getParent())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(path(staged), path(target), none)
        except Exception as e:  # py4j wraps the file system's exception
            if "FileAlreadyExists" in str(e):
                raise Moved(target) from e
            raise

    def _publish(self, entries: DataFrame, name: str) -> None:
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        entries.write.parquet(staged)
        self._rename(staged, f"{self.root}/log/{name}")


class Ledger(Log):
    """``extra`` names further columns of a file that the entries keep (its month, say)."""

    def __init__(self, spark: SparkSession, root: str, extra: Sequence[tuple[str, str]] = ()):
        super().__init__(spark, root)
        self.names = [FILE, "_path", "_length", "_modified", *(n for n, _ in extra)]
        self.entry = StructType.fromDDL(f"{FILE} string, _path string, _length bigint, _modified timestamp, " + "".join(
            f"{n} {t}, " for n, t in extra) + "part string")

    # ------------------------------------------------------------------ reading
    def entries(self) -> DataFrame:
        """One row per file in the table, with the part that holds its rows."""
        return self._entries(self._numbers()[0])

    def _entries(self, last: int) -> DataFrame:
        whole = self._numbers(last)[1]
        paths = [f"{self.root}/log/{whole:012d}.all"] if whole else []
        paths += [f"{self.root}/log/{n:012d}" for n in range(whole + 1, last + 1)]
        if not paths:
            return self.spark.createDataFrame([], self.entry)
        return self.spark.read.schema(self.entry).parquet(*paths)

    def rows(self, schema: StructType, live: Callable[[DataFrame], DataFrame] = latest) -> DataFrame:
        """The rows (of ``schema``, which has ``_file``) of the files that ``live`` picks of the entries."""
        return self._rows(schema, self.entries(), live)

    def _rows(self, schema: StructType, entries: DataFrame, live: Callable[[DataFrame], DataFrame]) -> DataFrame:
        parts = [r.part for r in entries.select("part").distinct().collect()]  # one per commit not yet compacted
        if not parts:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", f"{self.root}/parts")
        rows = read.parquet(*[f"{self.root}/parts/part={p}" for p in sorted(parts)]).select(*schema.names)
        picked = live(entries).select(F.col(FILE).alias("_live"))
        return rows.join(picked, F.col(FILE) == F.col("_live"), "left_semi")

    # ------------------------------------------------------------------ writing
    def add(self, batch: DataFrame, make: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = (),
            describe: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Commit the rows that ``make`` gives for the rows of ``batch`` whose files are not in yet.

        ``batch`` has the columns of an entry but ``part``; ``make`` must keep
        ``_file``.  With ``describe`` it has only ``PLACE`` of them, and ``describe``
        adds the others to a table of files: once per file, not per row.
        Returns the commit's number, 0 where every file was in.
        """
        while True:
            last, whole = self._numbers()
            known = self._entries(last).select(F.col(FILE).alias("_known"))
            files = describe(batch.select(*PLACE).distinct()) if describe else batch.select(*self.names).distinct()
            files = files.select(*self.names).join(known, F.col(FILE) == F.col("_known"), "left_anti")
            part = uuid.uuid4().hex
            # one small row per file; written first, so that a replay reads what this attempt saw
            staged = f"{self.root}/staged/{part}"
            files.select("*", F.lit(part).alias("part")).write.parquet(staged)
            files = self.spark.read.schema(self.entry).parquet(staged)
            if files.isEmpty():
                return 0
            if describe:
                fresh = batch.join(files.drop("part"), list(PLACE))
            else:
                fresh = batch.join(files.select(F.col(FILE).alias("_fresh")), F.col(FILE) == F.col("_fresh"), "left_semi")
            made = make(fresh)
            if FILE not in made.columns:
                raise ValueError(f"rows must keep {FILE}")
            made.write.partitionBy(*partition_by).parquet(f"{self.root}/parts/part={part}")
            try:
                self._publish(files, f"{last + 1:012d}")
            except Moved:
                continue
            if last + 1 - whole >= LOG_RUN:
                self._roll(last + 1)
            return last + 1

    def _roll(self, number: int) -> None:
        try:
            self._publish(self._entries(number).coalesce(1), f"{number:012d}.all")
        except Moved:
            pass  # someone else wrote the same entries

    def compact(self, schema: StructType, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                live: Callable[[DataFrame], DataFrame] = latest) -> int:
        """Write all rows that count as one part, in place of the parts before.

        A number is taken first, by a commit without files, so that a commit
        that comes meanwhile stands behind it.  Readers that started earlier
        still find the old parts; :meth:`unused` names them.  Entries of files
        whose rows do not count stay, so that those are not taken again.
        """
        while True:
            last, _ = self._numbers()
            if not last:
                return 0
            try:
                self._publish(self.spark.createDataFrame([], self.entry), f"{last + 1:012d}")
                break
            except Moved:
                continue
        part = uuid.uuid4().hex
        entries = self._entries(last)
        rows = self._rows(schema, entries, live)
        if sort_by:
            rows = rows.repartition(*sort_by).sortWithinPartitions(*sort_by)
        rows.write.partitionBy(*partition_by).parquet(f"{self.root}/parts/part={part}")
        try:
            self._publish(entries.withColumn("part", F.lit(part)), f"{last + 1:012d}.all")
        except Moved:
            pass  # the entries were written anew meanwhile; the old parts stay
        return last + 1

    def unused(self) -> list[str]:
        """Parts that no commit names: of attempts that failed, and from before the last compaction."""
        path, fs, _ = self._context()
        folder = path(f"{self.root}/parts")
        names = {s.getPath().getName().removeprefix("part=") for s in fs.listStatus(folder)} if fs.exists(folder) else set()
        return sorted(names - {r.part for r in self.entries().select("part").distinct().collect()})
