"""Fitted models on shared storage: a versioned registry, and a store of fits that are made once.

``ModelRegistry`` keeps every deployed version in a folder of its own and publishes it by
one rename of a small entry (what it is, which input columns it needs).  The
entry with the highest number is the model in force: a writer that is lost
between the two steps leaves the former version in force, and readers never
see a half-written one.

``FitStore`` keeps fitted models by a digest of their training rows and
parameters, so that several reports on one fit share it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import ensure_checkpoint_dir
from churnlab.sources.ledger import Log, Moved

ENTRY = "version string, digest string, inputs string, info string"


class SchemaMismatch(ValueError):
    """Rows lack columns that the model needs, or have them with other types."""


def input_columns(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    return {n: df.schema[n].dataType.simpleString() for n in names}


def schema_digest(inputs: dict[str, str]) -> str:
    """Digest of the names and types of a model's input columns, in any order."""
    return hashlib.sha256(json.dumps(sorted(inputs.items())).encode()).hexdigest()


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    digest: str
    inputs: dict
    info: dict

    def check(self, df: DataFrame) -> None:
        """Raise :class:`SchemaMismatch` unless ``df`` has the input columns with their types."""
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        wrong = [f"{n}: needs {t}, has {types.get(n, 'no such column')}" for n, t in self.inputs.items() if types.get(n) != t]
        if wrong:
            raise SchemaMismatch(f"model version {self.number}: " + "; ".join(wrong))


class ModelRegistry(Log):
    """Deployed versions below ``root``; the last published one is in force."""

    def deploy(self, save: Callable[[str], object], inputs: dict[str, str], info: dict | None = None) -> Version:
        """``save`` writes the model's files below the path it is given; then the version is published."""
        name = uuid.uuid4().hex
        path = f"{self.root}/versions/{name}"
        save(path)
        row = (name, schema_digest(inputs), json.dumps(inputs, sort_keys=True), json.dumps(info or {}))
        while True:
            number = self._numbers()[0] + 1
            try:
                self._publish(self.spark.createDataFrame([row], ENTRY).coalesce(1), f"{number:012d}")
            except Moved:
                continue  # another version was published meanwhile; this one comes after it
            return self.version(number)

    def version(self, number: int) -> Version:
        r = self.spark.read.schema(ENTRY).parquet(f"{self.root}/log/{number:012d}").first()
        inputs = json.loads(r["inputs"])
        if schema_digest(inputs) != r["digest"]:
            raise SchemaMismatch(f"model version {number}: entry and digest differ")
        return Version(number, f"{self.root}/versions/{r['version']}", r["digest"], inputs, json.loads(r["info"]))

    def current(self) -> Version:
        """The version in force."""
        number = self._numbers()[0]
        if not number:
            raise LookupError(f"no model deployed below {self.root}")
        return self.version(number)

    def versions(self) -> DataFrame:
        """(number, digest, info) of every version published."""
        found = [self.version(n) for n in range(1, self._numbers()[0] + 1)]
        return self.spark.createDataFrame([(v.number, v.digest, json.dumps(v.info)) for v in found],
                                          "number int, digest string, info string")


# ------------------------------------------------------------------------ fits
def rows_digest(df: DataFrame) -> str:
    """A digest of a table's rows in any order: their number and the sums of two hashes of every row,
    beside the schema.  One aggregation, no shuffle of rows."""
    return digests_by(df.withColumn("_all", F.lit(0)), "_all").get(0, (0, "empty"))[1]


def digests_by(df: DataFrame, group_col: str) -> dict:
    """(rows, digest) of every value of ``group_col``, one of few (months): all digests in one pass."""
    cols = [F.col(f"`{c}`") for c in df.columns if c != group_col]
    hashes = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")).cast("string").alias(f"h{seed}") for seed in (1, 2)]
    found = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"), *hashes).collect()
    schema = df.drop(group_col).schema.simpleString()
    return {r[0]: (r["n"], hashlib.sha256(json.dumps([schema, r["n"], r["h1"], r["h2"]]).encode()).hexdigest()) for r in found}


class FitStore(Log):
    """Fits below ``root`` (default: below the shared checkpoint folder) by key."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        super().__init__(spark, root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/churnlab-fits")

    def path(self, *what) -> str:
        """Where the fit of ``what`` (digests, parameters: anything JSON can hold) lies or will lie."""
        key = hashlib.sha256(json.dumps([self.spark.version, *what], sort_keys=True, default=str).encode()).hexdigest()
        return f"{self.root}/fits/{key}"

    def has(self, path: str) -> bool:
        make, fs, _ = self._context()
        return fs.exists(make(path))

    def make(self, path: str, save: Callable[[str], object]) -> str:
        """``path``, after ``save`` has written a fit there, unless one is there: written aside and moved in one step."""
        if not self.has(path):
            staged = f"{self.root}/staged/{uuid.uuid4().hex}"
            save(staged)
            try:
                self._rename(staged, path)
            except Moved:
                pass  # made by another job meanwhile, from the same rows and parameters
        return path


