"""Tables as a series of snapshots: written aside, checked, then published in one step.

A table is a folder. ``data`` holds folders of Parquet files that are never changed,
``_log`` one small file per version that lists the folders it consists of. A version
exists once its log file is complete; the file is created only if there is none of
that number, which file systems with a consistent create-if-absent (HDFS, local, and
object stores with conditional writes) do atomically. So a write that fails, a check
that fails, or a second writer leaves the version at hand as it is, and a reader
keeps the version it began with until ``vacuum`` takes it away.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.functions import name as quoted_name
from innkeep.operators.quality import Expectation, run_suite
from innkeep.sources.tables import write_files


class QualityError(RuntimeError):
    """The staged rows break the suite; ``failed`` has expectation and column."""

    def __init__(self, failed: list[tuple[str, str]]):
        super().__init__(f"not published: {failed}")
        self.failed = failed


class ConflictError(RuntimeError):
    """Another writer has published in the meantime."""


@dataclass(frozen=True)
class Part:
    """A folder below ``data``, its rows and its schema."""

    folder: str
    rows: int
    schema: str


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[str, Part]
    schema: str
    transactions: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files, through the session's own file systems --

    def _path(self, *below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *below]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _listed(self, *below: str) -> list:
        files, path = self._files(), self._path(*below)
        return list(files.listStatus(path)) if files.exists(path) else []

    # -- the log --

    def _numbers(self) -> list[int]:
        names = [s.getPath().getName() for s in self._listed("_log")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """The version of a number, or the newest; None where there is none."""
        numbers = [number] if number is not None else reversed(self._numbers())
        for n in numbers:
            stream = self._files().open(self._path("_log", f"{n:020d}.json"))
            try:
                said = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                found = json.loads(said)
            except json.JSONDecodeError:  # its writer was lost while it wrote
                continue
            parts = {k: Part(**p) for k, p in found["parts"].items()}
            return Version(n, parts, found["schema"], found["transactions"])
        return None

    def _commit(self, version: Version) -> None:
        entry = json.dumps({
            "parts": {k: vars(p) for k, p in version.parts.items()},
            "schema": version.schema, "transactions": version.transactions,
        })
        try:
            out = self._files().create(self._path("_log", f"{version.number:020d}.json"), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                raise ConflictError(f"{self.root}: version {version.number} is there already") from None
            raise
        try:
            out.write(bytearray(entry.encode("utf-8")))
        finally:
            out.close()

    # -- writing --

    def stage(self, df: DataFrame, partition_by: Sequence[str] = (), dealt: bool = False) -> Part:
        """Write the rows aside; nobody reads them yet. ``dealt`` as in ``write_files``."""
        folder = uuid.uuid4().hex
        rows = write_files(df, f"{self.root}/data/{folder}", partition_by, dealt)
        return Part(folder, rows, df.schema.json())

    def staged(self, part: Part) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(part.schema))
        return self.spark.read.schema(schema).parquet(f"{self.root}/data/{part.folder}")

    def publish(
        self,
        parts: dict[str, Part],
        schema: T.StructType,
        suite: Sequence[Expectation] = (),
        after: Version | None = None,
        transaction: tuple[str, int] | None = None,
    ) -> Version:
        """Check what the parts hold and make them the newest version.

        ``after`` is the version they were made from: if there is a newer one by now,
        nothing happens but a ``ConflictError``. ``transaction`` is a name and number
        that ``done`` finds again. The suite runs on the written files.
        """
        made = Version(
            self._next(after), parts, schema.json(),
            {**(after.transactions if after else {}), **(dict([transaction]) if transaction else {})},
        )
        if suite:
            results = run_suite(self._of(made), suite).where("not success").collect()
            if results:
                raise QualityError([(r["expectation"], r["column_name"]) for r in results])
        newest = self.version()
        if (newest.number if newest else None) != (after.number if after else None):
            raise ConflictError(f"{self.root}: there is a newer version than the one this was made from")
        self._commit(made)
        return made

    def _next(self, after: Version | None) -> int:
        """The number after ``after``, over log files that were never completed."""
        dead = [n for n in self._numbers() if after is None or n > after.number]
        return max([after.number if after else 0, *dead]) + 1

    def write(
        self, df: DataFrame, suite: Sequence[Expectation] = (), partition_by: Sequence[str] = (),
        transaction: tuple[str, int] | None = None,
    ) -> Version:
        """Replace the table: write, audit, publish."""
        before = self.version()
        return self.publish({"all": self.stage(df, partition_by)}, df.schema, suite, before, transaction)

    def done(self, transaction: tuple[str, int]) -> bool:
        """Whether the transaction, or a later one of its name, has been published."""
        newest = self.version()
        return newest is not None and newest.transactions.get(transaction[0], -1) >= transaction[1]

    # -- reading --

    def read(self, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The newest version, or that of a number; on request some of its parts only."""
        found = self.version(number)
        if found is None:
            raise FileNotFoundError(f"{self.root} has no version")
        return self._of(found, parts)

    def _of(self, version: Version, parts: Sequence[str] | None = None) -> DataFrame:
        wanted = version.struct()
        groups: dict[str, list[str]] = {}  # folders by schema: one scan each
        for key, part in version.parts.items():
            if parts is None or key in parts:
                groups.setdefault(part.schema, []).append(f"{self.root}/data/{part.folder}")
        frames = []
        for schema, folders in groups.items():
            have = T.StructType.fromJson(json.loads(schema))
            rows = self.spark.read.schema(have).parquet(*folders)
            # A part written before a column came or grew wider is read as if it had been written now.
            frames.append(rows if have == wanted else rows.selectExpr(*[
                f"cast({quoted_name(f.name) if f.name in have.names else 'null'} as {f.dataType.simpleString()}) as {quoted_name(f.name)}"
                for f in wanted
            ]))
        if not frames:
            return self.spark.createDataFrame([], wanted)
        return reduce(DataFrame.union, frames)

    def as_view(self, view: str) -> None:
        """Let SQL read the newest version by a name; replacing a view is one step too."""
        folders = ", ".join(p.folder for p in self.version().parts.values())
        if "," in folders:
            raise ValueError("a view is for tables of one part")
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{self.root}/data/{folders}`")

    def vacuum(self, keep: int = 2, older_than: float = 24 * 3600.0) -> int:
        """Delete folders that none of the newest ``keep`` versions has and that have been
        there for ``older_than`` seconds, so that nothing is taken from a writer at work."""
        kept = {p.folder.split("/")[0] for n in self._numbers()[-keep:] if (v := self.version(n)) for p in v.parts.values()}
        limit, gone = (time.time() - older_than) * 1000, 0
        for found in self._listed("data"):
            if found.getPath().getName() not in kept and found.getModificationTime() <= limit:
                self._files().delete(found.getPath(), True)
                gone += 1
        return gone


def rows_of(version: Version | None) -> int:
    return version.rows if version else 0


def publish_table(
    spark: SparkSession, df: DataFrame, root: str, suite: Sequence[Expectation], view: str | None = None,
) -> Version:
    """Write, audit and publish a whole table; on request as a view that SQL can read."""
    table = Snapshots(spark, root)
    made = table.write(df, suite)
    if view:
        table.as_view(view)
    return made
