"""Versions of a table of months, each whole, with one atomic step from one to the next.

A commit writes the months it changes, whole, below a folder of its own (``commit=<id>/year=/month=``), and nothing that an
earlier version reads is touched. A version is one small file that names each month's commit, with the rows and files
counted in what was committed; the highest version is the current one, and renaming its finished file into place is
the step. A reader lists the folders that its version names, so between any two steps of a commit it sees the old table or the
new one. ``expire`` drops versions beyond the last few, then folders that no version left names.

A table that the batch job wrote (``year=/month=`` folders, no versions) is read as it is, and its months are
taken over by the first commit.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.sinks.files import Files

PERIOD = ("year", "month")
KEEP = 2                     # versions: a reader of the one before the current may still be at work
VERSIONS, INDEX = "_versions", "_index"      # Spark's own readers skip such folders
Month = tuple[int | None, int | None]


@dataclass
class Part:
    """A month of a version."""
    commit: str              # '' for a month of the batch job
    rows: int | None = None  # unknown until a commit counts them
    files: int | None = None
    blocks: int | None = None    # of its key filter, if it has one


@dataclass
class Version:
    number: int
    commit: str
    schema: str                                   # JSON
    months: dict[Month, Part] = field(default_factory=dict)
    written: str = ""

    def dump(self) -> str:
        months = [{"year": y, "month": m, **vars(p)} for (y, m), p in sorted(self.months.items(), key=str)]
        return json.dumps({**vars(self), "months": months})

    @classmethod
    def load(cls, text: str) -> Version:
        raw = json.loads(text)
        raw["months"] = {(x.pop("year"), x.pop("month")): Part(**x) for x in raw["months"]}
        return cls(**raw)

    @property
    def rows(self) -> int:
        return sum(p.rows or 0 for p in self.months.values())


def month_folder(base: str, month: Month) -> str:
    y, m = ("__HIVE_DEFAULT_PARTITION__" if x is None else x for x in month)
    return f"{base.rstrip('/')}/year={y}/month={m}"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    # --- versions ------------------------------------------------------------------------------------------------

    def _file(self, number: int) -> str:
        return f"{self.path}/{VERSIONS}/v{number:010d}.json"

    def numbers(self) -> list[int]:
        """Versions that can be read, oldest first."""
        folder = f"{self.path}/{VERSIONS}"
        names = self.files.names(folder) if self.files.exists(folder) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """The given version, or the current one; None if the table has none."""
        if number is None:
            numbers = self.numbers()
            return self.version(numbers[-1]) if numbers else self._plain()
        return Version.load(self.files.read_text(self._file(number)))

    def _plain(self) -> Version | None:
        """A batch job's table as version 0."""
        try:
            table = self.spark.read.parquet(self.path)
        except AnalysisException as e:   # the first batch
            if any(x in str(e) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
                return None
            raise
        months = table.select(*PERIOD).distinct().collect()      # bounded by the calendar, read from folder names
        return Version(0, "", table.drop(*PERIOD).schema.json(), {tuple(r): Part("") for r in months})

    # --- reading -------------------------------------------------------------------------------------------------

    def folder(self, month: Month, part: Part) -> str:
        return month_folder(f"{self.path}/commit={part.commit}" if part.commit else self.path, month)

    def read(self, version: int | None = None, months: Iterable[Month] | None = None) -> DataFrame | None:
        """A version's rows, or those of some months: only their folders are listed and scanned."""
        v = self.version(version)
        if v is None:
            return None
        wanted = v.months if months is None else {m: v.months[m] for m in set(months) if m in v.months}
        schema = T.StructType.fromJson(json.loads(v.schema))
        columns = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        out = None
        # folders with and without a commit have different partition columns, so each kind is a scan
        for kind in (False, True):
            folders = [self.folder(m, p) for m, p in sorted(wanted.items(), key=str) if bool(p.commit) == kind]
            if folders:
                own = T.StructType([*columns.fields, *([T.StructField("commit", T.StringType())] if kind else [])])
                rows = self.spark.read.schema(own).option("basePath", self.path).parquet(*folders).select(*columns.names)
                out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], columns) if out is None else out

    # --- committing ----------------------------------------------------------------------------------------------

    def done(self, commit: str) -> bool:
        """Whether a version of that commit was published."""
        versions = [self.version(n) for n in self.numbers()]
        return any(v.commit == commit for v in versions) or bool(versions) and any(p.commit == commit for p in versions[-1].months.values())

    def write(self, content: DataFrame, commit: str) -> dict[Month, Part]:
        """Write the new content of some months, whose rows are in few tasks, below the commit's folder, in place of what a lost try
        left there; the months that have rows, counted in the committed files."""
        target = f"{self.path}/commit={commit}"
        self.files.delete(target)
        content.write.partitionBy(*PERIOD).option("compression", "zstd").parquet(target)
        return self.counted(target, commit)

    def counted(self, target: str, commit: str) -> dict[Month, Part]:
        """Rows and files a month. Parquet keeps rows in its footers, so no column is read; what a task wrote that
        was run again isn't counted, as its files weren't committed."""
        if not any("=" in n for n in self.files.names(target)):
            return {}
        schema = T.StructType([T.StructField(c, T.IntegerType()) for c in PERIOD])
        rows = self.spark.read.schema(schema).parquet(target).groupBy(*PERIOD).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("_metadata.file_path").alias("files")).collect()
        return {(r["year"], r["month"]): Part(commit, r["n"], r["files"]) for r in rows}

    def publish(self, before: Version | None, commit: str, schema: T.StructType, changed: Iterable[Month],
                new: dict[Month, Part]) -> Version:
        """The next version: ``changed`` months leave, ``new`` ones come. Fails if another writer published meanwhile."""
        months = {m: p for m, p in (before.months if before else {}).items() if m not in set(changed)} | new
        body = T.StructType([f for f in schema.fields if f.name not in PERIOD])
        v = Version((before.number if before else 0) + 1, commit, body.json(), months,
                    _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"))
        target = self._file(v.number)
        if self.files.exists(target):
            raise RuntimeError(f"{target} is there: another writer was faster")
        staged = f"{self.path}/{VERSIONS}/.{uuid.uuid4().hex}"
        self.files.write_text(staged, v.dump())
        self.files.move(staged, target)
        return v

    def expire(self, keep: int = KEEP) -> None:
        """Drop all versions but the last ``keep``, and the folders that none of those names. Can be repeated at any time
        by the table's one writer."""
        numbers = self.numbers()
        if not numbers:
            return
        for n in numbers[:-keep]:
            self.files.delete(self._file(n))
        named = {self.folder(m, p) for n in numbers[-keep:] for m, p in self.version(n).months.items()}
        commits = {f.split("/commit=")[1].split("/")[0] for f in named if "/commit=" in f}
        for name in self.files.names(self.path):
            folder = f"{self.path}/{name}"
            if name.startswith("commit=") and name[7:] not in commits:
                self.files.delete(folder)
                self.files.delete(f"{self.path}/{INDEX}/{name}")
            elif name.startswith(("commit=", "year=")):
                base = folder if name.startswith("commit=") else self.path
                years = [n for n in self.files.names(folder) if n.startswith("year=")] if base == folder else [name]
                for year in years:
                    for month in self.files.names(f"{base}/{year}"):
                        if month.startswith("month=") and f"{base}/{year}/{month}" not in named:
                            self.files.delete(f"{base}/{year}/{month}")
