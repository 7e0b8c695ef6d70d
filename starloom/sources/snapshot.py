"""Published tables: count-verified snapshots, appends and rewritten buckets.

A table is a folder with increments below ``data`` and one file per version below
``versions``.  An increment is a folder of Parquet files that is written, counted and
compared with the table's columns first.  The version file then names every part
the table consists of: whole increments, or single hash buckets of them.  So a
version that rewrites a few buckets names the others where they lie.

A version file is created only if nobody has created that version, and appears
as a whole.  Of two writers one gets the number; the other looks at what the
table has become, and goes on only if its rows do not depend on what was there
(``since``).  Readers open the parts of the latest version, so they see complete
loads only, and a failed load leaves the table as it was.

Each part's rows, largest key and range of ids stand in the version file, so a
search for ids opens the parts that can hold them and no others.  Many small
increments are folded into one of the next size, which keeps the list of parts short
(about ``FOLD`` for each power of ``FOLD`` of rows).  ``expire`` removes what no
kept version names.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import known_size, local_rows, rows_of

_PART, _BUCKET = "increment", "_bucket"

#: small increments that are folded into one
FOLD = 8
#: rows a bucket is made for, and the most buckets of a table
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 4_096


class PublishError(RuntimeError):
    """A snapshot does not hold the rows it should; the table is unchanged."""


class ConflictError(PublishError):
    """Another writer was first; load again from the table as it is now."""


@dataclass(frozen=True)
class Part:
    """An increment, or one bucket of it."""

    name: str
    bucket: int | None
    rows: int
    top: int | None = None
    low: int | None = None
    high: int | None = None


@dataclass(frozen=True)
class Version:
    """``at`` is in milliseconds since 1970; ``note`` is for the writer's own use."""

    version: int
    at: int
    rows: int
    top: int | None
    buckets: int | None
    schema: str
    parts: list[Part]
    note: dict = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class SnapshotTable:
    """``key`` names a column whose largest value the log keeps, ``ids`` one whose range it keeps for each part.

    A table with ``bucket_by`` lies in hash buckets of that column; ``partition_by``
    names the columns that get a folder per value.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_by: Sequence[str] = (),
        key: str | None = None,
        ids: str | None = None,
        bucket_by: str | None = None,
        bucket_rows: int = BUCKET_ROWS,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self.key = key
        self.ids = ids
        self.bucket_by = bucket_by
        self.bucket_rows = bucket_rows
        #: the version this object published, and the frame it was made from, whose notes hold for it
        self._made: tuple[int, DataFrame] | None = None

    # --- the log ---

    @property
    def _jvm(self):
        return self.spark.sparkContext._jvm

    def _at(self, path: str):
        """(file system, path object) of a path."""
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _numbers(self) -> list[int]:
        files, folder = self._at(f"{self.root}/versions")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))

    def _file(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _load(self, version: int) -> Version:
        files, path = self._at(self._file(version))
        stream = files.open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        return Version(**{**entry, "parts": [Part(*p) for p in entry["parts"]]})

    def _latest(self) -> Version | None:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    def _create(self, entry: Version) -> bool:
        """Create the version's file as a whole; False if the version is there already."""
        text = json.dumps({**asdict(entry), "parts": [list(asdict(p).values()) for p in entry.parts]})
        files, draft = self._at(f"{self.root}/versions/.{uuid.uuid4().hex}")
        files.mkdirs(draft.getParent())
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, target = self._at(self._file(entry.version))
        try:
            if files.getScheme() == "file":
                # renaming replaces on local disks, a link to an existing name fails
                paths = [self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
                self._jvm.java.nio.file.Files.createLink(*paths)
            else:
                kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
                never = self.spark.sparkContext._gateway.new_array(kind, 1)
                never[0] = kind.NONE
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
                ).rename(draft, target, never)
            return True
        except Py4JJavaError as failed:
            if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
                raise
            return False
        finally:
            files.delete(draft, False)

    def _commit(
        self, change: Callable[[Version | None], tuple[str, int | None, list[Part]]],
        since: int | None, note: dict | None,
    ) -> Version:
        """Log what ``change`` makes of the latest version, which must be ``since`` if that is given."""
        while True:
            latest = self._latest()
            before = latest.version if latest else 0
            if since is not None and before != since:
                raise ConflictError(f"{self.root}: version {before} came after {since}")
            schema, buckets, parts = change(latest)
            tops = [p.top for p in parts if p.top is not None]
            entry = Version(
                version=before + 1, at=time.time_ns() // 1_000_000, rows=sum(p.rows for p in parts),
                top=max(tops, default=None), buckets=buckets, schema=schema, parts=parts,
                note=(latest.note if latest else {}) if note is None else note,
            )
            if self._create(entry):
                return entry

    def versions(self) -> DataFrame:
        """The log: ``version``, ``at``, ``rows``, ``top``."""
        return self.spark.read.schema("version long, at long, rows long, top long").json(f"{self.root}/versions")

    def version(self) -> int:
        """The latest version, 0 if there is none."""
        return (self._numbers() or [0])[-1]

    def exists(self) -> bool:
        return bool(self._numbers())

    def rows(self) -> int:
        """How many rows the table has, from the log."""
        latest = self._latest()
        return latest.rows if latest else 0

    def top(self) -> int:
        """The largest ``key``, from the log; 0 if there is none."""
        latest = self._latest()
        return (latest.top or 0) if latest else 0

    def note(self) -> dict:
        """What the latest writer noted."""
        latest = self._latest()
        return latest.note if latest else {}

    # --- reading ---

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as published, under the schema it was published with; only ``buckets`` of it, if given."""
        if version is None:
            latest = self._latest()
            if latest is None:
                raise FileNotFoundError(f"nothing published at {self.root}")
        else:
            latest = self._load(version)
        parts = latest.parts
        if buckets is not None:
            wanted = set(buckets)
            parts = [p for p in parts if p.bucket in wanted]
        opened = self._open(parts, latest.struct)
        return rows_of(self._made[1], opened) if self._made and self._made[0] == latest.version else opened

    def _open(self, parts: Sequence[Part], schema: T.StructType, with_bucket: bool = False) -> DataFrame:
        columns = [f"`{f.name}`" for f in schema.fields] + [_BUCKET] * with_bucket
        if not parts:
            return local_rows(self.spark, [], schema)
        base = f"{self.root}/data"
        paths = [
            f"{base}/{_PART}={p.name}" + ("" if p.bucket is None else f"/{_BUCKET}={p.bucket}") for p in parts
        ]
        if with_bucket or parts[0].bucket is not None:
            schema = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*columns)

    def holding(self, wanted: DataFrame, column: str) -> DataFrame | None:
        """The table's values of ``column`` (= ``ids``) that can be among ``wanted``; None if there can be none.

        Of each part only the values between the least and the largest wanted
        one in its range are read; a part whose range has none is not opened.
        The bounds are one aggregate row over ``wanted``.
        """
        latest = self._latest()
        parts = [p for p in latest.parts if p.low is not None] if latest else []
        found: list[DataFrame] = []
        for some in (parts[i : i + 500] for i in range(0, len(parts), 500)):
            inside = [F.when(F.col(column).between(p.low, p.high), F.col(column)) for p in some]
            bounds = wanted.agg(F.array(*[F.struct(F.min(c).alias("a"), F.max(c).alias("b")) for c in inside])).first()[0]
            for part, (low, high) in zip(some, bounds):
                if low is not None:
                    found.append(self._open([part], latest.struct).select(column).where(F.col(column).between(low, high)))
        return reduce(DataFrame.unionByName, found) if found else None

    def bucket_of(self, column: str) -> Column:
        """The bucket of a value of ``bucket_by`` in the latest version."""
        latest = self._latest()
        kind = next(f.dataType for f in latest.struct.fields if f.name == self.bucket_by)
        return F.pmod(F.xxhash64(F.col(column).cast(kind)), F.lit(latest.buckets)).cast("int")

    # --- writing ---

    def _write(self, df: DataFrame, buckets: int | None, spread: bool = True) -> list[Part]:
        """Write an increment; its parts as they were read back."""
        name, schema = uuid.uuid4().hex, df.schema
        folders = list(self.partition_by)
        if buckets is not None:
            df = df.withColumn(_BUCKET, F.pmod(F.xxhash64(self.bucket_by), F.lit(buckets)).cast("int"))
            folders = [_BUCKET, *folders]
        if folders and spread:
            # even files per folder; one with most of the rows is split
            df = df.hint("rebalance", *folders)
        if self.ids:
            # narrow ranges per file and row group, for searches by id
            df = df.sortWithinPartitions(*folders, self.ids)
        df.write.partitionBy(*folders).parquet(f"{self.root}/data/{_PART}={name}")
        measures = [
            F.count("*"),
            *[f(c).cast("bigint") if c else F.lit(None).cast("bigint")
              for f, c in ((F.max, self.key), (F.min, self.ids), (F.max, self.ids))],
        ]
        if buckets is None:
            whole = self._open([Part(name, None, 0)], schema)
            return [Part(name, None, *whole.agg(*measures).first())]
        whole = self._open([Part(name, None, 0)], schema, with_bucket=True)
        return [Part(name, *r) for r in whole.groupBy(_BUCKET).agg(*measures).collect()]

    def _discard(self, parts: Sequence[Part]) -> None:
        for name in {p.name for p in parts}:
            files, path = self._at(f"{self.root}/data/{_PART}={name}")
            files.delete(path, True)

    def _checked(self, parts: list[Part], expected_rows: int | None) -> list[Part]:
        rows = sum(p.rows for p in parts)
        if expected_rows is not None and rows != expected_rows:
            self._discard(parts)
            raise PublishError(f"{self.root}: wrote {rows} rows, expected {expected_rows}")
        return parts

    def _logged(self, written: list[Part], change, since: int | None, note: dict | None) -> Version:
        try:
            return self._commit(change, since, note)
        except PublishError:
            self._discard(written)
            raise

    def publish(
        self, df: DataFrame, expected_rows: int | None = None, since: int | None = None, note: dict | None = None,
        spread: bool = True,
    ) -> DataFrame:
        """Write a new snapshot, verify its row count, make it the table; ``spread`` is as in ``append``."""
        buckets = None
        if self.bucket_by:
            rows = expected_rows if expected_rows is not None else known_size(df)[0] if known_size(df) else df.count()
            buckets = min(max(math.ceil(rows / self.bucket_rows), 1), MOST_BUCKETS)
        parts = self._checked(self._write(df, buckets, spread), expected_rows)
        schema = df.schema.json()
        done = self._logged(parts, lambda latest: (schema, buckets, parts), since, note)
        self._made = done.version, df
        return rows_of(df, self._open(done.parts, df.schema))

    def append(
        self, df: DataFrame, since: int | None = None, note: dict | None = None, spread: bool = True
    ) -> int:
        """Add rows with the table's columns; returns how many.

        Rows that lie in partitions of even size by ranges of ``ids`` need not be
        ``spread`` by folder first: each partition then writes a file per folder it has rows of.

        Columns are matched by name and must have the table's types.  Where the
        rows depend on what the table held (no id twice, keys that go on),
        ``since`` is the version they were made from: if there is another by
        now, nothing is added and ``ConflictError`` says so.
        """
        latest = self._latest()
        if latest is None:
            if since:
                raise ConflictError(f"{self.root}: version {since} is gone")
            return self.publish(df, since=since, note=note, spread=spread).count()
        kinds = {f.name: f.dataType for f in latest.struct.fields}
        if {f.name: f.dataType for f in df.schema.fields} != kinds or len(df.columns) != len(kinds):
            raise PublishError(f"{self.root}: the columns are {df.dtypes}, not those of the table")
        parts = self._write(df.select(*[f"`{c}`" for c in kinds]), latest.buckets, spread)
        rows = sum(p.rows for p in parts)
        if not rows:
            self._discard(parts)
            return 0

        def added(now: Version):
            if (now.schema, now.buckets) != (latest.schema, latest.buckets):
                raise ConflictError(f"{self.root}: the table was made anew")
            return now.schema, now.buckets, [*now.parts, *parts]

        self._logged(parts, added, since, note)
        if latest.buckets is None:
            self.fold()
        return rows

    def replace(
        self, buckets: Sequence[int], df: DataFrame, since: int, expected_rows: int | None = None,
        note: dict | None = None,
    ) -> None:
        """Put ``df`` in place of all rows of ``buckets``; the other buckets stay where they lie."""
        latest = self._load(since)
        parts = self._checked(self._write(df.select(*[f"`{f.name}`" for f in latest.struct.fields]), latest.buckets), expected_rows)
        gone = set(buckets)
        if not {p.bucket for p in parts} <= gone:
            self._discard(parts)
            raise PublishError(f"{self.root}: rows of other buckets than {sorted(gone)}")
        kept = [p for p in latest.parts if p.bucket not in gone]
        self._logged(parts, lambda now: (now.schema, now.buckets, [*kept, *parts]), since, note)

    def fold(self) -> None:
        """Write increments of one size as one, where there are ``FOLD`` of them or more."""
        latest = self._latest()
        sizes: dict[int, list[Part]] = {}
        for part in latest.parts:
            sizes.setdefault(int(math.log(part.rows + 1, FOLD)), []).append(part)
        for _, small in sorted(sizes.items()):
            if len(small) < FOLD:
                continue
            rows = sum(p.rows for p in small)
            parts = self._checked(self._write(self._open(small, latest.struct), None), rows)
            gone = {p.name for p in small}

            def folded(now: Version):
                if not gone <= {p.name for p in now.parts}:
                    raise ConflictError(f"{self.root}: what was folded is not in the table any more")
                return now.schema, now.buckets, [*[p for p in now.parts if p.name not in gone], *parts]

            try:
                self._logged(parts, folded, None, None)
            except ConflictError:
                return  # the table is right as it is
            return

    def expire(self, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=7)) -> tuple[int, int]:
        """Remove old versions, and increments that no kept version names; how many of each.

        The last ``keep`` versions are kept, and those that were the latest at
        any time since ``older_than`` ago.  Increments younger than that stay
        too, as a load may be about to log them: it must not take longer.
        """
        cutoff = time.time_ns() // 1_000_000 - int(older_than.total_seconds() * 1000)
        numbers = self._numbers()
        if not numbers:
            return 0, 0
        entries = [self._load(n) for n in numbers]
        ended = [e.at for e in entries[1:]]
        gone = [e for e, until in zip(entries[: len(entries) - max(keep, 1)], ended) if until < cutoff]
        kept = {p.name for e in entries[len(gone) :] for p in e.parts}
        for entry in gone:
            files, path = self._at(self._file(entry.version))
            files.delete(path, False)
        files, folder = self._at(f"{self.root}/data")
        removed = 0
        for status in files.listStatus(folder):
            if status.getPath().getName().removeprefix(f"{_PART}=") in kept:
                continue
            within = [s.getModificationTime() for s in files.listStatus(status.getPath())]
            if max([status.getModificationTime(), *within]) < cutoff:
                files.delete(status.getPath(), True)
                removed += 1
        return len(gone), removed
