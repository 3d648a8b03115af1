"""Two Parquet table layouts written with plain Spark writers. One writer per table at a time.

``SnapshotTable``   every commit is a whole new ``v=<n>`` folder, which counts once Spark's ``_SUCCESS`` marker is in it.
``MappedTable``     a load writes the partitions it touches once, to a folder of its own,
                    ``load=<n>/<partition>=<value>``, which never changes again, and then one small file, ``maps/<n>``: which
                    load holds each partition from now on. A read opens the newest map and nothing older.

Its partitions are the days or months of a day column (``PartitionedTable``) or the hash buckets of a key
(``BucketedTable``). A publish is one file, nothing is renamed, a failed attempt is never read and simply written
again, and older commits give time travel until maintenance removes them with all that only they need.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Callable, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakemart.functions.casts import quoted
from lakemart.operators.projection import writable
from lakemart.operators.upkeep import (
    SMALL_FILE_BYTES, TARGET_FILE_BYTES, clustered, compaction_plan, expired_versions,
)
from lakemart.operators.quality import require_unique
from lakemart.operators.upsert import merge_rows, reload_rows
from lakemart.operators.windows import scan_window, window_start
from lakemart.sources.files import Files, file_listing, staged

DONE = "_SUCCESS"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Hash buckets of a table at most.
MOST_BUCKETS = 256


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.files = Files(spark, self.path)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def versions(self) -> list[tuple[int, dt.datetime]]:
        """(version, commit time in UTC) of every committed version, oldest first."""
        found = []
        for name, is_directory in self.files.children(self.path):
            if not (is_directory and name.startswith("v=")):
                continue
            marker = self.files.modified_ms(f"{self.path}/{name}/{DONE}")
            if marker is not None:
                found.append((int(name[2:]), dt.datetime.fromtimestamp(marker / 1000, dt.timezone.utc)))
        return sorted(found)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        committed = [number for number, _ in self.versions()]
        number = version if version is not None else (committed[-1] if committed else None)
        if number not in committed:
            raise FileNotFoundError(f"{self.path} has no version {number}")
        return self.spark.read.parquet(self._folder(number))

    def read_as_of(self, moment: dt.datetime) -> DataFrame:
        """The table as it was at ``moment``."""
        past = [number for number, committed in self.versions() if committed <= moment]
        if not past:
            raise FileNotFoundError(f"{self.path} has no version at {moment}")
        return self.read(past[-1])

    def overwrite(self, df: DataFrame) -> int:
        """Replace the content; the schema may differ from the previous version's."""
        committed = self.versions()
        version = committed[-1][0] + 1 if committed else 0
        writable(df).write.mode("overwrite").parquet(self._folder(version))
        return version

    def merge(self, source: DataFrame, keys: Sequence[str], keep_where_null: Sequence[str] = ()) -> int | None:
        """Upsert by key. The source is computed once; keys it holds twice are refused, and an empty one
        changes nothing. Columns of ``keep_where_null`` keep their value where the source has none."""
        with staged(writable(source)) as rows:
            if rows.isEmpty():
                return None
            require_unique(rows, keys)
            return self.overwrite(merge_rows(self.read() if self.exists() else None, rows, keys, keep_where_null))

    def version_listing(self) -> DataFrame:
        return self.spark.createDataFrame(self.versions(), "version bigint, committed_at timestamp")

    def expire(self, retention_hours: int, now: dt.datetime | None = None) -> list[int]:
        """Delete the versions only needed to read states older than the retention."""
        moment = now or dt.datetime.now(dt.timezone.utc)
        old = expired_versions(self.version_listing(), moment, retention_hours).select("version").collect()
        gone = sorted(row["version"] for row in old)
        for number in gone:
            self.files.delete(self._folder(number))
        return gone

    def compact(
        self, small_bytes: int = SMALL_FILE_BYTES, target_bytes: int = TARGET_FILE_BYTES
    ) -> int | None:
        """Write a new version with fewer files when the current one has too many small ones."""
        committed = self.versions()
        if not committed:
            return None
        listing = file_listing(self.spark, self._folder(committed[-1][0])).withColumn("folder", F.lit(""))
        plan = compaction_plan(listing, ["folder"], small_bytes=small_bytes, target_bytes=target_bytes).first()
        if plan is None:
            return None
        version = committed[-1][0] + 1
        current = self.read()
        current.coalesce(plan["files_after"]).write.mode("overwrite").parquet(self._folder(version))
        return version

    def cluster(self, columns: Sequence[str], target_bytes: int = TARGET_FILE_BYTES, row_group_bytes: int | None = None) -> int:
        """Write a new version in the order of ``clustered``, so that filters on any of the columns skip row groups."""
        version, size = self.versions()[-1][0] + 1, self.files.size(self._folder(self.versions()[-1][0]))
        written = clustered(self.read(), columns, max(1, math.ceil(size / target_bytes))).write.mode("overwrite")
        if row_group_bytes:
            written = written.option("parquet.block.size", row_group_bytes)
        written.parquet(self._folder(version))
        return version


class MappedTable:
    """Partitions by one column, ``derived`` from the others unless it is one of them."""

    LOAD, MAPS = "load", "maps"

    def __init__(self, spark: SparkSession, path: str, partition: str, kind: T.DataType, derived: bool):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition = partition
        self.kind = kind
        self.derived = derived
        self.files = Files(spark, self.path)

    # -- what is visible --

    def _map(self, number: int) -> dict | None:
        """schema, held (partition folder -> load) and what the writer noted; None where the file is not whole."""
        try:
            return json.loads(self.files.text(f"{self.path}/{self.MAPS}/{number}"))
        except json.JSONDecodeError:
            return None

    def loads(self) -> list[tuple[int, dt.datetime]]:
        """(number, commit time in UTC) of every committed load that is still there, oldest first."""
        found = sorted((int(name), dt.datetime.fromtimestamp(moment / 1000, dt.timezone.utc))
                       for name, moment in self.files.modified(f"{self.path}/{self.MAPS}"))
        # A broken map has the number of the next load, so only the newest can be one.
        return found[:-1] if found and self._map(found[-1][0]) is None else found

    def _newest(self) -> tuple[int, dict | None]:
        numbers = sorted(int(name) for name, _ in self.files.modified(f"{self.path}/{self.MAPS}"))
        for number in reversed(numbers[-2:]):
            if (state := self._map(number)) is not None:
                return number, state
        return -1, None

    def exists(self) -> bool:
        """Whether the table can be read: a load has been committed."""
        return self._newest()[1] is not None

    def _value(self, folder: str):
        text = folder.split("=", 1)[1]
        if text == NULL_PARTITION:
            return None
        return int(text) if isinstance(self.kind, T.IntegerType) else dt.date.fromisoformat(text)

    def _folder(self, value) -> str:
        return f"{self.partition}={NULL_PARTITION if value is None else value}"

    def _partitions(self) -> list:
        """The values of the partitions that hold rows, without null."""
        held = (self._newest()[1] or {"held": {}})["held"]
        return sorted(value for value in map(self._value, held) if value is not None)

    def _rows(self, number: int | None = None, only: Callable[[object], bool] | None = None) -> DataFrame:
        """The rows of the newest load, or of an older one; ``only`` says which partitions are looked at, the null one aside."""
        state = self._newest()[1] if number is None else self._map(number)
        if state is None:
            raise FileNotFoundError(f"{self.path} has no load")
        schema = T.StructType([*T.StructType.fromJson(state["schema"]).fields, T.StructField(self.partition, self.kind)])
        paths = [f"{self.path}/{self.LOAD}={load}/{folder}" for folder, load in sorted(state["held"].items())
                 if only is None or only(self._value(folder))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(
            *[F.col(quoted(name)) for name in schema.fieldNames()])

    def _in(self, values: list) -> DataFrame:
        """The rows of these partitions; no file of another one is opened or listed."""
        return self._rows(only=set(values).__contains__)

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.drop(self.partition) if self.derived else rows

    def read(self) -> DataFrame:
        return self._plain(self._rows())

    def read_as_of(self, moment: dt.datetime) -> DataFrame:
        """The table as it was at ``moment``."""
        past = [number for number, committed in self.loads() if committed <= moment]
        if not past:
            raise FileNotFoundError(f"{self.path} has no load at {moment}")
        return self._plain(self._rows(past[-1]))

    # -- writing --

    def _with_partition(self, df: DataFrame) -> DataFrame:
        return df

    def _touched(self, rows: DataFrame) -> list:
        """Partition values of ``rows``: as many as there are partitions, whatever the row count."""
        return [row[0] for row in rows.select(quoted(self.partition)).distinct().collect()]

    def _publish(self, rows: DataFrame, touched: list, rebalance: bool = True, **notes) -> None:
        """Make ``rows`` the whole content of the touched partitions, as one new load.

        Few files per partition: AQE splits a hot partition and joins small ones. ``notes`` stay in the maps from here on.
        """
        newest, state = self._newest()
        number, state = newest + 1, state or {"held": {}}
        folder = f"{self.path}/{self.LOAD}={number}"
        spread = rows.hint("rebalance", F.col(quoted(self.partition))) if rebalance else rows
        spread.write.mode("overwrite").partitionBy(self.partition).parquet(folder)
        left = {name: load for name, load in state["held"].items() if name not in set(map(self._folder, touched))}
        written = {name: number for name, is_directory in self.files.children(folder)
                   if is_directory and name.startswith(f"{self.partition}=")}
        schema = json.loads(rows.drop(self.partition).schema.json())
        self.files.put(f"{self.path}/{self.MAPS}/{number}", json.dumps({**state, "schema": schema, **notes, "held": {**left, **written}}))

    def _source(self, source: DataFrame, computed: bool):
        """The source with its partition column, written out first when computing it is costly."""
        rows = self._with_partition(writable(source))
        return staged(rows) if computed else nullcontext(rows)

    def _found(self, rows: DataFrame, keys: Sequence[str], touched: list) -> list:
        """More partitions with rows of the keys, besides those the source's own rows are in."""
        return []

    def merge(
        self, source: DataFrame, keys: Sequence[str], keep_where_null: Sequence[str] = (), computed: bool = True,
        batch: tuple[str, int] | None = None, unique: bool = False, laid_out: bool = False,
    ) -> None:
        """Upsert by key, rewriting only the partitions that gain or lose a row.

        Pass ``computed=False`` for a source that is a plain scan: it is then read several times instead of
        copied. Keys that the source holds twice are refused, unless it is known to hold each once
        (``unique``); an empty source changes nothing. Columns of
        ``keep_where_null`` keep their value where the source has none. A ``batch`` (stream, number) that the table has
        taken in already is left out: a stream that repeats it after a failure adds no load. A source whose files each hold one
        partition (``laid_out``), as those of a table of the same layout do, is written as it lies where there is nothing to merge with.
        """
        notes = {}
        if batch is not None:
            taken = (self._newest()[1] or {}).get("batches", {})
            if batch[1] <= taken.get(batch[0], -1):
                return
            notes["batches"] = {**taken, batch[0]: batch[1]}
        with self._source(source, computed) as rows:
            touched = self._touched(rows)
            if not touched:
                return
            if not unique:
                require_unique(rows, keys)
            current = None
            if self.exists():
                touched = list({*touched, *self._found(rows, keys, touched)})
                current = self._in(touched)
            merged = merge_rows(current, rows, keys, keep_where_null, scanned=True)
            self._publish(merged, touched, rebalance=current is not None or not laid_out, **notes)

    # -- maintenance --

    def compact(self, small_bytes: int = SMALL_FILE_BYTES, target_bytes: int = TARGET_FILE_BYTES) -> int:
        """Rewrite the partitions with many small files; returns how many."""
        held = (self._newest()[1] or {"held": {}})["held"]
        if not held:
            return 0
        listing = file_listing(self.spark, *[f"{self.path}/{self.LOAD}={load}/{folder}" for folder, load in held.items()])
        small = compaction_plan(listing.withColumn("folder", F.element_at(F.split("path", "/"), -2)), ["folder"],
                                small_bytes=small_bytes, target_bytes=target_bytes)
        values = [self._value(row["folder"]) for row in small.select("folder").collect()]
        if values:
            self._publish(self._in(values), values)
        return len(values)

    def expire(self, retention_hours: int, now: dt.datetime | None = None) -> list[str]:
        """Delete the maps that no state of the retention needs, and every folder that only they name."""
        cutoff = (now or dt.datetime.now(dt.timezone.utc)) - dt.timedelta(hours=retention_hours)
        loads = self.loads()
        past = [number for number, committed in loads if committed <= cutoff]
        kept = [number for number, _ in loads if not past or number >= past[-1]]
        names = lambda numbers: {f"{self.LOAD}={load}/{folder}" for number in numbers for folder, load in self._map(number)["held"].items()}
        needed = names(kept)
        needed_loads = {name.split("/")[0] for name in needed}
        gone = set()
        for name in names(past[:-1]) - needed:
            load = name.split("/")[0]
            gone.add(name if load in needed_loads else load)
        gone |= {f"{self.LOAD}={number}" for number in past[:-1]} - needed_loads
        for name in [*sorted(gone), *[f"{self.MAPS}/{number}" for number in past[:-1]]]:
            self.files.delete(f"{self.path}/{name}")
        return sorted(gone)


class BucketedTable(MappedTable):
    """Kept by the hash of its key, so that a load reads and rewrites the buckets of its own keys only.

    The first load sets the number of buckets, by its rows; maintenance doubles it while buckets have grown too large.
    Neither goes beyond ``MOST_BUCKETS``: each bucket is a folder to list and a file to open in every load, and a load of
    more keys than buckets touches all of them anyway; from there on the buckets grow with the table.
    """

    BUCKET = "key_bucket"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bucket_rows: int = 1_000_000, unique: bool = False):
        super().__init__(spark, path, self.BUCKET, T.IntegerType(), derived=True)
        self.keys = list(keys)
        self.bucket_rows = bucket_rows
        # Whether every source of this table is known to hold each key once.
        self.unique = unique

    def _bucket(self, buckets: int) -> Column:
        # As text, so that an int and a bigint of one value share a bucket.
        return F.pmod(F.xxhash64(*[F.col(quoted(name)).cast("string") for name in self.keys]), F.lit(buckets)).cast("int")

    def _buckets(self, rows: DataFrame) -> int:
        state = self._newest()[1]
        return state["buckets"] if state else min(MOST_BUCKETS, max(1, math.ceil(rows.count() / self.bucket_rows)))

    def merge(self, source: DataFrame, keys: Sequence[str] | None = None, keep_where_null: Sequence[str] = (), computed: bool = True,
              batch: tuple[str, int] | None = None, unique: bool = False) -> None:
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"{self.path} is kept by {self.keys}, not by {list(keys)}")
        # Staged here where its rows are still to be counted, so that they are computed once.
        with staged(writable(source)) if computed else nullcontext(source) as rows:
            self.buckets = self._buckets(rows)
            super().merge(rows, self.keys, keep_where_null, computed=False, batch=batch, unique=unique or self.unique)

    def _with_partition(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.BUCKET, self._bucket(self.buckets))

    def _publish(self, rows: DataFrame, touched: list, rebalance: bool = True, **notes) -> None:
        buckets = {} if self._newest()[1] else {"buckets": self.buckets}
        super()._publish(rows, touched, rebalance, **{**buckets, **notes})

    def of_keys(self, rows: DataFrame) -> DataFrame:
        """The table's rows in the buckets of the keys of ``rows``; no other bucket is read."""
        state = self._newest()[1]
        if state is None:
            raise FileNotFoundError(f"{self.path} has no load")
        buckets = rows.select(self._bucket(state["buckets"])).distinct().collect()
        return self._plain(self._in([row[0] for row in buckets]))

    def compact(self, small_bytes: int = SMALL_FILE_BYTES, target_bytes: int = TARGET_FILE_BYTES) -> int:
        state = self._newest()[1]
        if state:
            wanted, rows = state["buckets"], self.read()
            count = rows.count()
            while count > 2 * wanted * self.bucket_rows and 2 * wanted <= MOST_BUCKETS:
                wanted *= 2
            if wanted > state["buckets"]:
                self._publish(rows.withColumn(self.BUCKET, self._bucket(wanted)), [*range(state["buckets"])], buckets=wanted)
                return wanted
        return super().compact(small_bytes, target_bytes)


class KeyMonths(BucketedTable):
    """Side table of tables kept by month: the months in which the rows of a key may be.

    A load tells it the new months of its keys before it publishes its rows, and no month is ever
    taken out, so a key is found wherever a load that failed, or a table that lags behind, still has it. One side table
    serves all tables through which the same rows pass.
    """

    def learn(self, rows: DataFrame, month: Column, unique: bool = False) -> None:
        """Add the months of the keys of ``rows``, a plain scan where it holds each key once (``unique``).

        Rows without key or month are left out.
        """
        known = rows.select(*map(quoted, self.keys), month.alias("month")).dropna()
        if unique:
            fresh = known.select(*map(quoted, self.keys), F.array("month").alias("fresh"))
        else:
            fresh = known.groupBy(*map(quoted, self.keys)).agg(F.collect_set("month").alias("fresh"))
        if not self.exists():
            self.merge(fresh.withColumnRenamed("fresh", "months"), computed=not unique, unique=True)
            return
        with staged(fresh) as new:
            joined = new.join(self.of_keys(new), self.keys, "left")
            months = F.array_sort(F.array_union("fresh", F.coalesce("months", F.array().cast("array<int>"))))
            # Most loads restate rows where they are; those teach nothing and rewrite no bucket.
            self.merge(joined.where(F.col("months").isNull() | (F.size(F.array_except("fresh", "months")) > 0)).select(
                *map(quoted, self.keys), months.alias("months")), unique=True)

    def months_of(self, wanted: DataFrame) -> list[int]:
        """Every month in which a key of ``wanted`` may be, from the buckets of these keys."""
        known = self.of_keys(wanted).join(wanted, self.keys, "left_semi")
        return [row["month"] for row in known.select(F.explode("months").alias("month")).distinct().collect()]


class PartitionedTable(MappedTable):
    """Partitioned by the day column itself, or by the month of a day column.

    ``by_month`` suits tables whose key lacks the day: a re-dated row then leaves its old month. With an ``index`` that
    has learnt the months of the rows, a merge looks its keys up there instead of in the key columns of all months.
    """

    MONTH = "partition_month"

    def __init__(self, spark: SparkSession, path: str, day: str, by_month: bool = False, index: KeyMonths | None = None):
        super().__init__(spark, path, self.MONTH if by_month else day, T.IntegerType() if by_month else T.DateType(), derived=by_month)
        self.day = day
        self.by_month = by_month
        self.index = index

    def _bound(self, start: dt.date) -> int | dt.date:
        return start.year * 100 + start.month if self.by_month else start

    def window(self, start: dt.date) -> DataFrame:
        """Rows with ``day >= start``, from the partitions that can hold them; others are not even listed."""
        bound = self._bound(start)
        rows = scan_window(self._rows(only=lambda value: value is not None and value >= bound), self.day, start)
        return self._plain(rows.where(F.col(quoted(self.partition)) >= F.lit(bound)))

    def watermark(self) -> dt.date | None:
        """Greatest day, read from the newest partition alone."""
        dated = self._partitions()
        if not dated:
            return None
        if not self.by_month:
            return dated[-1]
        return self._in([dated[-1]]).agg(F.max(quoted(self.day))).first()[0]

    def window_start(self, lookback_days: int) -> dt.date:
        return window_start(self.watermark(), lookback_days)

    @staticmethod
    def month(day: Column) -> Column:
        return F.year(day) * 100 + F.month(day)

    def _with_partition(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.MONTH, self.month(F.col(quoted(self.day)))) if self.by_month else df

    def _found(self, rows: DataFrame, keys: Sequence[str], touched: list) -> list:
        """When the key holds the partition column, its rows are in the source's own partitions."""
        if self.partition in keys:
            return []
        wanted = rows.select(*map(quoted, keys))
        if self.index is not None and self.index.exists():
            return self.index.months_of(wanted)
        return self._touched(self._rows().join(wanted, list(keys), "left_semi"))

    def reload_window(self, source: DataFrame, start: dt.date, computed: bool = True) -> None:
        """Replace every row with ``day >= start`` by the source, in one publish."""
        with self._source(source, computed) as rows:
            found = self._touched(rows)
            if not self.exists():
                if found:
                    self._publish(rows, found)
                return
            touched = list({*found, *[value for value in self._partitions() if value >= self._bound(start)]})
            if touched:
                self._publish(reload_rows(self._in(touched), rows, self.day, start), touched)


def footer_statistics(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """rows, and low_<column> and high_<column> of numeric columns and dates, from the footers of the files below ``path``.

    The aggregate is pushed into the scan, so no row is read.
    """
    reader = spark.newSession()
    sources = reader.conf.get("spark.sql.sources.useV1SourceList").split(",")
    reader.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in sources if name != "parquet"))
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    wanted = [F.count(F.lit(1)).alias("rows")]
    for name in columns:
        wanted += [F.min(quoted(name)).alias(f"low_{name}"), F.max(quoted(name)).alias(f"high_{name}")]
    return reader.read.parquet(path).agg(*wanted)
