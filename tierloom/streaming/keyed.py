"""Tables that a stream keeps up to date by key, without a state store.

A micro-batch is written as a version of its own and counts from the moment its one small commit file is there. The commit
names the stream and the batch, so a batch that is run again after a failure changes nothing, and what a failed run left
is never read. One stream or refresh at a time writes a table; readers see the newest commit.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from tierloom.operators.expectations import REPORT, Expectation, observed
from tierloom.operators.ranking import top_per_group
from tierloom.sources.evolution import widen
from tierloom.streaming.runs import STREAM_SETTINGS
from tierloom.workspace import folder_exists, release, remove_folder, settings, stored

BUCKET = "_bucket"
COMMIT = "version bigint, entry string"
# Hash buckets of a table: a micro-batch reads and rewrites whole buckets, so choose as many as give files of some
# hundred megabytes once the table has grown. Fixed by the first commit.
BUCKETS = 64


@dataclass(frozen=True)
class Commit:
    """What one batch changed. ``live`` has the version of every bucket's rows for tables whose buckets are replaced."""

    version: int
    source: str
    batch: int
    schema: StructType
    buckets: int
    live: Mapping[int, int] = field(default_factory=dict)
    counts: Mapping[str, int] = field(default_factory=dict)
    # Types found so far, by column, for tables whose columns are kept as text.
    types: Mapping[str, str] = field(default_factory=dict)
    # A version that holds again the rows of all commits up to this one, and adds none.
    covers: int = 0

    def text(self) -> str:
        parts = {name: getattr(self, name) for name in ("version", "source", "batch", "buckets", "counts", "types", "covers")}
        return json.dumps({**parts, "live": sorted(self.live.items()), "schema": self.schema.json()})

    @staticmethod
    def parse(text: str) -> Commit:
        parts = json.loads(text)
        return Commit(**{**parts, "live": dict(parts["live"]), "schema": StructType.fromJson(json.loads(parts["schema"]))})


def same_key(left: str, right: str, keys: Iterable[str]) -> Column:
    """Equality of all key columns of two aliased tables, null equal to null."""
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(f"{left}.`{key}`").eqNullSafe(F.col(f"{right}.`{key}`"))
    return condition


def held(commits: Iterable[Commit], source: str, batch: int) -> bool:
    return any(c.source == source and c.batch == batch for c in commits)


class CommittedTable:
    """Versions of Parquet files below ``folder``, one per batch, of which those with a commit count."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commits(self) -> DataFrame | None:
        path = f"{self.folder}/commits"
        return self.spark.read.schema(COMMIT).json(path) if folder_exists(self.spark, path) else None

    def commits(self, after: int = 0) -> list[Commit]:
        """All commits after a version, oldest first: one small entry per batch."""
        found = self._commits()
        entries = [Commit.parse(row["entry"]) for row in found.collect()] if found is not None else []
        return sorted((c for c in entries if c.version > after), key=lambda c: c.version)

    def last(self) -> Commit | None:
        """The newest commit."""
        return max(self.commits(), key=lambda c: c.version, default=None)

    def holds(self, source: str, batch: int) -> bool:
        return held(self.commits(), source, batch)

    def path(self, version: int) -> str:
        return f"{self.folder}/rows/_v={version}"

    def _commit(self, commit: Commit) -> None:
        entry = self.spark.createDataFrame([(commit.version, commit.text())], COMMIT).coalesce(1)
        entry.write.mode("overwrite").json(f"{self.folder}/commits/batch={commit.version}")

    def read(self, after: int = 0, upto: int | None = None) -> DataFrame | None:
        """All rows, or those that commits after a version added, with all columns known by then; None before the first."""
        commits = [c for c in self.commits() if upto is None or (c.covers or c.version) <= upto]
        if not commits:
            return None
        schema, paths = commits[-1].schema, self._paths(commits, after)
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.folder}/rows").parquet(*paths)
        return rows.select(*[F.col(f"`{name}`") for name in schema.fieldNames()])

    def _paths(self, commits: list[Commit], after: int = 0) -> list[str]:
        """Folders with the rows of some commits, or with what those after a version added."""
        covering = sorted((c for c in commits if c.covers), key=lambda c: c.covers)
        if after and len(covering) > 1 and after < covering[-2].covers:
            raise ValueError(f"what version {after + 1} added is only there together with others")
        whole = covering[-1:] if not after else []
        begin = whole[0].covers if whole else after
        own = [c for c in commits if not c.covers and c.version > begin]
        return [self.path(c.version) for c in whole + own]


class AppendedTable(CommittedTable):
    """A table that gains all rows of every batch. Columns may be added, also inside structs."""

    def append(self, rows: DataFrame, source: str, batch: int, seen: Observation | None = None, types: Callable | None = None) -> bool:
        """Add the rows of a batch; False if they have been added before.

        ``seen`` observes them while they are written, and ``types`` makes the types that the commit holds of what it
        saw, so that both are there together or not at all.
        """
        commits = self.commits()
        if held(commits, source, batch):
            return False
        before = commits[-1] if commits else None
        version = before.version + 1 if before else 1
        schema = widen(before.schema, rows.schema) if before else rows.schema
        rows.write.mode("overwrite").parquet(self.path(version))
        found = types(seen.get) if types else {}
        self._commit(Commit(version, source, batch, schema, 0, types=found))
        return True


def follow(source: CommittedTable, target: CommittedTable, step: Callable[[DataFrame, str, int], object]) -> bool:
    """Give ``step`` what ``source`` has gained since ``target`` last took from it; False if that is nothing.

    Only files of the new commits are read. The step commits to ``target`` under the folder and the version it is given,
    so what is followed again after a failure is not taken twice.
    """
    newest = max((c.version for c in source.commits() if not c.covers), default=0)
    taken = max((c.batch for c in target.commits() if c.source == source.folder), default=0)
    if newest <= taken:
        return False
    step(source.read(after=taken, upto=newest), source.folder, newest)
    return True


class KeyedTable(CommittedTable):
    """A table partitioned by a hash of ``keys``, with each key once."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int = BUCKETS):
        super().__init__(spark, folder)
        self.keys = list(keys)
        known = self.last()
        self.buckets = known.buckets if known else buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(key) for key in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> None:
        """All rows of a bucket go to one file; leftovers of a failed attempt at this version are overwritten."""
        # A bucket follows from the key alone, so a hot key is one row here: both kinds of table hold a key once.
        rows.repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path(version))

    def _touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows; at most as many as there are buckets."""
        return sorted(row[0] for row in rows.select(BUCKET).distinct().collect())


class AddedTable(KeyedTable):
    """A table that only gains rows: the first of every key that arrives, with counts of expectations per batch."""

    def _known(self, touched: list[int], commits: list[Commit]) -> DataFrame | None:
        """Keys of stored rows in some buckets: only the key columns are read, and only these buckets."""
        if not commits:
            return None
        schema = with_bucket(StructType([commits[-1].schema[key] for key in self.keys]))
        reader = self.spark.read.schema(schema).option("basePath", f"{self.folder}/rows")
        return reader.parquet(*self._paths(commits)).filter(F.col(BUCKET).isin(touched)).select(*self.keys)

    def unseen(self, rows: DataFrame, commits: list[Commit] | None = None) -> DataFrame:
        """Rows whose key the table does not have. ``rows`` has the bucket and each key once.

        The stored keys are first cut down to those that the batch has. That join's other side is the batch, so Spark
        broadcasts the batch while it is small and does not shuffle what is stored.
        """
        commits = self.commits() if commits is None else commits
        known = self._known(self._touched(rows), commits) if commits else None
        if known is None:
            return rows
        keys = rows.select(*self.keys).alias("batch")
        met = known.alias("stored").join(keys, same_key("stored", "batch", self.keys), "left_semi").distinct()
        return rows.alias("batch").join(met.alias("met"), same_key("batch", "met", self.keys), "left_anti")

    def insert_new(self, rows: DataFrame, source: str, batch: int, expectations: Sequence[Expectation] = ()) -> bool:
        """Add the rows that meet all expectations and whose key is new; False if this batch has been added before.

        Of rows with the same key in one batch any one is taken. The commit holds, per expectation, how many rows
        failed, so counts and rows are there together or not at all.
        """
        commits = self.commits()
        if held(commits, source, batch):
            return False
        before = commits[-1] if commits else None
        version = before.version + 1 if before else 1
        seen = Observation()
        checked = observed(rows, expectations, seen)
        once = stored(checked.dropDuplicates(self.keys).withColumn(BUCKET, self.bucket()), "new-keys")
        schema = merged_schema(before.schema if before else None, rows.schema)
        self._write(self.unseen(once, commits), version)
        counts = {name: int(value) for name, value in seen.get.items()}
        self._commit(Commit(version, source, batch, schema, self.buckets, counts=counts))
        release(once)
        return True

    def report(self, expectations: Sequence[Expectation], after: int = 0) -> DataFrame:
        """(name, passed, failed) of all batches after a version."""
        commits = self.commits(after)
        rows = sum(c.counts.get("rows", 0) for c in commits)
        failed = {e.name: sum(c.counts.get(e.name, 0) for c in commits) for e in expectations}
        return self.spark.createDataFrame([(name, rows - n, n) for name, n in failed.items()], REPORT)


    def compact(self, taken: int) -> bool:
        """Put what all commits up to ``taken`` added into one version with one file per bucket; False if that is one.

        To be called now and then, where many small batches leave many small files, with a version that every follower
        has taken. Readers of the whole table read the one version from then on. The commits' own rows stay until the
        next compaction, for readers that are still at them; what the compaction before covered is removed.
        """
        commits = self.commits()
        covered = [c for c in commits if not c.covers and c.version <= taken]
        whole = max((c for c in commits if c.covers), key=lambda c: c.covers, default=None)
        if not covered or (whole and covered[-1].version <= whole.covers) or len(covered) < 2:
            return False
        upto, version = covered[-1].version, commits[-1].version + 1
        self._write(self.read(upto=upto).withColumn(BUCKET, self.bucket()), version)
        self._commit(Commit(version, "compaction", upto, commits[-1].schema, self.buckets, covers=upto))
        past = whole.covers if whole else 0
        for commit in commits:
            if commit.version <= past or (commit.covers and commit.covers < past):
                remove_folder(self.spark, self.path(commit.version))
        return True


def with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, IntegerType())])


def merged_schema(known: StructType | None, found: StructType) -> StructType:
    """The known columns, then those that are new. A column that changes its type is refused."""
    if known is None:
        return StructType(found.fields)
    types = {f.name: f.dataType for f in known}
    changed = [f.name for f in found if f.name in types and types[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns with another type than before: {changed}")
    return StructType([*known.fields, *[f for f in found if f.name not in types]])


class MergedTable(KeyedTable):
    """A table with one row per key, whose buckets a batch replaces by what a merge of old and new rows gives."""

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The rows of the newest commit, of all or some buckets; None before the first one."""
        last = self.last()
        return self._read(last, buckets) if last else None

    def _read(self, last: Commit, buckets: Iterable[int] | None) -> DataFrame:
        chosen = last.live if buckets is None else {b: last.live[b] for b in buckets if b in last.live}
        paths = [f"{self.path(version)}/{BUCKET}={bucket}" for bucket, version in chosen.items()]
        if not paths:
            return self.spark.createDataFrame([], last.schema)
        return self.spark.read.schema(last.schema).parquet(*paths)

    def merge(self, changes: DataFrame, source: str, batch: int, combine: Callable[[DataFrame], DataFrame]) -> bool:
        """Replace the buckets that have changes by ``combine`` of their stored rows and the changes, in one table.

        ``combine`` gives one row per key and has to be of the kind that may be applied again to its own results: sums
        of sums, the newest of the newest. It is applied to the changes first, so that their copies are gone before
        anything is read. False if this batch has been merged before. Buckets without changes are neither read nor written.
        """
        commits = self.commits()
        if held(commits, source, batch):
            return False
        before = commits[-1] if commits else None
        version = before.version + 1 if before else 1
        fresh = stored(combine(changes).withColumn(BUCKET, self.bucket()), "changed-keys")
        touched = self._touched(fresh)
        rows = fresh.drop(BUCKET)
        schema = merged_schema(before.schema if before else None, rows.schema)
        if before:
            rows = combine(self._read(before, touched).unionByName(rows, allowMissingColumns=True))
        self._write(rows.select(*schema.fieldNames()).withColumn(BUCKET, self.bucket()), version)
        live = {**(before.live if before else {}), **dict.fromkeys(touched, version)}
        self._commit(Commit(version, source, batch, schema, self.buckets, live))
        release(fresh)
        self._drop_versions(commits, live)
        return True

    def _drop_versions(self, commits: list[Commit], live: Mapping[int, int]) -> None:
        """Remove rows that neither the newest commit nor the one before (the last of ``commits``) shows."""
        if not commits:
            return
        shown = {*live.values(), *commits[-1].live.values()}
        # What went out of use lately, also where a lost driver left it.
        for version in {v for c in commits[-10:] for v in c.live.values()} - shown:
            remove_folder(self.spark, self.path(version))


def newest(keys: Sequence[str], sequence: str) -> Callable[[DataFrame], DataFrame]:
    """Per key the row with the highest sequence; of equal ones the greatest by its other columns, so that reruns agree."""

    def combine(rows: DataFrame) -> DataFrame:
        others = [F.col(f"`{name}`").desc_nulls_last() for name in sorted(rows.columns) if name not in {*keys, sequence}]
        return top_per_group(rows, keys, [F.col(sequence).desc_nulls_last(), *others])

    return combine


def without_removed(table: DataFrame, deleted: str) -> DataFrame:
    """What readers of an upserted table see: keys whose newest row does not say that they were removed."""
    return table.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def start_batches(rows: DataFrame, checkpoint: str, step: Callable[[DataFrame, str, int], object]) -> StreamingQuery:
    """Give every micro-batch of what has arrived since the last run to ``step(rows, checkpoint, batch id)``."""
    with settings(rows.sparkSession, STREAM_SETTINGS):
        return (
            rows.writeStream.foreachBatch(lambda batch, number: step(batch, checkpoint, number) and None)
            .trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .start()
        )


def upsert_stream(changes: DataFrame, checkpoint: str, table: MergedTable, sequence: str) -> StreamingQuery:
    """Start to bring a table of corrections up to date: per key the row with the highest ``sequence`` stays.

    Neither the order of arrival nor a batch that is run again matters. A removal is a row too (a boolean column, see
    ``without_removed``) and stays as a mark, so that an older row that arrives after it does not bring the key back.
    """
    combine = newest(table.keys, sequence)
    return start_batches(changes, checkpoint, lambda rows, source, batch: table.merge(rows, source, batch, combine))


def first_arrival_stream(
    rows: DataFrame, checkpoint: str, table: AddedTable, expectations: Sequence[Expectation] = ()
) -> StreamingQuery:
    """Start to add the rows with new keys to a table, which is itself the memory of what has been seen."""
    return start_batches(
        rows, checkpoint, lambda batch, source, number: table.insert_new(batch, source, number, expectations)
    )
