"""The keyed record store (M1-M6, S9): projection, checks, merge, versions in buckets of keys."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import text as X
from pressloom.functions import urls as U
from pressloom.operators.candidates import utc
from pressloom.operators.manifest import ManifestLog
from pressloom.schemas import NESTED_FIELDS, NEWS_RECORD

KEY = ["source_id", "url"]
# Buckets of a new store; a store keeps the number it began with.
BUCKETS = 64


class StoreError(ValueError):
    """The store or the incoming records cannot be used; the old snapshot stays as it is."""


def project_news(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M1: only whitelisted fields, also inside nested lists; unknown ones (tokens, headers) go."""
    columns = []
    have = set(df.columns)
    for field in NEWS_RECORD.fields:
        if field.name not in have:
            continue
        if field.name in NESTED_FIELDS:
            columns.append(_nested(df, field.name, NESTED_FIELDS[field.name]).alias(field.name))
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns, *[name for name in keep or [] if name in have])


def _nested(df: DataFrame, name: str, kind: T.ArrayType) -> Column:
    inside = {f.name for f in df.schema[name].dataType.elementType.fields}

    def element(item: Column) -> Column:
        return F.struct(*[
            (item[f.name] if f.name in inside else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in kind.elementType.fields
        ])

    return F.transform(F.col(name), element)


def identity_violation(source_id: Column, url: Column) -> Column:
    """M2: null for a good key, else what is wrong with it."""
    return (
        F.when(X.blank_to_null(source_id).isNull(), F.lit("missing_source_id"))
        .when(X.blank_to_null(url).isNull(), F.lit("missing_url"))
        .when(~U.scheme(url).isin("http", "https") | (U.host(url) == ""), F.lit("not_an_article_url"))
        .when(U.user_info(url).isNotNull(), F.lit("credentials_in_url"))
    )


def incoming_violations(records: DataFrame) -> DataFrame:
    return records.select(*KEY, identity_violation(F.col("source_id"), F.col("url")).alias("violation")).filter(
        "violation IS NOT NULL"
    )


def stamp_violation() -> Column:
    c = F.col
    return (
        F.when(c("first_seen_at").isNull() | c("last_seen_at").isNull(), F.lit("missing_stamp"))
        .when(c("last_seen_at") < c("first_seen_at"), F.lit("last_before_first"))
    )


def store_violations(store: DataFrame) -> DataFrame:
    """M2, M3: key, time and uniqueness faults of a store."""
    c = F.col
    rows = store.select(*KEY, F.coalesce(identity_violation(c("source_id"), c("url")), stamp_violation()).alias("violation")).filter(
        "violation IS NOT NULL"
    )
    twice = (
        store.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(*KEY, F.lit("duplicate_key").alias("violation"))
    )
    return rows.unionByName(twice)


def has_value(name: str, kind: T.DataType) -> Column:
    """Blank text, null and empty lists are no values; 0 and false are."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(name).rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(F.col(name)) > 0, F.lit(False))
    return F.col(name).isNotNull()


def observations(records: DataFrame, run: dt.datetime | None = None) -> DataFrame:
    """Fetched records as store rows; the run time comes from ``run`` or a ``run_ts`` column."""
    stamp = utc(run) if run is not None else F.col("run_ts")
    return (
        records.withColumns({"first_seen_at": stamp, "last_seen_at": stamp}).drop("run_ts")
    )


def merge_store(store: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """M4, M5: last non-empty value by arrival, first sighting of the first arrival, latest sighting.

    Stored rows precede all incoming ones. An older run that arrives late still supplies values
    but never moves ``last_seen_at`` back. The aggregates combine on the map side, so a key that
    repeats without end costs one row per task.
    """
    rows = incoming.withColumn("_phase", F.lit(1))
    if store is not None:
        rows = store.withColumn("_phase", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    return _merged(rows, KEY, [])


def _merged(rows: DataFrame, keys: list[str], more: list[Column]) -> DataFrame:
    """One row per key: the merge as aggregates over ``_phase`` and ``arrival_seq``, with further aggregates beside it."""
    rows = rows.withColumn("_order", F.struct("_phase", "arrival_seq"))
    values = [f for f in rows.schema.fields if f.name in NEWS_RECORD.names and f.name not in KEY]
    merged = rows.groupBy(*keys).agg(
        *[F.max_by(f.name, F.when(has_value(f.name, f.dataType), F.col("_order"))).alias(f.name) for f in values],
        F.min_by(F.struct(*[f.name for f in values], "first_seen_at", "arrival_seq"), F.col("_order")).alias("_first"),
        F.max("last_seen_at").alias("last_seen_at"),
        *more,
    )
    kept = [name for name in merged.columns if name in ("bucket", "_fault", "_stored")]
    return merged.select(
        *KEY,
        *[F.coalesce(F.col(f.name), F.col(f"_first.{f.name}")).alias(f.name) for f in values],
        F.col("_first.first_seen_at").alias("first_seen_at"),
        "last_seen_at",
        F.col("_first.arrival_seq").alias("arrival_seq"),
        *kept,
    )


class RecordStore:
    """The store in buckets of keys. A run reads, merges and writes only the buckets that its records touch.

    A manifest per version names, for each bucket, the folder that holds it; buckets without new records keep their
    files from version to version. It also holds the schema and, for each stream, the last batch that the
    version contains, so data and batch become visible together. Two runs that start from the same version cannot
    both publish: the second one raises and may merge again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = ManifestLog(spark, path)
        self._buckets = buckets

    def buckets(self, manifest: dict | None = None) -> int:
        """Number of buckets: fixed by the first version."""
        return n_of(self.log.newest()[1] if manifest is None else manifest, self._buckets)

    def latest(self) -> int | None:
        """Newest version, or None for a missing store."""
        return self.log.latest()

    def folders(self, version: int) -> dict[int, str]:
        """The folder of each bucket that holds records."""
        return {int(bucket): folder for bucket, folder in self.log.read(version)["folders"].items()}

    def applied(self, version: int | None) -> dict[str, int]:
        """The last batch of each stream that a version holds."""
        return {} if version is None else self.log.read(version)["applied"]

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """A version of the store, whole or some buckets of it; None only if there is no store. A damaged one raises."""
        version = self.latest() if version is None else version
        return None if version is None else self._read(self.log.read(version), buckets)

    def _read(self, manifest: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        wanted = None if buckets is None else {str(bucket) for bucket in buckets}
        paths = [f"{self.path}/{folder}" for bucket, folder in manifest["folders"].items() if wanted is None or bucket in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def records_of(self, keys: DataFrame) -> DataFrame | None:
        """The stored records of some keys, read from their buckets only."""
        version, manifest = self.log.newest()
        if version is None:
            return None
        touched = self._touched(keys, self.buckets(manifest))
        return self._read(manifest, touched).join(keys.select(*KEY).distinct(), KEY, "left_semi")

    @staticmethod
    def _touched(rows: DataFrame, buckets: int) -> list[int]:
        """The buckets that rows fall into: at most one number for each bucket."""
        return sorted(row[0] for row in rows.select(bucket_of(buckets)).distinct().collect())

    def merge(self, incoming: DataFrame, batch: tuple[str, int] | None = None, check: bool = True) -> int:
        """Merge records into the newest version, whichever that is, and publish the next one.

        ``batch`` names a stream and the number of its batch; one that the newest version holds already is
        skipped. Incoming records are evaluated once, into a staging folder; the stored rows of touched buckets are
        read once, and their faults are found in the merge itself. A fault raises ``StoreError`` before
        anything is published.
        """
        latest, manifest = self.log.newest()
        applied = manifest.get("applied", {})
        if batch is not None and applied.get(batch[0], -1) >= batch[1]:
            return latest
        n, run = self.buckets(manifest), f"run-{uuid.uuid4().hex}"
        staged = self._staged(incoming, run, check)
        touched = self._touched(staged, n)
        base = self._read(manifest, touched) if latest is not None else None
        merged = merge_touched(base, staged, n, max(1, len(touched)), check)
        if batch is not None:
            applied = {**applied, batch[0]: batch[1]}
        return self._publish(latest, manifest, run, merged, touched, applied)

    def fill(self, values: DataFrame, unusable: dict[str, Column] | None = None) -> int | None:
        """Give stored records values that they lack: a partial record that is no new sighting.

        ``values`` holds the key and some fields. What a record has stays, unless ``unusable`` says that a field's
        value is none; its sightings stay, and keys that the store does not hold are passed over.
        """
        latest, manifest = self.log.newest()
        if latest is None:
            return None
        n, run = self.buckets(manifest), f"run-{uuid.uuid4().hex}"
        staged = self._staged(values, run, check=False)
        touched = self._touched(staged, n)
        fields = [f for f in staged.schema.fields if f.name not in KEY]
        offered = staged.groupBy(*KEY).agg(*[F.max(F.when(has_value(f.name, f.dataType), F.col(f.name))).alias(f"_{f.name}") for f in fields])
        base = self._read(manifest, touched)
        absent = [f for f in fields if f.name not in base.columns]
        base = base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else base

        def has(f: T.StructField) -> Column:
            return has_value(f.name, f.dataType) & ~F.coalesce((unusable or {}).get(f.name, F.lit(False)), F.lit(False))

        filled = base.join(offered, KEY, "left").withColumns(
            {f.name: F.when(has(f), F.col(f.name)).otherwise(F.coalesce(F.col(f"_{f.name}"), F.col(f.name))) for f in fields}
        ).drop(*[f"_{f.name}" for f in fields])
        dealt = filled.withColumn("bucket", bucket_of(n)).repartition(max(1, len(touched)), "bucket")
        return self._publish(latest, manifest, run, dealt, touched, manifest["applied"])

    def _publish(self, latest: int | None, manifest: dict, run: str, merged: DataFrame, touched: list[int], applied: dict) -> int:
        """Write the touched buckets and publish a version in which all others keep their files."""
        schema, folders = merged.drop("bucket").schema, dict(manifest.get("folders", {}))
        if latest is not None:
            schema = self._read(manifest, []).unionByName(merged.drop("bucket").limit(0), allowMissingColumns=True).schema
        if touched:
            _raising(lambda: merged.write.partitionBy("bucket").parquet(f"{self.path}/{run}/merged"))
            written = {int(name[7:]) for name in self.log.names(f"{run}/merged") if name.startswith("bucket=")}
            folders.update({str(bucket): f"{run}/merged/bucket={bucket}" for bucket in touched if bucket in written})
        target = 0 if latest is None else latest + 1
        self.log.publish(target, {"buckets": n_of(manifest, self._buckets), "schema": schema.jsonValue(), "folders": folders, "applied": applied})
        self.log.remove(f"{run}/staged")
        return target

    def _staged(self, incoming: DataFrame, run: str, check: bool) -> DataFrame:
        """Incoming records as files; a record without a usable identity stops the write."""
        path = f"{self.path}/{run}/staged"
        if check:
            fault = identity_violation(F.col("source_id"), F.col("url"))
            incoming = incoming.withColumn("url", _or_fault(F.col("url"), fault, "incoming records"))
        _raising(lambda: incoming.write.parquet(path))
        return self.spark.read.schema(incoming.schema).parquet(path)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove old versions and the files that only they use."""
        return self.log.expire(keep, lambda manifest: set(manifest["folders"].values()))


def n_of(manifest: dict, otherwise: int) -> int:
    return manifest.get("buckets", otherwise)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int").alias("bucket")


def merge_touched(base: DataFrame | None, staged: DataFrame, buckets: int, tasks: int, check: bool = True) -> DataFrame:
    """Merged rows of the touched buckets, dealt by bucket, with a ``bucket`` column.

    Records that repeat a key are merged first, combined map-side, so a hot key reaches its bucket as one row; then each
    bucket meets its stored rows in one task. With ``check``, stored rows that are faulty or share a key stop the job.
    """
    incoming = merge_store(None, staged)
    rows = incoming.withColumns({"_phase": F.lit(1), "_fault": F.lit(None).cast("string")})
    if base is not None:
        fault = F.coalesce(identity_violation(F.col("source_id"), F.col("url")), stamp_violation())
        stored_rows = base.withColumns({"_phase": F.lit(0), "_fault": fault if check else F.lit(None).cast("string")})
        rows = stored_rows.unionByName(rows, allowMissingColumns=True)
    dealt = rows.withColumn("bucket", bucket_of(buckets)).repartition(tasks, "bucket")
    merged = _merged(dealt, ["bucket", *KEY], [
        F.max("_fault").alias("_fault"), F.count_if(F.col("_phase") == 0).alias("_stored")])
    fault = F.coalesce(F.col("_fault"), F.when(F.col("_stored") > 1, F.lit("duplicate_key")))
    if check:
        merged = merged.withColumn("url", _or_fault(F.col("url"), fault, "store"))
    return merged.drop("_fault", "_stored")


FAULT = re.compile(r"STORE_FAULT<(.*?)>", re.DOTALL)


def _or_fault(value: Column, violation: Column, what: str) -> Column:
    """The value, or an error that ends the job where there is a violation."""
    shown = F.concat(F.lit(f"STORE_FAULT<{what}: "), violation, F.lit(" at "), X.text_or_empty(F.col("source_id")), F.lit(" "),
                     X.text_or_empty(F.col("url")), F.lit(">"))
    return F.when(violation.isNotNull(), F.raise_error(shown).cast("string")).otherwise(value)


def _raising(write) -> None:
    """Run a write; a fault found in it becomes a ``StoreError``."""
    try:
        write()
    except Exception as error:
        found = FAULT.search(str(error))
        if found:
            raise StoreError(found.group(1)) from error
        raise
