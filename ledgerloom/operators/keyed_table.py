"""Keyed tables on versioned Parquet.

A keyed table is a folder of immutable Parquet *segments* plus a commit log:

    <root>/seg-<id>/part-*.parquet        data, never rewritten in place
                                          (bucketed: <root>/data/_seg=<id>/)
    <root>/_log/<n>.json                  version n: the schema, one line per live
                                          segment, an end line
    <root>/_pins/*.json                   segments shared with clones

A version lists the segments that make up the table; the highest version is
current.  Writers only add files, and a version becomes visible only after
its data is fully written, so a failed job (or a lost executor, which Spark
retries) never leaves a half-written table behind, and a plan that reads the
table while a new version is written keeps reading its own version.  A log
file is written under a private name and renamed without overwriting, so it is
complete or absent, and of two writers of one version the second gets a conflict.

Operations and what they cost at scale:

* ``append`` (insert-if-absent): the batch is staged once and its keys are
  validated whole; they are matched against the *key column only* of the stored
  table (no shuffle of the stored table when it is bucketed or the staged keys
  are measured small).  A batch without conflicts is committed as staged, one
  without new rows commits nothing.  The result does not depend on the sizes.
* ``append(on_conflict="replace")`` and ``update`` write only the new or changed
  rows, as a segment of a later *generation*; reading drops older rows of its
  keys with an anti join (no shuffle when bucketed).  Stored data stays.
* ``overwrite``: one new segment replaces the table (and folds generations).
* ``scan``: a plain Parquet scan over the live segments; filters and column
  pruning reach the files.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import time
import urllib.parse
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.layout import (
    DEFAULT_BROADCAST_BYTES,
    SideSize,
    broadcast_bound,
    broadcast_if_small,
    observed,
    observed_size,
)
from ledgerloom.session import scratch_path

_LOG = "_log"
_LOG_FILE = re.compile(r"^(\d{8})\.json$")
_LOG_END = {"end": True}
_PINS = "_pins"
_SEG = "_seg"  # partition column of bucketed tables: one partition per segment
_GENERATION = "_generation"
_SEGMENT_PREFIX = "seg-"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _is_absolute(entry: str) -> bool:
    return entry.startswith("/") or re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", entry) is not None


def _normalise(path: str) -> str:
    """Path part of a file URI, so listing results and ``_metadata.file_path`` compare equal."""
    parsed = urllib.parse.urlparse(path)
    return urllib.parse.unquote(parsed.path) if parsed.scheme else path


def _ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder (a table location must exist before it is scanned)."""
    fs, hpath = _hadoop_fs(spark, path)
    fs.mkdirs(hpath)


def _write_once(spark: SparkSession, path: str, payload: bytes) -> bool:
    """Write a whole file that must not exist yet; False if it does.

    The bytes go to a private name first and are renamed without overwriting, so
    ``path`` is complete or absent.  Errors other than "it exists" are raised.
    """
    jvm = spark.sparkContext._jvm
    fs, target = _hadoop_fs(spark, path)
    _, private = _hadoop_fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(target.getParent())
    out = fs.create(private, False)
    try:
        out.write(bytearray(payload))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(fs.makeQualified(private), fs.makeQualified(target), options)
    except Py4JJavaError as exc:
        fs.delete(private, False)
        if exc.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


class KeyedTableError(ValueError):
    """Invalid batch for a keyed table (null or duplicate keys, schema mismatch)."""


class KeyedTableConflict(RuntimeError):
    """Another writer committed the version this writer was about to publish."""


class KeyedTable:
    """A table with a declared key column, stored as versioned Parquet segments."""

    def __init__(self, spark: SparkSession, root: str, key: str, cluster_by_key: bool = True,
                 buckets: int | None = None, catalog_database: str | None = None,
                 replicated: bool = False, replicated_bytes: int = DEFAULT_BROADCAST_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        # Sorting each written file by key narrows the Parquet min/max statistics
        # so point and bulk lookups skip row groups.  It is a per-task sort, not
        # a shuffle.
        self.cluster_by_key = cluster_by_key
        # Bucketed layout: every segment is hash-partitioned on the key into
        # ``buckets`` files, so joins, anti joins and semi joins on the key
        # between tables with the same bucket count need no shuffle.  An existing
        # table keeps the bucket count recorded in its log.
        self.buckets = buckets or None
        # where bucketed tables register their (external, metadata-only) entry
        self.catalog_database = catalog_database
        # "replicated" layout: scans carry a broadcast hint while the table is
        # measured within ``replicated_bytes`` (checked once per version), so
        # joins against it need no shuffle; past the bound it joins normally
        self._replicated = replicated
        self.replicated_bytes = replicated_bytes
        self._replicated_fit: tuple[int, bool] | None = None
        self._version: int | None = None
        self._segments: list[str] | None = None
        # generation of each live segment: 0, or higher for rows that replace older ones
        self._generations: dict[str, int] = {}
        self._later_keys: tuple[int, DataFrame] | None = None
        self._partitions: set[str] = set()
        # sizes of the keys of segments that this object wrote, measured by the write
        self._key_sizes: dict[str, SideSize] = {}
        # the table schema, recorded in every log version: segments are read
        # with it, so no Parquet footer has to be sampled to infer it
        self._schema: T.StructType | None = None
        self._written_schema: T.StructType | None = None

    @property
    def replicated(self) -> bool:
        """Whether the table has the replicated layout (recorded in its log)."""
        if self._version is None:
            self._load_log()
        return self._replicated

    # ------------------------------------------------------------------ log
    def _log_path(self) -> str:
        return f"{self.root}/{_LOG}"

    def _log_file(self, version: int) -> str:
        return f"{self._log_path()}/{version:08d}.json"

    def _load_log(self) -> None:
        """Newest version from a listing of the log folder (metadata only)."""
        versions = self._log_versions()
        version, entries = 0, []
        for newest in reversed(versions):
            found = self._read_version(newest)
            if found is not None:
                version, entries = newest, found
                break
        schema_lines = [e["schema"] for e in entries if "schema" in e]
        self._schema = T.StructType.fromJson(schema_lines[0]) if schema_lines else None
        entries = [e for e in entries if "segment" in e]
        stored = max((e.get("buckets") or 0 for e in entries), default=0) or None
        if version and self.buckets and stored != self.buckets:
            raise KeyedTableError(f"table at {self.root} has buckets={stored}, not {self.buckets}")
        if version:
            self.buckets = stored
            self._replicated = self._replicated or any(e.get("replicated") for e in entries)
        self._version = version
        self._segments = sorted(e["segment"] for e in entries if e.get("segment"))
        self._generations = {e["segment"]: e.get("generation", 0) for e in entries if e.get("segment")}

    def _log_versions(self) -> list[int]:
        fs, folder = _hadoop_fs(self.spark, self._log_path())
        if not fs.exists(folder):
            return []
        return sorted(
            int(m.group(1)) for status in fs.listStatus(folder) if (m := _LOG_FILE.match(status.getPath().getName()))
        )

    def refresh(self) -> "KeyedTable":
        """Forget the version read so far; the next use reads the newest one."""
        self._version = self._segments = self._schema = self._later_keys = None
        self._generations = {}
        return self

    def _read_version(self, version: int) -> list[dict] | None:
        """Entries of one log file, or None if it is not complete (none that this class writes)."""
        fs, path = _hadoop_fs(self.spark, self._log_file(version))
        stream = fs.open(path)
        try:
            raw = self.spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        try:
            lines = [json.loads(line) for line in bytes(raw).decode("utf-8").splitlines() if line]
        except ValueError:
            return None
        if not lines or lines[-1] != _LOG_END:
            return None
        return lines[:-1]

    def version(self) -> int:
        if self._version is None:
            self._load_log()
        return self._version or 0

    def segments(self) -> list[str]:
        if self._segments is None:
            self._load_log()
        return list(self._segments or [])

    def exists(self) -> bool:
        return bool(self.segments())

    def _commit(self, segments: list[str], schema: T.StructType | None = None,
                generations: dict[str, int] | None = None) -> int:
        """Publish the version after the one this object read, listing ``segments``.

        If another writer published (or holds) that version, nothing is published:
        the object forgets what it read, so that a retry builds on the newest one.
        """
        version = self.version() + 1
        generations = {s: g for s, g in (self._generations | (generations or {})).items() if s in segments}
        schema = schema or self._schema or self._written_schema
        header = [{"schema": schema.jsonValue()}] if schema is not None else []
        lines = header + [
            {"segment": s, "buckets": self.buckets or 0, "replicated": self._replicated,
             "generation": generations.get(s, 0)}
            for s in segments
        ] + [_LOG_END]
        payload = "".join(json.dumps(line) + "\n" for line in lines).encode("utf-8")
        if not _write_once(self.spark, self._log_file(version), payload):
            self.refresh()
            raise KeyedTableConflict(f"version {version} of {self.root} was claimed by another writer; retry")
        self._version, self._segments, self._schema = version, sorted(segments), schema
        self._generations = generations
        return version

    # ------------------------------------------------------------- segments
    def _write_segment(self, df: DataFrame) -> str:
        name = f"{_SEGMENT_PREFIX}{uuid.uuid4().hex}"
        if self.buckets:
            columns = self._register(df.schema)
            # one shuffle on the key at write time; each task then holds exactly
            # one bucket, so a segment has one file per bucket
            out = df.select(*columns).repartition(self.buckets, self.key)
            out.withColumn(_SEG, F.lit(name)).write.insertInto(self._catalog_name())
            self._written_schema = out.schema
            return name
        out = df.sortWithinPartitions(self.key) if self.cluster_by_key else df
        # every file can span all keys: Bloom filters tell a lookup which row groups lack its key
        blooms = {f"parquet.bloom.filter.enabled#{self.key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        sized, seen = observed(out, [self.key])
        sized.write.mode("errorifexists").options(**blooms).parquet(f"{self.root}/{name}")
        self._key_sizes[name] = observed_size(seen)
        self._written_schema = out.schema
        return name

    def _path(self, entry: str) -> str:
        # a log entry is a segment folder under this table, or an absolute path
        # shared with another table (see ``clone_from``)
        if _is_absolute(entry):
            return entry
        if self.buckets:
            return f"{self.root}/data/{_SEG}={entry}"
        return f"{self.root}/{entry}"

    def _stored(self, segments: list[str], schema: T.StructType | None = None) -> DataFrame:
        """All rows of the segments, replaced ones included."""
        if self.buckets:
            return self._bucketed(segments).drop(_SEG)
        schema = schema or self._schema
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[self._path(s) for s in segments])

    def _read(self, segments: list[str]) -> DataFrame:
        """The live rows: of a key's rows, those of the latest generation."""
        later = [s for s in segments if self._generations.get(s, 0)]
        if not later:
            return self._stored(segments)
        if self._later_keys is None or self._later_keys[0] != self.version():
            keys = self._with_generation(later).select(
                F.col(self.key).alias("_later_key"), F.col(_GENERATION).alias("_later")
            )
            # co-bucketed keys join without a shuffle; others are broadcast while measured small
            self._later_keys = (self.version(), keys if self.buckets else broadcast_if_small(keys)[0])
        rows, keys = self._with_generation(segments), self._later_keys[1]
        replaced = (rows[self.key] == keys["_later_key"]) & (rows[_GENERATION] < keys["_later"])
        return rows.join(keys, replaced, "left_anti").drop(_GENERATION)

    def _with_generation(self, segments: list[str]) -> DataFrame:
        """Stored rows and the generation of their segment."""
        numbers = {s: self._generations.get(s, 0) for s in segments}
        if self.buckets:
            later = {self._segment_name(s): g for s, g in numbers.items() if g}
            lookup = F.create_map(*(F.lit(x) for pair in later.items() for x in pair))
            generation = F.coalesce(F.element_at(lookup, F.col(_SEG)), F.lit(0))
            return self._bucketed(segments).withColumn(_GENERATION, generation).drop(_SEG)
        parts = [
            self._stored([s for s in segments if numbers[s] == g]).withColumn(_GENERATION, F.lit(g))
            for g in sorted(set(numbers.values()))
        ]
        return functools.reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _segment_name(segment: str) -> str:
        last = segment.rstrip("/").rsplit("/", 1)[-1]
        return last.split("=", 1)[1] if last.startswith(f"{_SEG}=") else last

    # --------------------------------------------------- bucketed catalog view
    def _catalog_name(self) -> str:
        digest = hashlib.sha1(self.root.encode("utf-8")).hexdigest()[:20]
        name = f"ledgerloom_kt_{digest}"
        return f"`{self.catalog_database}`.{name}" if self.catalog_database else name

    def _register(self, schema=None) -> list[str]:
        """Register ``<root>/data`` in the session catalog as a bucketed table.

        Catalog entries are session metadata only; the log stays the source of
        truth, so any session can re-register a table it did not write.
        Returns the data columns in table order.
        """
        name = self._catalog_name()
        if schema is not None and self.spark.catalog.tableExists(name):
            registered = [(f.name.lower(), f.dataType) for f in self.spark.table(name).schema.fields
                          if f.name != _SEG]
            wanted = [(f.name.lower(), f.dataType) for f in schema.fields if f.name != _SEG]
            if registered != wanted:
                # an overwrite changed the schema: the entry is external, so
                # dropping it removes metadata only
                self.spark.sql(f"DROP TABLE {name}")
                self._partitions.clear()
        if not self.spark.catalog.tableExists(name):
            if schema is None:
                live = self.segments()
                if not live:
                    raise KeyedTableError(f"table at {self.root} has no data")
                schema = self._schema or self.spark.read.parquet(self._path(live[0])).schema
            cols = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != _SEG
            )
            _ensure_dir(self.spark, f"{self.root}/data")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {_SEG} STRING) USING parquet "
                f"PARTITIONED BY ({_SEG}) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/data'"
            )
        return [c for c in self.spark.table(name).columns if c != _SEG]

    def _bucketed(self, segments: list[str]) -> DataFrame:
        """The live segments as one bucketed scan (partition pruning on ``_seg``)."""
        self._register()
        name = self._catalog_name()
        # one metadata statement for the live segments this object has not registered yet
        missing = [seg for seg in segments if self._segment_name(seg) not in self._partitions]
        if missing:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
                f"PARTITION ({_SEG}='{self._segment_name(seg)}')"
                + (f" LOCATION '{seg}'" if _is_absolute(seg) else "")
                for seg in missing
            ))
            self._partitions.update(self._segment_name(seg) for seg in missing)
        values = [self._segment_name(s) for s in segments]
        return self.spark.table(name).where(F.col(_SEG).isin(values))

    # ----------------------------------------------------------- validation
    def _with_key(self, df: DataFrame) -> DataFrame:
        """The batch with its key column spelled as the table's key (names match in any case)."""
        found = [c for c in df.columns if c.lower() == self.key.lower()]
        if len(found) != 1:
            raise KeyedTableError(f"batch has no key column {self.key!r}" if not found else f"key columns {found}")
        return df if found[0] == self.key else df.withColumnRenamed(found[0], self.key)

    def _conform(self, df: DataFrame) -> DataFrame:
        """Match a batch to the stored table: same columns (any case), stored order and types."""
        df = self._with_key(df)
        if not self.exists():
            return df
        stored = self._current().schema
        if sorted(c.lower() for c in stored.names) != sorted(c.lower() for c in df.columns):
            raise KeyedTableError(f"batch columns {df.columns} do not match table {stored.names}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored.fields])

    def _validate_keys(self, keys: DataFrame) -> None:
        """Reject null keys and repeated keys of a batch that is written already.

        Reads the key column only, so the batch plan is not computed a second time.  One
        aggregation (partial counts per task, then one row per distinct key and task: a
        key or null in a third of the rows is one row of each task); ``limit(1)`` stops at
        the first offender.  A rejected batch is never committed, so no reader can see it.
        """
        bad = (
            keys.groupBy(self.key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col(self.key).isNull() | (F.col("_n") > 1))
            .limit(1)
            .collect()
        )
        if bad:
            value = bad[0][self.key]
            if value is None:
                raise KeyedTableError(f"null value in key column {self.key!r}")
            raise KeyedTableError(f"key {value!r} appears more than once in the batch")

    def _write_checked(self, df: DataFrame, validate: bool) -> str:
        """A batch as a segment, its keys validated.

        A bucketed table's batch is written as it comes first, and shuffled into the buckets
        only when its keys are good: a bad batch never sends a hot key to one task.
        """
        if validate and self.buckets:
            path = scratch_path(self.spark, "batch")
            df.write.parquet(path)
            df = self.spark.read.schema(df.schema).parquet(path)
            self._validate_keys(df.select(self.key))
            return self._write_segment(df)
        segment = self._write_segment(df)
        if validate:
            self._validate_keys(self._stored([segment], schema=self._written_schema).select(self.key))
        return segment

    # --------------------------------------------------------------- writes
    def overwrite(self, df: DataFrame, validate: bool = True) -> int:
        """Replace the table with ``df`` (a new version with one segment)."""
        segment = self._write_checked(self._with_key(df), validate)
        return self._commit([segment], schema=self._written_schema)

    def append(self, df: DataFrame, on_conflict: str = "skip", validate: bool = True,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
        """Insert the batch's rows whose key is not in the table yet.

        ``on_conflict="skip"`` keeps the stored row for a key that already
        exists (appending the same batch twice leaves the table, and its version,
        unchanged); ``"replace"`` stores the batch's row instead.  A batch with a
        null key or a repeated key is rejected whole (``validate``), whether or
        not the table holds that key.

        The batch is computed and staged once, and everything else is decided on
        the staged rows.  Their keys meet the stored table's key column: without a
        shuffle of the table if it is bucketed, by broadcast while the staged keys
        are measured within ``max_broadcast_bytes``, else by a shuffle join.  The
        result is the same in all cases.
        """
        if on_conflict not in ("skip", "replace"):
            raise ValueError("on_conflict must be 'skip' or 'replace'")
        staged = self._write_checked(self._conform(df), validate)
        current = self.segments()
        if not current:
            return self._commit([staged], schema=self._written_schema)
        batch = self._stored([staged])
        keys, small = batch.select(self.key), False
        if not self.buckets:
            keys, small = broadcast_if_small(keys, max_broadcast_bytes, self._key_sizes.get(staged))
            # the file size of sorted keys is a fraction of their size in memory: no broadcast by it
            keys = keys if small else keys.hint("merge")
        conflicts = persist_batch(self._stored(current).select(self.key).join(keys, self.key, "left_semi"))
        try:
            if conflicts.isEmpty():
                return self.version() if batch.isEmpty() else self._commit(current + [staged])
            if on_conflict == "replace":
                return self._commit_later(staged)
            # one row per stored row of a staged key: within the bound if those keys are (and
            # no key has generations)
            known = F.broadcast(conflicts) if small and not any(self._generations.values()) else conflicts
            known = known.hint("merge") if not (small or self.buckets) else known
            fresh = batch.join(known, self.key, "left_anti")
            if fresh.isEmpty():
                return self.version()
            return self._commit(current + [self._write_segment(fresh)])
        finally:
            conflicts.unpersist()

    def _commit_later(self, segment: str) -> int:
        """Publish a segment whose rows replace all stored rows of their keys."""
        current = self.segments()
        generation = 1 + max(self._generations.values(), default=0)
        return self._commit(current + [segment], generations={segment: generation})

    def clone_from(self, other: "KeyedTable") -> int:
        """Make this (empty) table hold exactly ``other``'s current rows, copying no data.

        The new version lists ``other``'s segments by absolute path (for a
        bucketed table: partitions with their own location).  Segments are
        immutable, so later writes to either table never affect the other.
        """
        if self.exists():
            raise KeyedTableError("clone_from needs an empty table")
        if other.key != self.key:
            raise KeyedTableError("tables have different keys")
        other.segments()  # loads the other table's layout
        if (self.buckets or None) not in (None, other.buckets):
            raise KeyedTableError("tables have different bucket counts")
        self.buckets = other.buckets
        shared = [other._path(s) for s in other.segments()]
        other._pin(shared)
        generations = {other._path(s): g for s, g in other._generations.items()}
        return self._commit(shared, schema=other._schema, generations=generations)

    # ---------------------------------------------------------- maintenance
    def _pin(self, paths: list[str]) -> None:
        """Record that another table references these storage paths (see ``vacuum``)."""
        payload = "".join(json.dumps({"path": p}) + "\n" for p in paths).encode("utf-8")
        fs, path = _hadoop_fs(self.spark, f"{self.root}/{_PINS}/{uuid.uuid4().hex}.json")
        out = fs.create(path, False)
        try:
            out.write(bytearray(payload))
        finally:
            out.close()

    def _pinned(self) -> set[str]:
        fs, folder = _hadoop_fs(self.spark, f"{self.root}/{_PINS}")
        if not fs.exists(folder):
            return set()
        pinned = set()
        for status in fs.listStatus(folder):
            stream = fs.open(status.getPath())
            try:
                raw = self.spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
            finally:
                stream.close()
            for line in bytes(raw).decode("utf-8").splitlines():
                if line:
                    pinned.add(_normalise(json.loads(line)["path"]))
        return pinned

    def vacuum(self, retain_versions: int = 1, older_than_seconds: int = 7 * 24 * 3600,
               dry_run: bool = True) -> list[str]:
        """Delete segment folders no retained version (or clone) references.

        Kept: every folder referenced by the newest ``retain_versions``
        committed versions (directly or through one of its files), every
        folder pinned by a clone, and every folder modified within
        ``older_than_seconds`` (it may belong to a write in progress).
        Log files older than the retained versions (and than the same age
        limit) are removed too.  Returns the segment folders removed, or that
        would be with ``dry_run``.
        """
        self._load_log()
        fs, folder = _hadoop_fs(self.spark, self._log_path())
        referenced: set[str] = set()
        kept_versions, oldest_kept = 0, None
        for version in reversed(self._log_versions()):
            entries = self._read_version(version)
            if entries is None:
                continue
            for e in entries:
                if e.get("segment"):
                    referenced.add(_normalise(self._path(e["segment"])))
            kept_versions, oldest_kept = kept_versions + 1, version
            if kept_versions >= retain_versions:
                break
        cutoff_ms = (time.time() - older_than_seconds) * 1000
        # every version file lists the whole table, so older ones are never
        # needed to read the retained versions: they are the log's compaction
        old_logs = [
            st.getPath().toString()
            for st in (fs.listStatus(folder) if fs.exists(folder) else [])
            if (m := _LOG_FILE.match(st.getPath().getName()))
            and oldest_kept is not None
            and int(m.group(1)) < oldest_kept
            and st.getModificationTime() <= cutoff_ms
        ]
        protected = referenced | self._pinned()
        data_root = f"{self.root}/data" if self.buckets else self.root
        fs, base = _hadoop_fs(self.spark, data_root)
        removable = []
        if not fs.exists(base):
            return removable
        for st in fs.listStatus(base):
            name = st.getPath().getName()
            if not st.isDirectory() or not (name.startswith(_SEGMENT_PREFIX) or name.startswith(f"{_SEG}=")):
                continue
            path = _normalise(st.getPath().toString())
            if any(p == path or p.startswith(path + "/") for p in protected):
                continue
            if st.getModificationTime() > cutoff_ms:
                continue
            removable.append(st.getPath().toString())
        if not dry_run:
            for p in removable + old_logs:
                fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p), True)
            if self.buckets and removable and self.spark.catalog.tableExists(self._catalog_name()):
                gone = [self._segment_name(p) for p in removable]
                self._partitions.difference_update(gone)
                self.spark.sql(
                    f"ALTER TABLE {self._catalog_name()} DROP IF EXISTS "
                    + ", ".join(f"PARTITION ({_SEG}='{g}')" for g in gone)
                )
        return removable

    def update(self, assignments: dict[str, Column | object], where: Column | str) -> int:
        """``UPDATE t SET c = v, ... WHERE pred``; rows where ``pred`` is null stay as they are.

        Writes the changed rows only, as a segment of a later generation.
        """
        pred = F.expr(where) if isinstance(where, str) else where
        current = self.segments()
        if not current:
            return self.version()
        columns = self._read(current).columns
        lowered = {c.lower(): c for c in columns}
        targets = {}
        for name, value in assignments.items():
            if name.lower() not in lowered:
                raise KeyedTableError(f"no column {name!r} in table")
            if lowered[name.lower()] == self.key:
                raise KeyedTableError("the key column cannot be updated")
            targets[lowered[name.lower()]] = value if isinstance(value, Column) else F.lit(value)

        hit = self._current().where(pred)
        changed = hit.select(
            *[targets[c].cast(hit.schema[c].dataType).alias(c) if c in targets else F.col(c) for c in columns]
        )
        segment = self._write_segment(changed)
        if self._stored([segment]).isEmpty():
            return self.version()
        return self._commit_later(segment)

    # ---------------------------------------------------------------- reads
    def _current(self) -> DataFrame:
        segments = self.segments()
        if not segments:
            raise KeyedTableError(f"table at {self.root} has no data")
        return self._read(segments)

    def scan(self) -> DataFrame:
        """The current version as a DataFrame (lazy Parquet scan).

        A replicated table comes back with a broadcast hint while its measured
        size is within ``replicated_bytes``.
        """
        df = self._current()
        if not self.replicated:
            return df
        version = self.version()
        if self._replicated_fit is None or self._replicated_fit[0] != version:
            _, fits = broadcast_if_small(df, self.replicated_bytes)
            self._replicated_fit = (version, fits)
        return F.broadcast(df) if self._replicated_fit[1] else df

    def count(self) -> int:
        return self._current().count()

    def lookup(self, key_value) -> DataFrame:
        """Read-through point lookup: the row for ``key_value`` or an empty frame.

        Plain tables prune Parquet row groups with the key's min/max
        statistics (files are sorted by key).  Bucketed tables list and read only
        the one bucket file per segment that can hold the key (Spark's own
        ``pmod(hash(key), buckets)``), until rows have been replaced: then the
        lookup is a filter on the current rows.
        """
        match = F.col(self.key) == F.lit(key_value)
        if not self.buckets or any(self._generations.values()):
            return self._current().where(match).limit(1)
        # Spark names a bucket's files "part-..._<bucket>.c000....parquet"
        schema = self._schema or self._current().schema
        one = self.spark.read.schema(schema).option("pathGlobFilter", f"*_{self._bucket_of(key_value):05d}.c*")
        return one.parquet(*[self._path(s) for s in self.segments()]).where(match).limit(1)

    def _bucket_of(self, key_value) -> int:
        key_type = self._current().schema[self.key].dataType
        bucket = F.pmod(F.hash(F.lit(key_value).cast(key_type)), F.lit(self.buckets))
        return int(self.spark.range(1).select(bucket.alias("b")).first()["b"])

    def lookup_many(self, keys: DataFrame, key_column: str | None = None) -> DataFrame:
        """Rows for every key present in ``keys`` (semi join; no driver-side key list).

        The probe keys are de-duplicated first (a semi join ignores repeats):
        the partial aggregation collapses a key repeated in a third of the
        probe rows before it is shuffled, so no task receives the hot key's rows.
        """
        probe = keys.select(F.col(key_column or self.key).alias(self.key)).distinct()
        return self._current().join(probe, self.key, "left_semi")


def persist_batch(df: DataFrame) -> DataFrame:
    """Keep a batch that feeds several writes; spills to disk instead of recomputing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
