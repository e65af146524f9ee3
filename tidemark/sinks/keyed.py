"""A table with one row per key, changed by copy-on-write merges.

Rows are in immutable Parquet files. A version is a manifest of files; committing one is a
single rename, so readers see a merge wholly or not at all, a job that dies before leaves
nothing but files nobody names, and of two merges at a time one fails and can be repeated.

``<path>/data/<write>/``      rows, sorted by key
``<path>/_filters/<write>/``  Bloom filters of the files of a write, as bitmaps
``<path>/_manifests/<id>/``   files of a version: smallest and greatest key, rows, filter
``<path>/_changes/<id>/``     rows before and after of the merge that made a version
``<path>/_versions/<n>``      names the manifest; carries schema and marks of jobs

A merge asks the manifest which files can hold a changed key: by key range (an equi-join on
pieces of the key space, not a range join), then, if few keys fall in it, by filter. Only those are read, only those
with a row that really changes are written again, and a merge that changes nothing writes
nothing. Nothing is collected but names of files that change. The old and new rows of a merge
are kept with its version, so that what follows the changes can be repeated too; a merge with
a mark that its version already carries gives these again and does nothing.

Keys are numbers; rows without one are left out. The folder must be on a file system whose
rename is atomic.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.bitmaps import BITMAP_BITS, SEEDS, bitmaps_for, filled, is_set, positions
from tidemark.operators.dedup import keep_greatest
from tidemark.session import remove_path, scratch_dir

# With so many keys in a file's range, a filter that knows none of them still lets one pass.
SURE_KEYS = 1000
# While filters of a write are made, every file has its own stretch of bitmap numbers.
_STRETCH = 2**25

_MANIFEST = "file string, rows long, low {key}, high {key}, bitmaps long, write string"

Combine = Callable[[Column, Column], Column]


class Conflict(RuntimeError):
    """Somebody else committed this version first; read the table again and repeat."""


@dataclass(frozen=True)
class Merged:
    """A merge: the version it made (or found, if nothing changed), the changed rows as
    ``old`` and ``new`` (null where there was none), and the files written anew."""

    version: int
    changes: DataFrame
    rewritten: tuple[str, ...]


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    # --- versions ----------------------------------------------------------------------

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self._hadoop(f"{self.path}/_versions")
        if not self._files().exists(folder):
            return []
        names = [entry.getPath().getName() for entry in self._files().listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def _entry(self, version: int | None = None) -> dict:
        """What a version says; by default the last one. An empty table before the first."""
        found = self.versions()
        if version is None:
            version = found[-1] if found else 0
        if version == 0:
            return {"version": 0, "manifest": None, "schema": None, "marks": {}}
        stream = self._files().open(self._hadoop(f"{self.path}/_versions/{version:012d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {"version": version, **json.loads(text)}

    def _commit(self, entry: dict) -> int:
        version = entry["version"] + 1
        kept = {name: value for name, value in entry.items() if name != "version"}
        jvm, files = self.spark._jvm, self._files()
        draft = self._hadoop(f"{self.path}/_versions/.draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(kept).encode()))
        out.close()
        final = self._hadoop(f"{self.path}/_versions/{version:012d}")
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 0)
        conf = self.spark._jsc.hadoopConfiguration()
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
            context.rename(files.makeQualified(draft), files.makeQualified(final), options)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise Conflict(f"{self.path}: version {version} exists") from error
            raise
        return version

    def marks(self) -> dict:
        """What jobs noted with their merges, such as the last batch they took in."""
        return self._entry()["marks"]

    # --- reading -----------------------------------------------------------------------

    def _schema(self, entry: dict) -> StructType:
        return StructType.fromJson(entry["schema"])

    def _manifest(self, entry: dict) -> DataFrame:
        kind = self._schema(entry)[self.key].dataType.simpleString()
        schema = _MANIFEST.format(key=kind)
        if entry["manifest"] is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/_manifests/{entry['manifest']}")

    def _rows(self, entry: dict, names: Sequence[str]) -> DataFrame:
        schema = self._schema(entry)
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}" for name in names])

    def files(self, version: int | None = None) -> list[str]:
        entry = self._entry(version)
        if entry["manifest"] is None:
            return []
        return sorted(r.file for r in self._manifest(entry).select("file").collect())

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the last. Older versions stay readable
        until :meth:`vacuum`."""
        entry = self._entry(version)
        if entry["schema"] is None:
            raise ValueError(f"{self.path} has no version")
        return self._rows(entry, self.files(entry["version"]))

    # --- merging -----------------------------------------------------------------------

    def merge(
        self,
        rows: DataFrame,
        combine: Combine,
        order: Sequence[Column] = (),
        mark: dict | None = None,
        expired: Column | None = None,
    ) -> Merged:
        """Take in ``rows``: of several of one key the greatest by ``order`` counts.

        ``combine(old, new)`` gives the row to be stored from the stored row and the new
        one (structs of the table's columns; ``old`` is null for an unknown key); a null
        keeps the table as it is. ``mark`` is noted in the same commit. Unchanged rows that
        are ``expired`` are left out when their file is written again.
        """
        entry = self._entry()
        if mark and all(entry["marks"].get(name) == value for name, value in mark.items()):
            return Merged(entry["version"], self.changes(entry["version"]), ())
        if entry["schema"] is None:
            entry["schema"] = json.loads(rows.schema.json())
        present = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self._schema(entry)
        ]
        given = rows.filter(F.col(self.key).isNotNull()).select(*present)
        scratch, stored = scratch_dir(self.spark, "fresh"), uuid.uuid4().hex
        keep_greatest(given, [self.key], list(order)).write.parquet(scratch)
        fresh = self.spark.read.schema(self._schema(entry)).parquet(scratch)
        candidates = self._candidates(entry, fresh)
        changes = self._changes(entry, fresh, candidates, combine)
        changes.write.parquet(f"{self.path}/_changes/{stored}")
        remove_path(self.spark, scratch)
        changes = self.spark.read.schema(changes.schema).parquet(f"{self.path}/_changes/{stored}")
        found = changes.agg(
            F.count("*").alias("n"), F.array_compact(F.collect_set("file")).alias("files")
        ).first()
        touched = tuple(name for name in candidates if zlib.crc32(name.encode()) in found.files)
        entry["changes"] = stored if found.n else None
        if found.n:
            entry["manifest"] = self._rewrite(entry, changes, touched, expired)
        else:
            remove_path(self.spark, f"{self.path}/_changes/{stored}")
            if not mark:
                return Merged(entry["version"], self._no_changes(entry), ())
        entry["marks"].update(mark or {})
        version = self._commit(entry)
        return Merged(version, self.changes(version), touched)

    def changes(self, version: int | None = None) -> DataFrame:
        """The rows that the merge of a version changed, as ``old`` and ``new``."""
        entry = self._entry(version)
        stored = entry.get("changes")
        if stored is None:
            return self._no_changes(entry)
        return self.spark.read.schema(self._no_changes(entry).schema).parquet(
            f"{self.path}/_changes/{stored}"
        )

    def _no_changes(self, entry: dict) -> DataFrame:
        row = self._schema(entry)
        return self.spark.createDataFrame([], StructType().add("old", row).add("new", row))

    def upsert(
        self, rows: DataFrame, columns: Sequence[str], order: Sequence[Column] = (), **options
    ) -> Merged:
        """Known keys take ``columns`` from ``rows``, unknown keys are added whole."""

        def combine(old: Column, new: Column) -> Column:
            updated = old
            for name in columns:
                updated = updated.withField(name, new[name])
            return F.when(old.isNull(), new).otherwise(updated)

        return self.merge(rows, combine, order, **options)

    def insert_absent(self, rows: DataFrame, order: Sequence[Column] = (), **options) -> Merged:
        """Unknown keys are added, known ones never change: no file is written again."""
        return self.merge(rows, lambda old, new: F.when(old.isNull(), new), order, **options)

    def advance(
        self, rows: DataFrame, order: Callable[[Column], Sequence[Column]], **options
    ) -> Merged:
        """A row replaces the stored one if it is greater by ``order``, whatever arrives
        first; taking in the same rows again changes nothing."""

        def combine(old: Column, new: Column) -> Column:
            later = F.struct(*order(new)) > F.struct(*order(old))
            return F.when(old.isNull() | later, new)

        return self.merge(rows, combine, order(F.struct("*")), **options)

    def _candidates(self, entry: dict, fresh: DataFrame) -> list[str]:
        """Files that can hold a key of ``fresh``."""
        if entry["manifest"] is None:
            return []
        manifest = self._manifest(entry)
        span = manifest.agg(
            F.min(F.col("low").cast("double")).alias("low"),
            F.avg(F.col("high").cast("double") - F.col("low").cast("double")).alias("width"),
            F.collect_set("write").alias("writes"),
        ).first()
        # Pieces as wide as the mean file: two a file in all, whether files overlap or not.
        width = max(1.0, span.width)

        def piece(key: Column) -> Column:
            return F.floor((key.cast("double") - span.low) / width)

        pieces = F.explode(F.sequence(piece(F.col("low")), piece(F.col("high"))))
        ranges = manifest.select("file", "low", "high", "bitmaps", pieces.alias("piece"))
        key = F.col(self.key)

        def in_range(ranges: DataFrame) -> DataFrame:
            placed = fresh.select(self.key, piece(key).alias("piece")).join(ranges, "piece")
            return placed.filter(key.between(F.col("low"), F.col("high")))

        # A file that is read in vain changes nothing, so a filter is asked only if it may say no.
        counts = in_range(ranges).groupBy("file").count().collect()
        sure = [r.file for r in counts if r["count"] >= SURE_KEYS]
        unsure = [(r.file,) for r in counts if r["count"] < SURE_KEYS]
        if not unsure:
            return sorted(sure)
        asked = ranges.join(self.spark.createDataFrame(unsure, "file string"), "file")
        bit = F.explode(F.array(*positions(key, F.col("bitmaps")))).alias("bit")
        bits = in_range(asked).select(self.key, "file", bit)
        bits = bits.withColumn("bitmap_number", F.expr(f"bit div {BITMAP_BITS}"))
        filters = self.spark.read.schema("file string, bitmap_number long, bitmap binary").parquet(
            *[f"{self.path}/_filters/{write}" for write in span.writes]
        )
        hits = bits.join(filters, ["file", "bitmap_number"]).filter(is_set("bitmap", "bit"))
        possible = hits.groupBy(self.key, "file").count().filter(F.col("count") == len(SEEDS))
        return sorted([*sure, *(r.file for r in possible.select("file").distinct().collect())])

    def _changes(
        self, entry: dict, fresh: DataFrame, candidates: list[str], combine: Combine
    ) -> DataFrame:
        """``key, file, old, new`` of the rows that change; ``file`` is null for new ones, else
        the checksum of the file's name, as the name would make up half of what is shuffled.
        Of two files with one checksum both would be written again."""
        names = self._schema(entry).fieldNames()
        whole = F.struct(*names)
        held = self._rows(entry, candidates).select(
            self.key, F.crc32(self._file_of_row()).alias("file"), whole.alias("old")
        )
        pairs = fresh.select(self.key, whole.alias("fresh")).join(held, self.key, "left")
        new = combine(F.col("old"), F.col("fresh"))
        return pairs.select(self.key, "file", "old", new.alias("new")).filter(
            F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("old"))
        )

    def _file_of_row(self) -> Column:
        return F.substring_index(F.input_file_name(), "/", -3)

    def _rewrite(
        self, entry: dict, changes: DataFrame, touched: Sequence[str], expired: Column | None
    ) -> str:
        """Write the changed rows with the other rows of their files."""
        return self._replace(entry, self._merged(entry, changes, touched, expired), touched)

    def _merged(
        self, entry: dict, changes: DataFrame, touched: Sequence[str], expired: Column | None
    ) -> DataFrame:
        """The rows to be written, dealt by key range. Old and changed rows of a key meet only
        there, so that both are moved once and the sample for the ranges reads files, no join."""
        names = self._schema(entry).fieldNames()
        rows = changes.select("new.*").select(*names)
        if not touched:
            return rows.repartitionByRange(self.key)
        rest = self._rows(entry, touched)
        if expired is not None:
            # A row that changes is not left out: its new row is among the changes.
            rest = rest.filter(~F.coalesce(expired, F.lit(False)))
        both = rows.withColumn("_old", F.lit(0)).unionByName(rest.withColumn("_old", F.lit(1)))
        newest = Window.partitionBy(self.key).orderBy("_old")  # two rows at most
        return (
            both.repartitionByRange(self.key)
            .withColumn("_place", F.row_number().over(newest))
            .filter(F.col("_place") == 1)
            .select(*names)
        )

    def _replace(self, entry: dict, rows: DataFrame, touched: Sequence[str]) -> str:
        """Files with ``rows``, dealt by key range, and a manifest that names them in place of
        ``touched``."""
        write = uuid.uuid4().hex
        data = f"{self.path}/data/{write}"
        rows.sortWithinPartitions(self.key).write.parquet(data)
        written = self.spark.read.schema(self._schema(entry)).parquet(data)
        added = (
            written.select(F.input_file_name().alias("path"), self.key)
            .groupBy("path")
            .agg(
                F.count("*").alias("rows"),
                F.min(self.key).alias("low"),
                F.max(self.key).alias("high"),
            )
            .withColumn("file", F.substring_index("path", "/", -3))
            .drop("path")
        )
        manifest = added.withColumns({"bitmaps": bitmaps_for(F.col("rows")), "write": F.lit(write)})
        if entry["manifest"] is not None:
            kept = self._manifest(entry)
            if touched:
                gone = self.spark.createDataFrame([(name,) for name in touched], "file string")
                kept = kept.join(gone, "file", "left_anti")
            manifest = kept.unionByName(manifest)
        name = uuid.uuid4().hex
        manifest.hint("rebalance").write.parquet(f"{self.path}/_manifests/{name}")
        sizes = self._manifest({**entry, "manifest": name}).filter(F.col("write") == write)
        self._write_filters(written, sizes.select("file", "bitmaps").collect(), write)
        return name

    def _write_filters(self, written: DataFrame, sizes: Sequence, write: str) -> None:
        """The filters of the files of a write. One number stands for file and bitmap, by which
        bits are sorted faster than by names."""
        numbered = [(number, row.file, row.bitmaps) for number, row in enumerate(sizes)]
        files = self.spark.createDataFrame(numbered, "number long, file string, bitmaps long")
        keys = written.select(self._file_of_row().alias("file"), self.key).join(files, "file")
        first = F.col("number") * (_STRETCH * BITMAP_BITS)
        bit = F.explode(
            F.array(*[first + place for place in positions(F.col(self.key), F.col("bitmaps"))])
        )
        bitmaps = filled(keys.select(bit.alias("bit"))).withColumn(
            "number", F.expr(f"bitmap_number div {_STRETCH}")
        )
        bitmaps.join(files, "number").select(
            "file", F.expr(f"bitmap_number % {_STRETCH}").alias("bitmap_number"), "bitmap"
        ).write.parquet(f"{self.path}/_filters/{write}")

    # --- upkeep ------------------------------------------------------------------------

    def compact(self, min_rows: int = 1_000_000) -> tuple[str, ...]:
        """Write the rows of small files anew, sorted by key into files of the advisory size;
        returns the files replaced. Contents, marks and changes stay as they are."""
        entry = self._entry()
        if entry["manifest"] is None:
            return ()
        small = self._manifest(entry).filter(F.col("rows") < min_rows)
        names = tuple(sorted(r.file for r in small.select("file").collect()))
        if len(names) < 2:
            return ()
        rows = self._rows(entry, names).repartitionByRange(self.key)
        entry["manifest"] = self._replace(entry, rows, names)
        self._commit(entry)
        return names

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete what the last ``keep`` versions do not name: files, filters, manifests,
        changes and older versions. Not while a merge is running. Returns the files deleted."""
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        entries = [self._entry(v) for v in kept]
        used = {name for v in kept for name in self.files(v)}
        writes = {name.split("/")[1] for name in used}
        manifests = {entry["manifest"] for entry in entries}
        changes = {entry.get("changes") for entry in entries}
        for version in old:
            remove_path(self.spark, f"{self.path}/_versions/{version:012d}")
        deleted = []
        for write in self._names("data"):
            for name in self._names(f"data/{write}"):
                file = f"data/{write}/{name}"
                if write not in writes or (name.startswith("part-") and file not in used):
                    remove_path(self.spark, f"{self.path}/{file}")
                    deleted += [file] if name.startswith("part-") else []
        unused = [f"data/{w}" for w in self._names("data") if w not in writes]
        unused += [f"_filters/{w}" for w in self._names("_filters") if w not in writes]
        unused += [f"_manifests/{m}" for m in self._names("_manifests") if m not in manifests]
        unused += [f"_changes/{c}" for c in self._names("_changes") if c not in changes]
        for name in unused:
            remove_path(self.spark, f"{self.path}/{name}")
        return deleted

    def _names(self, folder: str) -> list[str]:
        path = self._hadoop(f"{self.path}/{folder}")
        if not self._files().exists(path):
            return []
        return sorted(entry.getPath().getName() for entry in self._files().listStatus(path))
