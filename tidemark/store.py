"""A collection of series and metadata in one folder.

Samples and upload listings are only ever added to. An upload counts once its
listing is written, which is the last thing to happen: samples of an upload that
broke off are in no listing and are never read. Series, metadata and links
are logs: a change appends a row with a higher version, and the newest version
of a key counts. Nothing is rewritten in place, so a reader never meets a
half-written table; :meth:`SeriesStore.compact` rewrites the logs into a new
folder. One writer at a time is assumed.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeaxis import long_lit
from tidemark.operators import aggregate as agg
from tidemark.operators import ingest, read
from tidemark.operators import metadata as md
from tidemark.operators.ingest import next_file_seq
from tidemark.operators.joins import lookup_join
from tidemark.operators.overlay import contested_days
from tidemark.operators.validate import index_faults
from tidemark.schema import EMPTY_FIRST, EMPTY_LAST, LINKS, MANIFEST, METADATA, SAMPLES_RAW, SERIES
from tidemark.session import make_folder, settle, use_utc
from tidemark.sinks.rewrite import merge_contested
from tidemark.sinks.samples import write_samples
from tidemark.sources.samples import from_pandas, from_series
from tidemark.streaming.ingest import (
    prepare,
    read_ingest_manifest,
    read_ingested,
    read_receipts,
    stream_ingest,
)

_VERSION = [T.StructField("version", T.LongType()), T.StructField("deleted", T.BooleanType())]


class SeriesStore:
    """Create, append, read, aggregate, search and delete series."""

    def __init__(self, spark: SparkSession, root: str, *, user: str | None = None):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.user = user
        for name, schema in self._logs.items():
            # Does nothing if the folder is there already.
            spark.createDataFrame([], schema).write.mode("ignore").parquet(self._path(name))
        make_folder(spark, self._path("queue"))
        prepare(spark, self._path("ingest"))

    # -- tables ------------------------------------------------------------

    _logs = {
        "samples": SAMPLES_RAW,
        "manifest": MANIFEST,
        "queued": MANIFEST,
        "series": T.StructType([*SERIES.fields, *_VERSION]),
        "metadata": T.StructType([*METADATA.fields, *_VERSION]),
        "links": T.StructType([*LINKS.fields, *_VERSION]),
    }

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _known_samples(self, listing: DataFrame) -> DataFrame:
        """Samples before overlay, direct uploads and the queue's, of listed uploads."""
        queued = read_ingested(self.spark, self._path("ingest"))
        uploads = listing.select("file_id").distinct()
        return lookup_join(self._read("samples").unionByName(queued), uploads, ["file_id"], "left_semi")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._logs[name]).parquet(self._path(name))

    def _current(self, name: str, keys: list[str]) -> DataFrame:
        """Newest version of every key that is not deleted."""
        log = self._read(name)
        rest = [c for c in log.columns if c not in (*keys, "version", "deleted")]
        newest = log.groupBy(*keys).agg(
            F.max_by("deleted", "version").alias("deleted"),
            *[F.max_by(c, "version").alias(c) for c in rest],
        )
        columns = [c for c in log.columns if c not in ("version", "deleted")]
        return newest.filter(~F.col("deleted")).select(*columns)

    def _log(self, name: str, rows: DataFrame, *, deleted: bool = False) -> None:
        stamped = rows.withColumns(
            {"version": long_lit(time.time_ns()), "deleted": F.lit(deleted)}
        )
        stamped.select(*self._logs[name].fieldNames()).write.mode("append").parquet(
            self._path(name)
        )

    @property
    def samples(self) -> DataFrame:
        """All uploaded samples, before overlay."""
        return self._known_samples(self.manifest)

    @property
    def manifest(self) -> DataFrame:
        queued = read_ingest_manifest(self.spark, self._path("ingest"))
        return self._read("manifest").unionByName(queued)

    @property
    def series(self) -> DataFrame:
        return self._current("series", ["series_id"])

    @property
    def metadata(self) -> DataFrame:
        return self._current("metadata", ["namespace", "key"])

    @property
    def links(self) -> DataFrame:
        return self._current("links", ["series_id", "metadata_id"])

    # -- series ------------------------------------------------------------

    def _as_rows(self, data, *more: str) -> DataFrame:
        """``pos, index, value`` of a pandas Series or of a frame with them."""
        if not isinstance(data, DataFrame):
            data = from_pandas(self.spark, data)
        missing = {"pos", "index", "value", *more} - set(data.columns)
        if missing:
            raise ValueError(f"a series needs pos, index and value; missing: {sorted(missing)}")
        return data

    def _check(self, rows: DataFrame) -> None:
        """Every series of an upload must be sorted and unique on its index."""
        faults = index_faults(rows, ["series_id"], ["pos"]).agg(
            *[F.sum(n).alias(n) for n in ("n_unreadable", "n_back", "n_repeat")]
        ).first()
        if faults.n_unreadable:
            raise ValueError("every sample must have an index")
        if faults.n_back:
            raise ValueError("the index steps back: sort the samples by it first")
        if faults.n_repeat:
            raise ValueError("an index occurs more than once")

    def _upload(self, rows: DataFrame, series_id, wait: bool) -> str:
        """Check and write samples of one or many series; returns the upload's id.

        The listing is written last; an upload that waits for the queue is
        listed as queued, with the number it got when it came.
        """
        samples = from_series(rows, "index", "value", series_id, keep=["pos"])
        self._check(samples)
        listed = next_file_seq(self.manifest.unionByName(self._read("queued")))
        file_id, file_seq = str(uuid.uuid4()), max(time.time_ns(), listed)
        upload = ingest.as_upload(samples, file_seq, file_id)
        write_samples(upload, self._path("samples"))
        listing = self._path("manifest" if wait else "queued")
        ingest.manifest_of(upload).write.mode("append").parquet(listing)
        return file_id

    def _receipt(self, file_id: str, series_id: str, wait: bool) -> dict:
        if not wait:
            return {"FileId": file_id, "TimeSeriesId": series_id, "State": "Queued"}
        extent = self._extents().filter(F.col("series_id") == series_id).first()
        return {
            "FileId": file_id,
            "TimeSeriesId": series_id,
            "TimeOfFirstSample": extent.first_index if extent else EMPTY_FIRST,
            "TimeOfLastSample": extent.last_index if extent else EMPTY_LAST,
        }

    def _require_series(self, series_id: str) -> None:
        if self.series.filter(F.col("series_id") == series_id).isEmpty():
            raise ValueError(f"there is no series {series_id}")

    def create(self, data=None, *, wait_on_verification: bool = True, aliases=()) -> dict:
        """New series, empty or with its first samples; returns the receipt."""
        series_id = str(uuid.uuid4())
        receipt = {
            "TimeSeriesId": series_id,
            "TimeOfFirstSample": EMPTY_FIRST,
            "TimeOfLastSample": EMPTY_LAST,
        }
        if data is not None:
            file_id = self._upload(self._as_rows(data), series_id, wait_on_verification)
            receipt = self._receipt(file_id, series_id, wait_on_verification)
        new = ingest.create_empty(self.spark.createDataFrame([], SERIES), [series_id])
        names = F.array(*map(F.lit, aliases)).cast("array<string>")
        self._log("series", new.withColumn("aliases", names))
        return receipt

    def append(self, data, series_id: str, *, wait_on_verification: bool = True) -> dict:
        """More samples for a series; where indices overlap the new ones win."""
        self._require_series(series_id)
        file_id = self._upload(self._as_rows(data), series_id, wait_on_verification)
        return self._receipt(file_id, series_id, wait_on_verification)

    def create_many(self, data: DataFrame, name: str = "name") -> DataFrame:
        """A new series per value of column ``name``, which becomes its alias.

        ``data`` has ``name, pos, index, value``; all of it is one upload.
        Returns ``name, series_id``.
        """
        rows = self._as_rows(data, name)
        ids = settle(rows.select(name).distinct().withColumn("series_id", F.uuid()), "new-series")
        keyed = lookup_join(rows, ids, [name])
        self._upload(keyed, F.col("series_id"), True)
        new = ids.select(
            "series_id", F.array(F.col(name).cast("string")).alias("aliases"), F.current_timestamp().alias("created")
        )
        self._log("series", new)
        return ids.select(name, "series_id")

    def append_many(self, data: DataFrame) -> str:
        """One upload of samples for many series: ``series_id, pos, index, value``."""
        rows = self._as_rows(data, "series_id")
        unknown = rows.select("series_id").distinct().join(self.series, "series_id", "left_anti").first()
        if unknown is not None:
            raise ValueError(f"there is no series {unknown.series_id}")
        return self._upload(rows, F.col("series_id"), True)

    def set_aliases(self, series_id: str, *aliases: str) -> None:
        """Other names of a series; they replace the ones it had."""
        self._require_series(series_id)
        one = self.series.filter(F.col("series_id") == series_id)
        names = F.array(*map(F.lit, aliases)).cast("array<string>")
        self._log("series", settle(one.withColumn("aliases", names), "aliases"))

    def process_queue(self) -> DataFrame:
        """Take in what was queued: uploads that did not wait, which are listed
        now, and chunk files put into the folder ``queue``. Returns the receipts
        of all files so far."""
        out, manifest = self._path("ingest"), self._read("manifest")
        queued = self._read("queued")
        new = settle(queued.join(manifest.select("file_id").distinct(), "file_id", "left_anti"), "queued")
        new.select(*MANIFEST.fieldNames()).write.mode("append").parquet(self._path("manifest"))
        stream_ingest(
            self.spark,
            self._path("queue"),
            out,
            self._path("ingest_state"),
            once=True,
            above=next_file_seq(self._read("manifest")) - 1,
        ).awaitTermination()
        none = self.spark.createDataFrame([], "series_id string, file_id string, state string")
        return read_receipts(self.spark, out).unionByName(ingest.receipts_of(queued, none))

    def compact(self, root: str, *, merge: bool = False) -> SeriesStore:
        """The same collection in a new folder, with what no longer counts left
        out: superseded log rows, deleted series, their samples and uploads that
        broke off. Samples are not overlaid, so listings stay true. With ``merge``
        the days of a series that several uploads touched are folded into one
        upload, so that later reads of them need no shuffle."""
        new = SeriesStore(self.spark, root, user=self.user)
        alive = settle(self.series.select("series_id"), "alive")
        manifest = settle(lookup_join(self.manifest, alive, ["series_id"], "left_semi"), "manifest")
        samples = lookup_join(self._known_samples(manifest), alive, ["series_id"], "left_semi")
        write_samples(samples, new._path("samples"))
        for name, rows in (("series", self.series), ("metadata", self.metadata), ("links", self.links)):
            new._log(name, rows)
        if merge:
            manifest = merge_contested(self.spark, new._path("samples"), manifest)
        manifest.write.mode("append").parquet(new._path("manifest"))
        return new

    def delete(self, series_id: str) -> None:
        """Remove a series and its links. An unknown id changes nothing."""
        gone = self.spark.createDataFrame([(series_id,)], "series_id string")
        links = self.links.filter(F.col("series_id") == series_id)
        self._log("links", links, deleted=True)
        known = self.series.join(F.broadcast(gone), "series_id", "left_semi")
        self._log("series", known, deleted=True)

    # -- reading -----------------------------------------------------------

    def _known(self, series):
        """The ids asked for, without deleted ones; None if that is all there is."""
        if series is None:
            ever = self._read("series").filter("deleted")
            return None if ever.isEmpty() else self.series.select("series_id")
        current = self.series.select("series_id")
        if isinstance(series, str):
            # A plain id reaches the file scan as a filter.
            self._require_series(series)
            return series
        if isinstance(series, DataFrame):
            return current.join(series.select("series_id"), "series_id", "left_semi")
        return current.filter(F.col("series_id").isin(list(series)))

    def _kind(self, listing: DataFrame) -> str:
        """``numeric``, ``text`` or ``both``: what has to be read."""
        kinds = listing.select("kind").distinct().collect()
        names = {row.kind for row in kinds}
        return names.pop() if len(names) == 1 else "both"

    def _listing(self, series) -> DataFrame:
        """What was uploaded of these series, worked out once for a whole call."""
        return settle(read.of_series(self.manifest, series), "listing")

    def get(
        self, series_id, start=None, end=None, *, convert_date: bool = True, raise_empty: bool = False
    ) -> DataFrame:
        """Samples of one, several or (None) all series in ``[start, end)``.

        The columns are always ``series_id, index, value, value_text``, and
        ``time`` if wanted. An unknown id is an error, alone; in a list or frame it has no rows.
        """
        known = self._known(series_id)
        listing = self._listing(known)
        return read.get(
            self._known_samples(listing),
            known,
            start,
            end,
            kind=self._kind(listing),
            contested=contested_days(listing),
            convert_date=convert_date,
            raise_empty=raise_empty,
            all_values=True,
        )

    def get_samples_aggregate(
        self,
        series_id,
        start=None,
        end=None,
        *,
        aggregation_period: str | None = None,
        aggregation_function: str | None = None,
        include_empty_aggregations: bool = False,
    ) -> DataFrame:
        """One value per series and period in ``[start, end)``."""
        known = self._known(series_id)
        listing = self._listing(known)
        kind = self._kind(listing)
        if aggregation_function and kind == "text":
            raise ValueError("these series hold text, which has no aggregates")
        return agg.aggregate(
            self._known_samples(listing),
            start,
            end,
            aggregation_period,
            aggregation_function,
            include_empty=include_empty_aggregations,
            series=known,
            contested=contested_days(listing),
            check_text=kind != "numeric",
        )

    # -- information and search --------------------------------------------

    def _extents(self) -> DataFrame:
        """Extents from the listing; no sample is read."""
        return self.manifest.groupBy("series_id").agg(
            F.min("first_index").alias("first_index"), F.max("last_index").alias("last_index")
        )

    def _all_extents(self) -> DataFrame:
        return agg.fill_extents(
            self.series, self._extents().withColumn("n_samples", F.lit(None).cast("bigint"))
        ).drop("n_samples")

    def info(self, series_id: str) -> DataFrame:
        """Extent, aliases and metadata of a series, one row per entry."""
        self._require_series(series_id)
        one = self._all_extents().filter(F.col("series_id") == series_id)
        return md.series_info(
            one, self.links.filter(F.col("series_id") == series_id), self.metadata
        )

    def search(self, namespace, key=None, name=None, value=None) -> DataFrame:
        return md.search(self.links, self.metadata, namespace, key, name, value)

    # -- metadata ----------------------------------------------------------

    def _one_update(self, namespace: str, key: str, namevalues: dict) -> DataFrame:
        text = {k: None if v is None else str(v) for k, v in namevalues.items()}
        return self.spark.createDataFrame(
            [(namespace, key, text)], "namespace string, key string, value map<string,string>"
        )

    def metadata_set(self, namespace: str, key: str, **namevalues) -> str:
        """Create or update an entry; returns its id."""
        return self._put_entry(namespace, key, True, namevalues)

    def _put_entry(self, namespace: str, key: str, overwrite: bool, namevalues: dict) -> str:
        update = self._one_update(namespace, key, namevalues)
        known = self.metadata.filter((F.col("namespace") == namespace) & (F.col("key") == key))
        entry = md.create_metadata(known, update, overwrite=overwrite, user=self.user)
        row = entry.first()
        self._log("metadata", self.spark.createDataFrame([row], METADATA))
        return row.metadata_id

    def set_metadata(
        self,
        series_id: str,
        metadata_id: str | None = None,
        namespace: str | None = None,
        key: str | None = None,
        overwrite: bool = False,
        **namevalues,
    ) -> DataFrame:
        """Link a series to an entry, made first unless its id is given."""
        self._require_series(series_id)
        if md.names_an_entry(metadata_id, namespace, key):
            if self.metadata.filter(F.col("metadata_id") == metadata_id).isEmpty():
                raise ValueError(f"there is no metadata entry {metadata_id}")
        else:
            metadata_id = self._put_entry(namespace, key, overwrite, namevalues)
        self._log("links", self._link(series_id, metadata_id))
        return self.info(series_id)

    def remove_metadata(self, series_id: str, metadata_id: str) -> DataFrame:
        """Break a link; the entry stays."""
        self._log("links", self._link(series_id, metadata_id), deleted=True)
        return self.info(series_id)

    def _link(self, series_id: str, metadata_id: str) -> DataFrame:
        return self.spark.createDataFrame([(series_id, metadata_id)], LINKS)

    def metadata_get(self, metadata_id=None, namespace=None, key=None) -> DataFrame:
        """An entry; by id with the series attached to it."""
        entry = md.metadata_get(self.metadata, metadata_id, namespace, key)
        if not metadata_id:
            return entry
        links = self.links.filter(F.col("metadata_id") == metadata_id)
        return md.metadata_with_series(entry, links, self._all_extents())

    def metadata_browse(self, namespace: str | None = None) -> DataFrame:
        return md.metadata_browse(self.metadata, namespace)

    def metadata_search(self, namespace: str, key: str) -> DataFrame:
        return md.metadata_search(self.metadata, namespace, key)

    def metadata_delete(self, metadata_id: str) -> None:
        """Remove an entry and its links."""
        self._log("links", self.links.filter(F.col("metadata_id") == metadata_id), deleted=True)
        self._log(
            "metadata", self.metadata.filter(F.col("metadata_id") == metadata_id), deleted=True
        )
