"""The payments table as Parquet files under one folder.

Rows lie in ``data/part=<id>/event_day=<day>/``. A part is written once and never
changed. A small state file per version lists the parts of each day, so a reader
sees one consistent version and a new version appears in a single rename.

An upsert appends the batch as a new part. Only where a key is already stored are
the files holding it written again without it and marked as replaced, so the usual
batch of new keys costs no rewrite. ``compact`` joins the small parts of a day, ``vacuum`` removes
the files that no kept version needs. One writer at a time; a second one that
commits the same version fails.

Before a commit, what it changes is added up per hour, currency and status into a folder of
``rollup/``: rows that came count up, rows that were replaced count down. The sum over the
folders that a version lists is what it holds, so windows and reports that only add up read
no payment, and late rows and overwrites count like any others.
"""

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centstream.contract import TABLE_COLUMNS, TABLE_DDL, VALID_COLUMNS
from centstream.operators.quality import observed
from centstream.operators.reports import (
    DEFAULT_RECENT,
    MAX_RECENT,
    changes_of,
    hourly_activity,
    of_currency,
    recent_limit,
    recent_payments,
    summed,
)
from centstream.operators.upsert import one_row_per_key, with_raw_event
from centstream.session import require_utc
from centstream.sources.files import Folder

LOGGER = logging.getLogger(__name__)

STORED_DDL = TABLE_DDL + ", part STRING, event_day DATE"
ROLLUP_DDL = (
    "hour TIMESTAMP, currency STRING, payment_status STRING, event_count BIGINT, "
    "successful_count BIGINT, successful_amount DECIMAL(38,3)"
)
MET_DDL = "event_id STRING, part STRING, event_day DATE, file STRING, copy BOOLEAN"

# Where an upsert looks for an already stored copy of a key.
WHOLE_TABLE = "table"
SAME_DAY = "day"
KEY_SCOPES = (WHOLE_TABLE, SAME_DAY)

# Kinds of part: written by an upsert, or joined by ``compact``.
LOOSE = "loose"
JOINED = "joined"

# Keys of a batch are sent to every executor up to this many bytes of key text,
# so that the table is not shuffled; beyond it both sides are.
MAX_BROADCAST_KEY_BYTES = 64 * 1024 * 1024

# Batches of up to this many keys are looked up by value: row groups whose Bloom filter or
# dictionary has none of them are skipped. Larger ones read the key column.
MAX_LOOKUP_KEYS = 2000
IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"
# With so many keys asked for, one in five hundred row groups is read for nothing.
KEY_FILTER = {
    "parquet.bloom.filter.enabled#event_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.fpp#event_id": "0.000001",
    "parquet.bloom.filter.max.bytes": str(8 * 1024 * 1024),
}


class Piece(NamedTuple):
    """One day of one part, less the files that later parts replaced."""

    part: str
    day: str
    replaced: tuple[str, ...] = ()


class StoredFile(NamedTuple):
    part: str
    day: str
    name: str


@dataclass(frozen=True)
class TableState:
    """One version: per day its parts with their replaced files; per stream its last batch.

    ``rollup`` lists the folders that add up to it; None in tables from before there were any.
    ``stored`` counts the rows that each stream has written so far.
    """

    version: int = 0
    days: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    rollup: list[str] | None = field(default_factory=list)
    stored: dict[str, int] = field(default_factory=dict)

    def pieces(self, days: Iterable[str] | None = None) -> list[Piece]:
        wanted = self.days if days is None else [day for day in days if day in self.days]
        return [
            Piece(part, day, tuple(replaced))
            for day in wanted
            for part, replaced in self.days[day].items()
        ]

    def changed(
        self,
        added: Iterable[Piece] = (),
        dropped: Iterable[Piece] = (),
        replaced: Iterable[StoredFile] = (),
    ) -> "TableState":
        days = {
            day: {part: list(files) for part, files in parts.items()}
            for day, parts in self.days.items()
        }
        for file in replaced:
            days[file.day][file.part].append(file.name)
        for piece in dropped:
            del days[piece.day][piece.part]
        for piece in added:
            days.setdefault(piece.day, {})[piece.part] = []
        kept = {day: parts for day, parts in sorted(days.items()) if parts}
        rollup = None if self.rollup is None else list(self.rollup)
        return TableState(self.version + 1, kept, dict(self.streams), rollup, dict(self.stored))


class PaymentsTable:
    """The table at ``root``; with ``version``, as it was then, to be read only."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        require_utc(spark)
        self.spark = spark
        self.version = version
        self.root = root.rstrip("/")
        self._data = f"{self.root}/data"
        self._files = Folder(spark, self.root)

    # Reading

    def state(self, version: int | None = None) -> TableState:
        """The given version, or that of this object, or the latest."""
        if version is None:
            version = self.version
        if version is None:
            version = max(self._version_ages(), default=0)
        if version == 0:
            return TableState()
        body = json.loads(self._files.read_text(self._state_name(version)))
        return TableState(**{"rollup": None} | body)

    def read(
        self, version: int | None = None, days: Iterable[str] | None = None
    ) -> DataFrame:
        """Payments of one version, with the partition column ``event_day``.

        ``days`` narrows it to some days without looking at the others' files.
        """
        return self._scan(self.state(version).pieces(days)).drop("part")

    def pinned(self) -> "PaymentsTable":
        """The latest version, for reports that shall agree."""
        return PaymentsTable(self.spark, self.root, self.state().version)

    def rollup(self, version: int | None = None) -> DataFrame:
        """Events, successes and their amount per hour, currency and status. Reads no payment."""
        return self._added_up(version, F.col("hour"))

    def totals(self, version: int | None = None) -> DataFrame:
        """Day totals of one version, for the reports that take them. Reads no payment."""
        return self._added_up(version, F.to_date("hour").alias("event_day"))

    def _added_up(self, version: int | None, when: Column) -> DataFrame:
        state = self.state(version)
        if state.rollup is None:
            changes = changes_of(self.read(state.version).withColumn("sign", F.lit(1)))
        else:
            changes = self._changes(state.rollup)
        return summed(changes, when).where("event_count > 0")

    def recent(
        self,
        currency: str,
        limit: int = DEFAULT_RECENT,
        version: int | None = None,
        ceiling: int = MAX_RECENT,
    ) -> DataFrame:
        """Latest payments of a currency, reading only as many days as needed.

        The day totals say which: the newest with payments of the currency, until they
        hold enough. They are asked when the result is, and older days are then pruned.
        """
        state = self.state(version)
        wanted = recent_limit(limit, ceiling)
        days = of_currency(self.totals(state.version), currency).groupBy("event_day")
        days = days.agg(F.sum("event_count").alias("events"))  # a row per day
        newer = Window.orderBy(F.desc("event_day")).rowsBetween(Window.unboundedPreceding, -1)
        held = F.coalesce(F.sum("events").over(newer), F.lit(0))
        oldest = days.withColumn("held", held).where(F.col("held") < wanted).agg(F.min("event_day"))
        rows = self._scan(state.pieces()).where(F.col("event_day") >= oldest.scalar())
        return recent_payments(rows, currency, limit, ceiling)

    def hourly(self, currency: str, as_of: datetime | None = None) -> DataFrame:
        """The hourly activity report; older days are pruned."""
        return hourly_activity(self.read(), currency, as_of)

    # Writing

    def upsert(
        self,
        batch: DataFrame,
        stream: str = "default",
        batch_id: int | None = None,
        key_scope: str = WHOLE_TABLE,
        unique: bool = False,
        first_wins: str | None = None,
    ) -> TableState:
        """Insert valid payments; a stored row with the same ``event_id`` is replaced.

        With ``first_wins``, an interval such as ``"1 day"``, the stored row stays
        instead, unless the new one's event time is that much later.

        A ``batch_id`` that ``stream`` has committed already changes nothing.
        ``key_scope`` says where stored copies are looked for. ``"table"`` is
        always right and reads the key column of every day. ``"day"`` reads that
        of the batch's own days only; it is right when a key's ``event_time``
        never changes, as for plain redeliveries. ``unique`` is for batches known
        to hold each key once, and saves reducing them again.
        """
        if key_scope not in KEY_SCOPES:
            raise ValueError(f"key_scope is {key_scope!r}; use one of {KEY_SCOPES}")
        before = self.state()
        if batch_id is not None and batch_id <= before.streams.get(stream, -1):
            LOGGER.info("stream=%s batch_id=%s is stored already", stream, batch_id)
            return before

        # Writing the batch first evaluates it exactly once. All later steps read
        # the files, and a lost executor cannot make them see another result.
        missing = F.raise_error(F.lit("a payment has no event_id")).cast("string")
        keyed = batch.withColumn("event_id", F.coalesce("event_id", missing))
        rows = keyed.select(*VALID_COLUMNS)
        rows = rows if unique else one_row_per_key(rows)
        counted, watch = observed(rows, f"upsert-{stream}")
        new = self._write_part(counted, with_raw_event)
        # An empty batch may be planned away, and its counts with it.
        seen = watch.get if new else {"rows": 0, "key_bytes": 0}
        after = before.changed(new)
        stale: list[StoredFile] = []
        copies = 0
        if new and before.days:
            scope = None if key_scope == WHOLE_TABLE else [piece.day for piece in new]
            old = before.pieces(scope)
            if first_wins:
                new, stale, copies = self._later_than_stored(new, seen, old, first_wins)
                after = before.changed(new)
            else:
                stale = self._files_holding(new, seen, old)
            if stale:
                keys = self._keys(new, seen["key_bytes"])
                kept = self._read_files(stale).join(keys, "event_id", "left_anti")
                added = [*new, *self._write_part(kept)]
                after = self._without_empty(before.changed(added, replaced=stale), stale)
        if batch_id is not None:
            after.streams[stream] = batch_id
        after.stored[stream] = after.stored.get(stream, 0) + seen["rows"] - copies
        if new and after.rollup is not None:
            after.rollup.append(self._write_changes(new, stale, seen["key_bytes"]))
        self._commit(after)
        LOGGER.info("stream=%s batch_id=%s rows=%s", stream, batch_id, seen["rows"])
        return after

    def compact(self, max_loose: int = 8, max_joined: int = 16) -> TableState:
        """Join the parts that upserts left in days with more than ``max_loose`` of them.

        Parts joined before are left alone until a day has more than
        ``max_joined``, so that a row is not written again each time.
        """
        before = self.state()
        scattered = []
        for day in before.days:
            pieces = before.pieces([day])
            loose = [piece for piece in pieces if piece.part.startswith(LOOSE)]
            if len(pieces) - len(loose) > max_joined:
                scattered += pieces
            elif len(loose) > max_loose:
                scattered += loose
        folders = before.rollup or []
        if not scattered and len(folders) <= max_loose:
            return before
        joined = self._write_part(self._scan(scattered), kind=JOINED) if scattered else []
        after = before.changed(joined, dropped=scattered)
        if len(folders) > 1:
            after.rollup[:] = [self._write_rollup(summed(self._changes(folders), F.col("hour")))]
        self._commit(after)
        return after

    def vacuum(self, keep_versions: int = 2, keep_hours: float = 24) -> int:
        """Remove versions, and the parts only they need; the number of parts removed.

        The last ``keep_versions`` stay, and any that was the latest within the
        last ``keep_hours``, as a report may still be reading it.
        """
        ages = self._version_ages()
        versions = sorted(ages)
        successors = zip(versions[:-keep_versions], versions[1:], strict=False)
        old = [version for version, successor in successors if ages[successor] >= keep_hours]
        kept = versions[len(old) :]
        # A part that only a version between the first and the last ones kept needs
        # was written since the first, so its age keeps it.
        ends = {*kept[:1], *kept[-keep_versions:]}
        states = [self.state(version) for version in ends]
        needed = {piece.part for state in states for piece in state.pieces()}
        summed_up = {folder for state in states for folder in state.rollup or ()}
        stale = [
            part
            for part, age in self._files.ages("data", "part=").items()
            if part not in needed and age >= keep_hours
        ]
        for version in old:
            self._files.delete(self._state_name(version))
        for part in stale:
            self._files.delete(f"data/part={part}")
        for folder, age in self._files.ages("rollup").items():
            if folder not in summed_up and age >= keep_hours:
                self._files.delete(f"rollup/{folder}")
        return len(stale)

    # Files

    def _scan(self, pieces: list[Piece]) -> DataFrame:
        paths = []
        for piece in pieces:
            folder = f"part={piece.part}/event_day={piece.day}"
            if piece.replaced:
                paths += [f"{folder}/{name}" for name in self._live_files(piece)]
            else:
                paths.append(folder)
        return self._read_paths(paths)

    def _read_files(self, files: list[StoredFile]) -> DataFrame:
        return self._read_paths([f"part={f.part}/event_day={f.day}/{f.name}" for f in files])

    def _read_paths(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], STORED_DDL)
        reader = self.spark.read.schema(STORED_DDL).option("basePath", self._data)
        return reader.parquet(*(f"{self._data}/{path}" for path in paths))

    def _live_files(self, piece: Piece) -> list[str]:
        names = self._files.children(f"data/part={piece.part}/event_day={piece.day}")
        live = set(names) - set(piece.replaced)
        return sorted(name for name in live if name.endswith(".parquet"))

    def _without_empty(self, state: TableState, touched: list[StoredFile]) -> TableState:
        """Leave out the touched pieces that have no live file any more."""
        days, parts = {f.day for f in touched}, {f.part for f in touched}
        for piece in state.pieces(sorted(days)):
            if piece.part in parts and piece.replaced and not self._live_files(piece):
                del state.days[piece.day][piece.part]
                if not state.days[piece.day]:
                    del state.days[piece.day]
        return state

    def _keys(self, pieces: list[Piece], key_bytes: int, *more: Column) -> DataFrame:
        keys = self._scan(pieces).select("event_id", *more)
        return F.broadcast(keys) if key_bytes <= MAX_BROADCAST_KEY_BYTES else keys

    def _asked_for(self, stored: DataFrame, new: list[Piece], rows: int) -> DataFrame:
        """``stored`` less row groups that hold no key of a small batch.

        For a larger batch it is ``stored`` itself. The caller joins with the keys.
        """
        if rows > MAX_LOOKUP_KEYS:
            return stored
        keys = [row.event_id for row in self._scan(new).select("event_id").collect()]
        return stored.where(F.col("event_id").isin(keys))

    @contextmanager
    def _pushing_keys(self) -> Iterator[None]:
        """Let the reader test every key of a lookup and not only their least and greatest."""
        before = self.spark.conf.get(IN_THRESHOLD, None)
        self.spark.conf.set(IN_THRESHOLD, str(MAX_LOOKUP_KEYS))
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(IN_THRESHOLD)
            else:
                self.spark.conf.set(IN_THRESHOLD, before)

    def _hits(self, new: list[Piece], seen: dict[str, int], old: list[Piece]) -> DataFrame:
        """The file of every stored key of the batch. Reads the key column only."""
        file = F.col("_metadata.file_name").alias("file")
        stored = self._scan(old).select("event_id", "part", "event_day", file)
        stored = self._asked_for(stored, new, seen["rows"])
        keys = self._keys(new, seen["key_bytes"])
        return stored.join(keys, "event_id", "left_semi").select("part", "event_day", "file")

    def _files_holding(
        self, new: list[Piece], seen: dict[str, int], old: list[Piece]
    ) -> list[StoredFile]:
        if not old:
            return []
        with self._pushing_keys():
            # At most one row per file comes back.
            found = self._hits(new, seen, old).distinct().collect()
        return [StoredFile(row.part, row.event_day.isoformat(), row.file) for row in found]

    def _later_than_stored(
        self, new: list[Piece], seen: dict[str, int], old: list[Piece], within: str
    ) -> tuple[list[Piece], list[StoredFile], int]:
        """The new part without copies of stored rows, files that it replaces rows of, copies.

        The stored keys are read once: what they meet, at most one row per key of the
        batch, is written before it is used twice.
        """
        if not old:
            return new, [], 0
        keys = self._keys(new, seen["key_bytes"], F.col("event_time").alias("again_at"))
        file = F.col("_metadata.file_name").alias("file")
        stored = self._scan(old).select("event_id", "event_time", "part", "event_day", file)
        stored = self._asked_for(stored, new, seen["rows"])
        copy = F.col("again_at") < F.col("event_time") + F.expr(f"INTERVAL '{within}'")
        folder = f"scratch/{uuid.uuid4().hex}"
        met = stored.join(keys, "event_id").select(
            "event_id", "part", "event_day", "file", copy.alias("copy")
        )
        with self._pushing_keys():
            met.write.parquet(f"{self.root}/{folder}")
        met = self.spark.read.schema(MET_DDL).parquet(f"{self.root}/{folder}")
        copies = met.where("copy").select("event_id")
        dropped = copies.count()
        if dropped:
            unseen = self._scan(new).join(copies, "event_id", "left_anti")
            first, new = new[0].part, self._write_part(unseen)
            self._files.delete(f"data/part={first}")
        stale = met.where("NOT copy").select("part", "event_day", "file").distinct().collect()
        self._files.delete(folder)
        stale = [StoredFile(row.part, row.event_day.isoformat(), row.file) for row in stale]
        return new, stale, dropped

    def _write_part(
        self,
        rows: DataFrame,
        finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        kind: str = LOOSE,
    ) -> list[Piece]:
        """Write rows as a new part; its days.

        The hint gathers each day into files of the advisory size, splitting a
        day that holds much of the data. ``finish`` adds columns that need not be
        shuffled. Sorting lets readers skip row groups by currency and time.
        """
        part = f"{kind}-{uuid.uuid4().hex}"
        day = F.to_date("event_time")
        (
            finish(rows.withColumn("event_day", day).hint("rebalance", F.col("event_day")))
            .select(*TABLE_COLUMNS, day.alias("event_day"))
            .sortWithinPartitions("event_day", "currency", "event_time")
            .write.options(**KEY_FILTER)
            .partitionBy("event_day")
            .parquet(f"{self._data}/part={part}")
        )
        days = self._files.children(f"data/part={part}", "event_day=")
        return [Piece(part, name) for name in days]

    def _changes(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROLLUP_DDL)
        reader = self.spark.read.schema(ROLLUP_DDL)
        return reader.parquet(*(f"{self.root}/rollup/{folder}" for folder in folders))

    def _write_changes(self, new: list[Piece], stale: list[StoredFile], key_bytes: int) -> str:
        """Add up the rows that came, less those of ``stale`` files that they replace."""
        names = ("event_time", "currency", "payment_status", "is_successful", "amount_major")
        rows = self._scan(new).select(*names, F.lit(1).alias("sign"))
        if stale:
            gone = self._read_files(stale).join(self._keys(new, key_bytes), "event_id", "left_semi")
            rows = rows.unionAll(gone.select(*names, F.lit(-1).alias("sign")))
        return self._write_rollup(changes_of(rows))

    def _write_rollup(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/rollup/{folder}")
        return folder

    def _commit(self, state: TableState) -> None:
        body = {"version": state.version, "days": state.days, "streams": state.streams}
        body["stored"] = state.stored
        if state.rollup is not None:
            body["rollup"] = state.rollup
        if not self._files.write_new(self._state_name(state.version), json.dumps(body)):
            raise RuntimeError(f"version {state.version} was committed by another writer")

    @staticmethod
    def _state_name(version: int) -> str:
        return f"state/{version:010d}.json"

    def _version_ages(self) -> dict[int, float]:
        ages = self._files.ages("state")
        return {int(name[:-5]): age for name, age in ages.items() if name.endswith(".json")}
