"""Retention and confirmation as arbitrary state on the RocksDB store: typed values and maps, registered timers, time to live.

A key's events come in chunks and in any order, while its history is in order of seq. Chunks are sorted and kept in map state by their first seq, in blocks
of BLOCK events, whose keys RocksDB iterates in order; what no later block can precede is final and goes through the state machine. So a key
holds the blocks that overlap and no backlog, however many events a batch brings it.
Retention's keys share buckets, as a call and its reads and writes of state cost far more than the few events that most keys have.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veriloom.operators.queue import BLOCK_AFTER, DAY, EXPIRY_DAYS

#: Events of a block of map state.
BLOCK = 4096
#: Buckets that retention's keys share.
BUCKETS = 1024
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that these processors need, for streams that start inside; the session's own afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _place(seq: int) -> str:
    """A seq as text that sorts as it does, negative ones first."""
    return f"{seq + (1 << 63):020d}"


def _packed(rows: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def _unpacked(block: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(block).read_pandas()


class InOrder(StatefulProcessor):
    """Hands a key's events to step() in order of seq. A batch's events are ordered among themselves; those of later batches come after."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # One string of a fixed length: the bytes of a row of several columns don't sort as the columns do.
        self.blocks = handle.getMapState("blocks", "place string", "events binary")

    def in_order(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows of a batch in pieces, in order of seq."""
        first, n = None, 0
        for chunk in rows:
            if not len(chunk):
                continue
            if first is None and not n:
                first = chunk
                continue
            for df in ([first] if first is not None else []) + [chunk]:
                n = self._keep(df, n)
            first = None
        if first is not None:  # one chunk is in order once sorted
            yield first.sort_values("seq", kind="stable", ignore_index=True)
        elif n:
            yield from self._merged()

    def _keep(self, chunk: pd.DataFrame, n: int) -> int:
        chunk = chunk.sort_values("seq", kind="stable", ignore_index=True)
        for at in range(0, len(chunk), BLOCK):
            part = chunk.iloc[at : at + BLOCK]
            self.blocks.updateValue((f"{_place(int(part['seq'].iloc[0]))}-{n:012d}",), (_packed(part),))
            n += 1
        return n

    def _merged(self) -> Iterator[pd.DataFrame]:
        """Blocks in order of their first events, merged where they overlap."""
        open_: pd.DataFrame | None = None
        last = None
        for (place,), (block,) in self.blocks.iterator():
            if last is not None and place < last:
                raise ValueError("map state isn't iterated in order of its keys: use the RocksDB store")
            last = place
            part = _unpacked(block)
            if open_ is not None:
                final = open_["seq"] < int(part["seq"].iloc[0])
                if final.any():
                    yield open_[final].reset_index(drop=True)
                    open_ = open_[~final]
                part = pd.concat([open_, part]).sort_values("seq", kind="stable", ignore_index=True) if len(open_) else part
            open_ = part
        yield open_
        self.blocks.clear()


class Retention(InOrder):
    """State of a bucket of keys: each key's newest stored hash and capture. An event is stored if its hash moved or it is a drift, else it is an alias of what is stored."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.held = handle.getValueState("held", "keys binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {}
        if self.held.exists():
            kept = pa.ipc.open_stream(self.held.get()[0]).read_all()
            held = {(a, b): (c, d) for a, b, c, d in zip(*(x.to_pylist() for x in kept.columns), strict=True)}
        for df in self.in_order(rows):
            yield self.step(df, held)
        names = ("slug", "kind", "hash", "capture")
        columns = zip(*((*k, *v) for k, v in held.items()), strict=True) if held else [[]] * len(names)
        out = io.BytesIO()
        batch = pa.record_batch([pa.array(c, pa.string()) for c in columns], names=names)
        with pa.ipc.new_stream(out, batch.schema) as w:
            w.write_batch(batch)
        self.held.update((out.getvalue(),))

    @staticmethod
    def step(df: pd.DataFrame, held: dict) -> pd.DataFrame:
        """The rows of events in order of seq, of any of a bucket's keys. held: what is held of each (slug, kind), which goes on from there."""
        given = [df[c].astype(object).where(df[c].notna(), None).tolist() for c in ("slug", "kind", "hash", "result", "capture")]
        stored, supersedes = [], []
        for slug, kind, new, result, capture in zip(*given, strict=True):
            known, before = held.get((slug, kind), (None, None))
            moved = new != known or result == "drift"
            stored.append(moved)
            supersedes.append(before if moved else None)
            if moved:
                held[slug, kind] = (new, capture)
        return pd.DataFrame({"slug": given[0], "kind": given[1], "seq": df["seq"], "hash": given[2], "result": df["result"], "stored": stored, "supersedes": supersedes})


class Confirmation(InOrder):
    """State: since when a submission waits, and hard failures in a row. timers: a submission of which nothing more is heard expires by the clock.

    term: milliseconds until that. seen: seqs of the last term, so that an event that is delivered twice counts once; they are forgotten by time to live.
    """

    def __init__(self, timers: bool, term: int):
        self.timers, self.term = timers, term

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("state", "since long, failures int")
        self.seen = handle.getMapState("seen", "seq long", "once boolean", self.term) if self.timers else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        since, failures = self.state.get() if self.state.exists() else (None, 0)
        for df in self.in_order(rows):
            if self.seen is not None:
                df = df[[self._first(int(s)) for s in df["seq"]]]
            out = []
            for seq, at, event in zip(df["seq"].tolist(), df["at"].tolist(), df["event"].tolist(), strict=True):
                since, failures, outcome = judged(since, failures, event, int(at))
                out.append((key[0], seq, outcome, failures, standing(since, failures)))
            if out:
                yield pd.DataFrame(out, columns=["url", "seq", "outcome", "failures", "status"])
        self.state.update((since, failures))
        if self.timers:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            if since is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.term)

    def _first(self, seq: int) -> bool:
        if self.seen.containsKey((seq,)):
            return False
        self.seen.updateValue((seq,), (True,))
        return True

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, failures = self.state.get() if self.state.exists() else (None, 0)
        if since is not None:
            self.state.update((None, failures))
            seq = pd.array([None], "Int64")
            yield pd.DataFrame({"url": [key[0]], "seq": seq, "outcome": ["expired"], "failures": [failures], "status": [standing(None, failures)]})


def standing(since: int | None, failures: int) -> str:
    return "blocked" if failures >= BLOCK_AFTER else "open" if since is None else "pending"


def judged(since: int | None, failures: int, event: str, at: int) -> tuple[int | None, int, str]:
    """(since, failures, outcome) after an event: see confirmations()."""
    if event == "fault":
        return since, failures, "skipped"
    if event == "submit":
        return at, 0, "pending"
    if event in ("hard", "soft"):
        return since, failures + (event == "hard"), "failed"
    if since is not None:
        if event in ("confirmed", "unplayable"):
            return None, failures, event
        if event == "inconclusive" and at - since > EXPIRY_DAYS * DAY:
            return None, failures, "expired"
    return since, failures, "left"


def retained(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Stream of (slug, kind, seq, hash, result, stored, supersedes) from events(slug, kind, seq, hash, result, capture); start it inside rocksdb().

    buckets: how many the keys share, the same for a stream's life. What a bucket holds of its keys is one value of state, so there should be so many
    that each has some thousands of keys at most.
    """
    kind = F.coalesce("kind", F.lit("main"))
    keyed = events.select(F.pmod(F.xxhash64("slug", kind), F.lit(buckets)).cast("int").alias("bucket"), "slug", kind.alias("kind"), "seq", "hash", "result", "capture")
    schema = "slug string, kind string, seq long, hash string, result string, stored boolean, supersedes string"
    return keyed.groupBy("bucket").transformWithStateInPandas(Retention(), schema, "Append", "None")


def confirmations(events: DataFrame, timers: bool = False, term: int = EXPIRY_DAYS * DAY * 1000) -> DataFrame:
    """Stream of (url, seq, outcome, failures, status) from events(url, seq, at long seconds, event); start it inside rocksdb().

    event: submit, confirmed, unplayable, inconclusive, throttled, hard, soft or fault. A submission waits as pending; a
    confirmation or a refusal to play ends it; inconclusive looks leave it until its term counted from the submission is over,
    throttled ones never expire it. Hard failures in a row block; an account fault changes nothing, whatever came with it.
    Confirmations don't count as attempts of their own. timers=True: a submission of which nothing more is heard for `term` milliseconds expires by
    the clock, in a row without seq, and an event that comes twice within a term counts once; a stream that runs once over what is there has no such clock.
    """
    rows = events.select("url", "seq", "at", "event")
    return rows.groupBy("url").transformWithStateInPandas(Confirmation(timers, term), "url string, seq long, outcome string, failures int, status string", "Append", "ProcessingTime" if timers else "None")
