"""J1 with bounded state: a content is new again once it has not been taken for a while."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from corpusloom.streaming.ingest import SALTS

# Event times are rounded down to this part of the time that a content is remembered.
PARTS = 64
# Contents are dealt over so many buckets; a bucket's state and its rows of one batch are held at once.
BUCKETS = 4096
DIGEST = "S32"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TakenOnce(StatefulProcessor):
    """Lets a row of a content through unless one was let through less than ``keep_ms`` before.

    Contents come in buckets, as a call, a state and a timer for each content would take most of the time. The
    state of a bucket is the time until which each of its contents rests, the digests in one field and
    the times in another; a timer at the earliest of the times clears what has rested.
    """

    def __init__(self, keep_ms: int, columns: list[str]):
        self.keep_ms, self.columns = keep_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = [StructField("digests", BinaryType()), StructField("untils", BinaryType())]
        self.rests = handle.getValueState("rests", StructType(fields))

    def held(self) -> dict[bytes, int]:
        if not self.rests.exists():
            return {}
        digests, untils = self.rests.get()
        return dict(zip(np.frombuffer(digests, DIGEST).tolist(), np.frombuffer(untils, np.int64).tolist()))

    def hold(self, rests: dict[bytes, int]) -> None:
        digests, untils = np.array(list(rests), DIGEST), np.array(list(rests.values()), np.int64)
        self.rests.update((digests.tobytes(), untils.tobytes()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Few rows of a content reach this: one per salt and rounded time.
        own = pd.concat(list(rows)).sort_values("at", kind="stable")
        rests, taken = self.held(), []
        before = min(rests.values(), default=None)
        for digest, at in zip(own["content_hash"], own["at"]):
            digest = (digest or "").encode()
            fresh = at >= rests.get(digest, at)
            taken.append(fresh)
            if fresh:
                rests[digest] = int(at) + self.keep_ms
        if any(taken):
            self.hold(rests)
            # One timer no later than the earliest time is always set.
            first = min(rests.values())
            if before is None or first < before:
                self.handle.registerTimer(first)
            yield own[taken][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        rests = {digest: until for digest, until in self.held().items() if until > now}
        if rests:
            self.hold(rests)
            self.handle.registerTimer(min(rests.values()))
        else:
            self.rests.clear()
        yield from ()

    def close(self) -> None:
        pass


def expiring_content(
    docs: DataFrame, key: str, event_time: str, keep: str = "30 days", delay: str = "1 hour", content: str = "content"
) -> DataFrame:
    """Rows whose content was not let through in the ``keep`` before, with ``content_hash`` and ``seen_at``.

    Times count as ``seen_at``, rounded down to a 64th of ``keep``, so copies within one such span are equal, and
    all but one per salt go before they meet: a content that makes up much of the stream fills no task.
    State holds the contents of the last ``keep`` and the rows of the last ``delay``, whatever came before.
    Rows later than the watermark are dropped, rows without a time are not read. Timers need the
    RocksDB state store; the session is set to it, as one state store serves all its streams.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kept = spark.sql(f"select cast(interval {keep} as interval day to second) as i").select(F.expr("unix_millis(timestamp_millis(0) + i)"))
    keep_ms = kept.first()[0]
    step = max(1, keep_ms // PARTS)
    columns = docs.columns
    # Rows reach Python as named tuples, which admit few names.
    plain = [f"c{i}" for i in range(len(columns))]
    own = dict(zip(columns, plain))
    at = F.floor(F.unix_millis(F.col(own[event_time]).cast("timestamp")) / step) * step
    timed = docs.toDF(*plain).filter(F.col(own[event_time]).isNotNull()).withColumn("at", at)
    marked = timed.withColumn("seen_at", F.timestamp_millis("at")).withWatermark("seen_at", delay)
    salt = F.pmod(F.xxhash64(own[key]), F.lit(SALTS))
    salted = marked.withColumn("content_hash", F.md5(own[content])).withColumn("salt", salt)
    rounded = salted.dropDuplicates(["content_hash", "salt", "seen_at"]).drop("salt")
    out = [*plain, "content_hash", "seen_at"]
    schema = StructType([rounded.schema[c] for c in out])
    bucketed = rounded.withColumn("bucket", F.pmod(F.xxhash64("content_hash"), F.lit(BUCKETS)))
    taken = bucketed.groupBy("bucket").transformWithStateInPandas(
        TakenOnce(keep_ms, out), schema, "Append", "EventTime"
    )
    return taken.toDF(*columns, "content_hash", "seen_at")
