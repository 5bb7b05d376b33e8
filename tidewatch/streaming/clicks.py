"""The click cap on a stream, in arrival order."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, IntegralType, LongType, StringType, StructField, StructType

from ..functions.event_time import micros

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 86_400_000
EMPTY = pa.table({"key": pa.array([], pa.string()), "day": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})


class ClickCap(StatefulProcessor):
    """State per part of the keys: how many clicks of each key have passed on each
    open day, and a timer for the end of the first one. Of a batch only the first
    ``allowed + 1`` clicks per key and day are kept in memory. The state is read
    and written once a batch, whatever the number of keys."""

    def __init__(self, allowed: int, columns: list[str], by_event_day: bool) -> None:
        self.allowed, self.columns, self.by_event_day = allowed, columns, by_event_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", StructType([StructField("seen", BinaryType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        today = None if self.by_event_day else timerValues.getCurrentProcessingTimeInMs() // DAY_MS
        chunks, waiting, kept = [], 0, 0
        for chunk in rows:
            chunks.append(chunk.assign(day=chunk["cap_us"] // (DAY_MS * 1000) if self.by_event_day else today))
            waiting += len(chunk)
            if waiting > max(kept, 10_000):
                chunks = [self._first(chunks)]
                waiting, kept = 0, len(chunks[0])
        clicks = self._first(chunks)
        clicks["day"] = clicks["day"].astype("int64")
        known = self._known()
        place = pd.MultiIndex.from_frame(clicks[["cap_key", "day"]])
        nth = clicks.groupby(["cap_key", "day"]).cumcount().to_numpy() + 1 + known.reindex(place, fill_value=0).to_numpy()
        room = nth <= self.allowed + 1
        seen = pd.Series(nth[room], index=place[room]).groupby(level=[0, 1]).max()
        first_open = known.index.get_level_values(1).min() if len(known) else None
        if len(seen):
            self._keep(pd.concat([known.drop(seen.index, errors="ignore"), seen]))
            first = int(seen.index.get_level_values(1).min())
            if first_open is None or first < first_open:
                self.handle.registerTimer((first + 1) * DAY_MS)
            clicks, nth = clicks[room], nth[room]
            yield clicks.assign(kind=np.where(nth <= self.allowed, "pass", "warning"))[self.columns + ["kind"]]

    def _first(self, chunks: list[pd.DataFrame]) -> pd.DataFrame:
        clicks = pd.concat(chunks, ignore_index=True).sort_values(["cap_unplaced", "cap_seq"], kind="stable")
        return clicks.groupby(["cap_key", "day"], sort=False).head(self.allowed + 1).reset_index(drop=True)

    def _known(self) -> pd.Series:
        """Clicks by key and day."""
        state = self.seen.get()
        table = pa.ipc.open_stream(state[0]).read_all() if state else EMPTY
        index = pd.MultiIndex.from_arrays([table["key"].to_pandas(), table["day"].to_pandas()], names=["cap_key", "day"])
        return pd.Series(table["n"].to_numpy(), index=index)

    def _keep(self, seen: pd.Series) -> None:
        columns = [seen.index.get_level_values(0), seen.index.get_level_values(1), seen.to_numpy()]
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, EMPTY.schema)], schema=EMPTY.schema)
        out = io.BytesIO()
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_table(table)
        self.seen.update((out.getvalue(),))

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() if self.by_event_day else timerValues.getCurrentProcessingTimeInMs()
        known = self._known()
        days = known.index.get_level_values(1)
        known = known[(days + 1) * DAY_MS > now]
        if len(known):
            self._keep(known)
            self.handle.registerTimer((int(known.index.get_level_values(1).min()) + 1) * DAY_MS)
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def cap_clicks(
    clicks: DataFrame, limit: int = 100, strict: bool = False,
    keys: tuple[str, ...] = ("user_id", "ad_id"), seq: str = "seq", by_event_day: bool = True, salts: int = 1,
    parts: int = 64,
) -> DataFrame:
    """As the batch form. The count starts again at UTC midnight: of the event
    time, or of the clock with ``by_event_day=False``. The keys are dealt over
    ``parts``, each with one state and one timer, so Python and the state store
    are called once per part and not per key; a task holds the clicks of a batch
    and the keys of the open days of one part at a time. A checkpoint keeps its
    number of parts. With ``salts`` above 1 the
    clicks of a key are first cut in that many parts side by side. A click among
    the first of its key is also among the first of its part, so the second cut
    has all it needs, and of a hot key only a few rows reach it."""
    kept = [field for field in clicks.schema if field.name != "kind"]
    allowed = limit + 1 if strict else limit
    rows = clicks.drop("kind")
    if salts > 1:
        salt = F.pmod(F.xxhash64(seq), F.lit(salts)).cast("int")
        rows = _cut(rows, (*map(F.col, keys), salt), seq, allowed, kept, by_event_day, parts).drop("kind")
    return _cut(rows, tuple(map(F.col, keys)), seq, allowed, kept, by_event_day, parts)


def _cut(rows: DataFrame, keys: tuple, seq: str, allowed: int, kept: list[StructField], by_event_day: bool, parts: int) -> DataFrame:
    # Pandas takes no names that begin with _, and has no NULL among whole numbers: 0 stands for it, and a bit says so.
    whole = [field.name for field in kept if isinstance(field.dataType, IntegralType)]
    bits = [F.shiftleft(F.col(c).isNull().cast("long"), k % 63) for k, c in enumerate(whole)]
    words = {f"cap_null{w}": sum(bits[63 * w:63 * w + 63], F.lit(0).cast("long")) for w in range(-(-len(bits) // 63))}
    place = F.coalesce(F.col(seq), F.lit(0)) if seq in whole else F.col(seq)
    line = rows.where(F.col("ts").isNotNull()) if by_event_day else rows
    line = line.select(
        *[F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name) if f.name in whole else F.col(f.name) for f in kept],
        *[word.alias(name) for name, word in words.items()],
        micros().alias("cap_us"), place.alias("cap_seq"), F.col(seq).isNull().alias("cap_unplaced"),
        F.to_json(F.struct(*[key.alias(f"k{n}") for n, key in enumerate(keys)])).alias("cap_key"),
        F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("cap_part"),
    )
    told = line.groupBy("cap_part").transformWithStateInPandas(
        statefulProcessor=ClickCap(allowed, [f.name for f in kept] + list(words), by_event_day),
        outputStructType=StructType(kept + [StructField(w, LongType()) for w in words] + [StructField("kind", StringType())]),
        outputMode="append",
        timeMode="EventTime" if by_event_day else "ProcessingTime",
        **({"eventTimeColumnName": "ts"} if by_event_day else {}),
    )
    absent = {c: F.col(f"cap_null{k // 63}").bitwiseAND(F.shiftleft(F.lit(1).cast("long"), k % 63)) != 0 for k, c in enumerate(whole)}
    return told.select(
        *[F.when(~absent[f.name], F.col(f.name)).alias(f.name) if f.name in whole else F.col(f.name) for f in kept], "kind")
