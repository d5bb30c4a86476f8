"""Keyed state: session history and repeat suppression on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.operators.sessions import MICROS, NEVER, chained, first_after, group_starts


def history_stream(stream: DataFrame, session: str, order: str, role: str, text: str, turns: int = 6) -> DataFrame:
    """The last `turns` pairs of messages of each session touched by a batch (update mode).

    State per session: the kept messages only. Input arrives in pieces, so a busy session is
    never held whole.
    """
    keep = turns * 2
    kinds = dict(stream.dtypes)
    fields = f"turns array<{kinds[order]}>, roles array<string>, texts array<string>"

    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        for pdf in batches:
            held += list(zip(pdf[order].tolist(), pdf[role].tolist(), pdf[text].tolist()))
            held = sorted(held, key=lambda m: m[0])[-keep:]
        columns = [list(c) for c in zip(*held)]
        state.update(tuple(columns))
        yield pd.DataFrame({session: [key[0]], "turns": [columns[0]], "roles": [columns[1]], "texts": [columns[2]]})

    return (
        stream.select(session, order, role, text)
        .groupBy(session)
        .applyInPandasWithState(update, f"{session} {kinds[session]}, {fields}", fields, "update", GroupStateTimeout.NoTimeout)
    )


def history_rows(history: DataFrame, session: str) -> DataFrame:
    """The newest written history of each session, one row per message."""
    newest = history.groupBy(session).agg(F.max_by(F.struct("turns", "roles", "texts"), "batch").alias("h"))
    zipped = F.arrays_zip(F.col("h.turns").alias("turn"), F.col("h.roles").alias("role"), F.col("h.texts").alias("text"))
    rows = newest.select(session, F.posexplode(zipped).alias("at", "m"))
    return rows.select(session, "m.turn", "m.role", "m.text", (F.col("at") + 1).alias("position"))


def suppress_stream(
    stream: DataFrame, key: Sequence[str], time: str, tie: str, ttl: int = 300, late: str = "10 minutes", shards: int = 1024
) -> DataFrame:
    """Mark repeats within `ttl` seconds of the stored row; rows behind the watermark are dropped.

    State per key: the stored time. It is forgotten once the watermark has passed it by `ttl`. A row that
    comes late, with a time before the stored one, repeats it only within `ttl` of it; else it is no repeat and
    leaves the stored time as it is; so does a row without a time. Keys are dealt to `shards` states, whose keys are worked on together, so many
    keys of few rows each cost little. A checkpoint goes on with the number of shards it began with.
    """
    key = list(key)
    kinds = dict(stream.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in key) + f", `{tie}` {kinds[tie]}, repeat long"
    wait = ttl * MICROS

    def update(shard, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = pd.Series(state.get[1], index=state.get[0], dtype="int64") if state.exists else pd.Series(dtype="int64")
        # the rows of a batch, put in time order per key across the pieces
        rows = pd.concat(list(batches)).sort_values(["__key", "__t", tie], ignore_index=True)
        undated = rows["__t"].isna()
        if undated.any():
            yield rows.loc[undated, [*key, tie]].assign(repeat=0)
            rows = rows[~undated].reset_index(drop=True)
        times, names = rows["__t"].to_numpy(dtype=np.int64), rows["__key"]
        starts = group_starts(rows[["__key"]])
        ends = np.append(starts, len(rows))[1:]
        sizes = ends - starts
        known = held.reindex(names.iloc[starts])
        has = known.notna().to_numpy()
        stored = held.reindex(names.iloc[starts], fill_value=NEVER).to_numpy()
        first = first_after(times, starts, ends, np.where(has, stored + wait, NEVER))
        fresh = chained(times, np.repeat(ends, sizes), first, ends, wait)
        latest = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), -1))[ends - 1]
        # late rows, before the stored time and out of its reach, are no repeats either
        alone = np.repeat(has, sizes) & (times < np.repeat(stored, sizes) - wait)
        out = rows[[*key, tie]].copy()
        out["repeat"] = (~(fresh | alone)).astype("int64")
        now = pd.Series(np.where(latest >= starts, times[np.maximum(latest, 0)], stored), index=names.iloc[starts].to_numpy())
        held = pd.concat([held[~held.index.isin(now.index)], now])
        held = held[(held + wait) // 1000 >= state.getCurrentWatermarkMs()]
        state.update((held.index.tolist(), held.tolist()))
        # the last one to be forgotten takes the shard with it
        expiry = (int(held.max()) + wait) // 1000 if len(held) else 0
        state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))
        yield out

    # a text that tells keys apart, nulls too
    name = F.to_json(F.array(*[F.col(c).cast("string") for c in key]))
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return (
        timed.select(*key, tie, time, name.alias("__key"), F.unix_micros(time).alias("__t"))
        .withColumn("__shard", F.pmod(F.xxhash64("__key"), F.lit(shards)).cast("int"))
        .groupBy("__shard")
        .applyInPandasWithState(update, schema, "keys array<string>, stored array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    )
