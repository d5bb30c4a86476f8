"""Bounded session history and repeat suppression over tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordering import null_safe_join
from tidemill.session import cut

MICROS = 1_000_000
GROUP_ROWS = 2_000_000
NEVER = -(1 << 62)  # before any time


def recent_history(df: DataFrame, session: str, order: Sequence[str], turns: int = 6) -> DataFrame:
    """The last `turns` pairs of messages per session, numbered from the oldest kept.

    The cut happens on both sides of the shuffle, so a long session moves few rows.
    """
    keep = turns * 2
    newest = Window.partitionBy(session).orderBy(*[F.desc(c) for c in order])
    kept = df.withColumn("__r", F.row_number().over(newest)).filter(F.col("__r") <= keep)
    oldest = Window.partitionBy(session).orderBy(*order)
    return kept.withColumn("position", F.row_number().over(oldest)).drop("__r")


def message_key(session: str, message: str):
    """Key under which an answer is stored: session and trimmed lower-case message."""
    return F.concat_ws(":", F.col(session).cast("string"), F.lower(F.trim(F.col(message))))


def first_after(times: np.ndarray, low: np.ndarray, high: np.ndarray, need: np.ndarray) -> np.ndarray:
    """For each `need`, the first position in `low:high` (whose times ascend) with a later time, else `high`."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = np.minimum((low + high) // 2, len(times) - 1)
        early = open_ & (times[middle] <= need)
        low, high = np.where(early, middle + 1, low), np.where(open_ & ~early, middle, high)


def chained(times: np.ndarray, ends: np.ndarray, first: np.ndarray, first_ends: np.ndarray, ttl: int) -> np.ndarray:
    """Marks the stored times: `first` of each group, and from each the first one more than `ttl` later.

    `ends` holds for each row the end of its group. All groups take a step together.
    """
    following = first_after(times, np.arange(len(times)), ends, times + ttl)
    marked, at = np.zeros(len(times), dtype=bool), first[first < first_ends]
    while len(at):
        marked[at] = True
        further = following[at]
        at = further[further < ends[at]]
    return marked


def _transfers(times: np.ndarray, starts: np.ndarray, ends: np.ndarray, opening: np.ndarray, ttl: int):
    """For each time a span may be entered with: the last time stored in it. Returns rows, and those last times.

    Spans are the groups `starts:ends` of different, ascending times and begin at `opening`. Entry times that lead to the same
    last time are folded into the largest of them.
    """
    own = np.arange(len(times))
    end = np.repeat(ends, ends - starts)
    following = first_after(times, own, end, times + ttl)
    # pointers double until each leads to the end of its chain
    last = np.where(following < end, following, own)
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    stop = np.repeat(np.minimum(first_after(times, starts, ends, opening + ttl) + 1, ends), ends - starts)
    rows = own[own < stop]
    leave = times[last[rows]]
    final = rows + 1 == stop[rows]
    keep = final | np.append(leave[1:] != leave[:-1], True)
    return rows[keep], leave[keep]


def group_starts(keys: pd.DataFrame) -> np.ndarray:
    """Positions where a run of equal keys begins; nulls are equal."""
    prior = keys.shift()
    change = ((keys != prior) & ~(keys.isna() & prior.isna())).any(axis=1).to_numpy()
    change[:1] = True
    return np.flatnonzero(change)


def _each_group(keys: Sequence[str], fn):
    """Run `fn(rows, starts)` on runs of equal keys of a sorted partition, many at once; only the open run is held back."""
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for pdf in batches:
            if not len(pdf):
                continue
            starts = group_starts(pdf[keys])
            first = pdf[keys].iloc[0]
            if last is not None and all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in zip(first, last)):
                starts = starts[1:]
            last = pdf[keys].iloc[-1]
            if not len(starts):
                held.append(pdf)
                continue
            # all runs but the last are whole
            whole = [*held, pdf.iloc[: starts[-1]]]
            held = [pdf.iloc[starts[-1] :]]
            done = pd.concat(whole, ignore_index=True)
            if len(done):
                yield fn(done, group_starts(done[keys]))
        if held:
            done = pd.concat(held, ignore_index=True)
            yield fn(done, group_starts(done[keys]))

    return run


def _grouped(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn, schema: str) -> DataFrame:
    """Like a grouped pandas call, for many small groups: one stream per partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(_each_group(keys, fn), schema)


def _neighbours(rows: DataFrame, key: Sequence[str], tie: str) -> DataFrame:
    """Time of the previous and the next row of the key, chained over the spans."""
    inner = Window.partitionBy(*key, "__span").orderBy("__t", tie)
    chain = Window.partitionBy(*key).orderBy("__span")
    # one row per key and span
    ends = rows.groupBy(*key, "__span").agg(F.min("__t").alias("__min"), F.max("__t").alias("__max"))
    around = ends.select(*key, "__span", F.lag("__max").over(chain).alias("__before"), F.lead("__min").over(chain).alias("__after"))
    near = rows.withColumns({"__p": F.lag("__t").over(inner), "__n": F.lead("__t").over(inner)})
    joined = null_safe_join(near, around, [*key, "__span"])
    return joined.withColumns({"__p": F.coalesce("__p", "__before"), "__n": F.coalesce("__n", "__after")}).drop("__before", "__after")


def suppress_repeats(
    df: DataFrame, key: Sequence[str], time: str, tie: str, ttl: int = 300, spans: int | None = None
) -> DataFrame:
    """Mark rows as repeats: within `ttl` seconds of the stored row of their key. Repeats do not renew it.

    Rows without a neighbour of their key within `ttl` need no state and stay in the JVM. The
    others are grouped by key and time span. A span is first summed up as the last stored time
    for each way of entering it, those summaries are chained per key, and each span is then
    replayed on its own. No task holds all rows of a key: the span length is chosen so that the
    fullest one stays below `GROUP_ROWS`, as long as that many do not fall within one `ttl`.
    """
    key = list(key)
    wait = ttl * MICROS
    timed = df.select(*key, tie, F.unix_micros(F.col(time).cast("timestamp")).alias("__t"))
    if spans is None:
        fullest = (
            timed.groupBy(*key, F.floor(F.col("__t") / wait)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        ) or 1
        spans = int(min(max(GROUP_ROWS // fullest, 1), 64))
    width = wait * spans
    rows = cut(_neighbours(timed.withColumn("__span", F.floor(F.col("__t") / width)), key, tie))
    alone = (F.col("__p").isNull() | (F.col("__t") - F.col("__p") > wait)) & (
        F.col("__n").isNull() | (F.col("__n") - F.col("__t") > wait)
    )
    lone = rows.filter(alone).select(*key, tie, F.lit(0).cast("bigint").alias("repeat"), F.col("__t").alias("answered_at"))
    dense = rows.filter(~alone).select(*key, tie, "__t", "__span")
    kinds = dict(df.dtypes)
    key_schema = ", ".join(f"`{c}` {kinds[c]}" for c in key)

    def summarise(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        times = pdf["__t"].to_numpy()
        fresh = np.append(True, times[1:] != times[:-1])
        fresh[starts] = True
        unique = np.flatnonzero(fresh)
        begin = np.searchsorted(unique, starts)
        opening = pdf["__span"].to_numpy()[starts] * width
        at, leave = _transfers(times[unique], begin, np.append(begin[1:], len(unique)), opening, wait)
        out = pdf[[*key, "__span"]].iloc[unique[at]].reset_index(drop=True)
        out["enter"], out["leave"] = times[unique[at]], leave
        return out

    def chain(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        enter, leave = pdf["enter"].to_numpy(), pdf["leave"].to_numpy()
        spans_ = group_starts(pdf[[*key, "__span"]])
        ends = np.append(spans_[1:], len(pdf))
        # the spans of a key follow each other; all keys of the batch take a step together
        at = np.searchsorted(spans_, starts)
        stop = np.append(at[1:], len(spans_))
        need, needs = np.full(len(at), NEVER), np.empty(len(spans_), dtype=np.int64)
        while len(at):
            needs[at] = need
            found = first_after(enter, spans_[at], ends[at], need)
            need = np.where(found < ends[at], leave[np.minimum(found, len(leave) - 1)] + wait, need)
            at = at + 1
            more = at < stop
            at, stop, need = at[more], stop[more], need[more]
        out = pdf[[*key, "__span"]].iloc[spans_].reset_index(drop=True)
        out["need"] = needs
        return out

    def replay(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        times, need = pdf["__t"].to_numpy(), pdf["need"].to_numpy()
        ends = np.append(starts[1:], len(pdf))
        sizes = ends - starts
        fresh = chained(times, np.repeat(ends, sizes), first_after(times, starts, ends, need[starts]), ends, wait)
        latest = np.maximum.accumulate(np.where(fresh, np.arange(len(pdf)), -1))
        out = pdf[[*key, tie]].copy()
        out["repeat"] = (~fresh).astype("int64")
        out["answered_at"] = np.where(latest >= np.repeat(starts, sizes), times[np.maximum(latest, 0)], need - wait)
        return out

    moves = _grouped(dense, [*key, "__span"], ["__t"], summarise, f"{key_schema}, __span long, enter long, leave long")
    needs = _grouped(moves, key, ["__span", "enter"], chain, f"{key_schema}, __span long, need long")
    ready = null_safe_join(dense, needs, [*key, "__span"])
    marked = _grouped(
        ready, [*key, "__span"], ["__t", tie], replay, f"{key_schema}, `{tie}` {kinds[tie]}, repeat long, answered_at long"
    )
    return lone.unionByName(marked).withColumn("answered_at", F.timestamp_micros("answered_at"))
