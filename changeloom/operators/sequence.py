"""Order checks on event streams, and the adaptive scan window."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.ordering import largest_before, place_in_key, sum_before
from changeloom.operators.progress import SCAN_MAX_MS, SCAN_MIN_MS, USAGE_CRITICAL, USAGE_HIGH, USAGE_LOW, USAGE_VERY_LOW


def verify_sequence(events: DataFrame) -> DataFrame:
    """Adds ``outcome`` to events of ``dispatcher, arrival, epoch, kind, seq,
    commit_ts`` in their order of arrival.

    ``stale``: of an epoch before the newest seen. ``reset``: the first event of
    an epoch that is no handshake, or whose number is not the next one (that of
    the last event for ``resolved``); ``dropped``: after a reset, up to the next
    epoch. Of the rest, ``repeated``: a commit ts below the largest forwarded one,
    or a second schema change or sync point of one commit ts; else ``forward``.

    All conditions are running counts and maxima per dispatcher, so a hot
    dispatcher is spread over blocks; there is no fold over rows."""
    order = [F.col("arrival")]
    seen = largest_before(events, ["dispatcher"], order, F.col("epoch"), "__seen")
    stale = F.coalesce(F.col("epoch") < F.col("__seen"), F.lit(False))
    rows = seen.withColumn("__stale", stale).drop("__seen")
    live = rows.where("not __stale")
    counted = sum_before(live, ["dispatcher", "epoch"], order, (F.col("kind") != "resolved").cast("bigint"), "__n")
    right = (
        F.when(F.col("__n") == 0, (F.col("kind") == "handshake") & (F.col("seq") == 1))
        .when(F.col("kind") == "resolved", F.col("seq") == F.col("__n")).otherwise(F.col("seq") == F.col("__n") + 1)
    )
    counted = counted.withColumn("__right", F.coalesce(right, F.lit(False)))
    wrong = sum_before(counted, ["dispatcher", "epoch"], order, (~F.col("__right")).cast("bigint"), "__wrong").drop("__n")
    checked = wrong.where("__wrong = 0 and __right")
    passed = largest_before(checked, ["dispatcher"], order, F.col("commit_ts"), "__top")
    again = place_in_key(passed, ["dispatcher", "kind", "commit_ts"], order, "__again")
    repeated = (F.col("commit_ts") < F.col("__top")) | (F.col("kind").isin("ddl", "syncpoint") & (F.col("__again") > 0))
    good = again.withColumn("outcome", F.when(F.coalesce(repeated, F.lit(False)), "repeated").otherwise("forward"))
    bad = wrong.where("__wrong > 0 or not __right").withColumn("outcome", F.when(F.col("__wrong") == 0, "reset").otherwise("dropped"))
    late = rows.where("__stale").withColumn("outcome", F.lit("stale"))
    cols = [*events.columns, "outcome"]
    return good.select(*cols).unionByName(bad.select(*cols)).unionByName(late.select(*cols))


#: Times in milliseconds and counts of the scan window, fixed values.
WINDOW_MS, COOLDOWN_MS, TREND_COOLDOWN_MS, START_MS = 30_000, 30_000, 5_000, 5_000
TREND_SAMPLES, TREND_RISE, TREND_START = 4, 2, 30
GROW_SAMPLES, GROW_SPAN_MS = 10, WINDOW_MS * 4 // 5


class ScanWindow:
    """The interval of one change feed after each memory sample (percent).

    Samples of the last 30 s count. Above 90 % (70 %) the interval falls to a
    quarter (half) at once; while usage rises above the trend's start it falls by
    a tenth, at most every 5 s; it grows by half below 10 % and by a quarter
    below 20 % (largest and mean usage), at most every 30 s, with enough samples
    over enough of the window and no rise."""

    def __init__(self, most_ms: int = SCAN_MAX_MS):
        self.interval, self.most = START_MS, max(SCAN_MIN_MS, most_ms)
        self.samples: deque[tuple[int, float]] = deque()
        self.moved = self.damped = -(1 << 62)

    def add(self, now: int, usage: float) -> int:
        self.samples.append((now, usage))
        while self.samples[0][0] < now - WINDOW_MS:
            self.samples.popleft()
        values = [u for _, u in self.samples]
        last, top, mean = values[-1], max(values), sum(values) / len(values)
        rising = len(values) >= TREND_SAMPLES and last - values[0] > TREND_RISE and last > TREND_START
        grow = now - self.moved >= COOLDOWN_MS and len(values) >= GROW_SAMPLES and now - self.samples[0][0] >= GROW_SPAN_MS and not rising
        new, damp = self.interval, False
        if top > USAGE_CRITICAL:
            new = max(self.interval // 4, SCAN_MIN_MS)
        elif top > USAGE_HIGH:
            new = max(self.interval // 2, SCAN_MIN_MS)
        elif rising and now - self.damped >= TREND_COOLDOWN_MS:
            new, damp = max(self.interval * 9 // 10, SCAN_MIN_MS), True
        elif grow and top < USAGE_VERY_LOW:
            new = min(self.interval * 3 // 2, SCAN_MAX_MS)
        elif grow and top < USAGE_LOW:
            new = max(self.interval, min(self.interval * 5 // 4, self.most))
        if new != self.interval:
            self.interval, self.moved = new, now
            if damp:
                self.damped = now
        return self.interval


def scan_windows(samples: DataFrame, key: str, ms: str, usage: str, most_ms: int = SCAN_MAX_MS) -> DataFrame:
    """``key, ms, usage, interval_ms`` after every sample. The interval depends on
    all decisions before it, so a feed's samples are a fold in order; they stream
    through one task in Arrow batches, with 30 s of samples in memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, window = object(), None
        for pdf in batches:
            out = []
            for k, t, u in pdf.itertuples(index=False):
                if k != now:
                    now, window = k, ScanWindow(most_ms)
                out.append(window.add(int(t), u))
            yield pdf.assign(interval_ms=out)

    kind = samples.schema[key].dataType.simpleString()
    rows = samples.select(key, F.col(ms).cast("bigint").alias(ms), F.col(usage).cast("double").alias(usage)).where(F.col(ms).isNotNull() & F.col(usage).isNotNull() & F.col(key).isNotNull())
    placed = rows.repartition(key).sortWithinPartitions(key, ms, usage)
    return placed.mapInPandas(run, f"`{key}` {kind}, `{ms}` bigint, `{usage}` double, interval_ms bigint")
