"""Windowed traffic counts and their scores against stored baselines."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators.spikes import add_scores, is_spike

def window_counts(
    events: DataFrame, time: str = "ts", width: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Traffic per tumbling window and edge; works on streams and tables alike."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(time, delay)
    counts = timed.groupBy(F.window(time, width), "prev", "curr").agg(F.sum("n").alias("n"))
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "prev", "curr", "n"
    )


def score_windows(counts: DataFrame, baselines: DataFrame, **scoring) -> DataFrame:
    """Join (stream-static) with baselines per edge and add the spike measures.

    In append mode every window is final, so ``alerts`` may follow in the same
    plan; in update mode a window may still change after it was reported.
    """
    return add_scores(counts.join(baselines, ["prev", "curr"]), **scoring)


def alerts(scored: DataFrame, z_threshold: float = 3.5, ratio_threshold: float = 10.0) -> DataFrame:
    return scored.filter(is_spike(z_threshold, ratio_threshold))


#: What is kept of an edge between batches, and what is said of each of its windows.
_STATE = "windows long, mean double, squares double, last timestamp"
_SCORES = "prev string, curr string, window_start timestamp, n long, seen long, baseline_mean double, baseline_std double, z_score double, deviation_ratio double"


def running_scores(counts: DataFrame, delay: str = "1 hour", keep: str = "30 days", epsilon: float = 0.01) -> DataFrame:
    """Every window of an edge against the running mean and deviation of the edge's windows before it.

    ``counts`` is a stream of closed windows (window_start, prev, curr, n), each edge's in order of time from
    batch to batch.  An edge's state is four numbers; it is dropped once the watermark is ``keep`` past its last
    window, and the edge then starts anew.  The first window of an edge has ``seen`` 0 and no scores.
    """
    span = int(pd.Timedelta(keep).total_seconds() * 1000)

    def judge(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        seen, mean, squares, last = state.get if state.exists else (0, 0.0, 0.0, pd.Timestamp(0))
        rows = pd.concat(list(batches)).sort_values("window_start")
        out = []
        for start, n in zip(rows["window_start"], rows["n"], strict=True):
            std = (squares / (seen - 1)) ** 0.5 if seen > 1 else None
            z = (n - mean) / (std + epsilon) if std is not None else None
            ratio = n / mean if seen and mean > 0 else None
            out.append((key[0], key[1], start, n, seen, mean if seen else None, std, z, ratio))
            seen += 1
            off = n - mean
            mean += off / seen
            squares += off * (n - mean)
            last = max(last, start)
        state.update((seen, mean, squares, last.to_pydatetime()))
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000), state.getCurrentWatermarkMs()) + span)
        yield pd.DataFrame(out, columns=["prev", "curr", "window_start", "n", "seen", "baseline_mean", "baseline_std", "z_score", "deviation_ratio"])

    timed = counts.select("prev", "curr", "window_start", F.col("n").cast("long").alias("n")).withWatermark("window_start", delay)
    return timed.groupBy("prev", "curr").applyInPandasWithState(judge, _SCORES, _STATE, "append", "EventTimeTimeout")
