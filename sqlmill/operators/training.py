"""Training-set preparation (R1–R3) and training-run summaries.

Tokenisation is pluggable.  The built-in tokenizer is character level (one
id per code point) and runs as a JVM expression; a subword tokenizer can be
plugged in with :func:`tokenize_with` (``mapInPandas`` over Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL_PAD = -100


def char_token_ids(col) -> Column:
    """Whole-text character tokenisation: code point of every character."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?s)."), 0), lambda ch: F.ascii(ch))


def tokenize_with(df: DataFrame, fn: Callable[[list], list], text="prompt", out="token_ids") -> DataFrame:
    """Plug a batch tokenizer ``fn(list[str]) -> list[list[int]]`` into the plan."""
    schema = df.schema.add(out, "array<int>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.copy()
            b[out] = [list(map(int, ids)) for ids in fn(b[text].tolist())]
            yield b
    from ..session import ship_package
    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)


#: fixed value: longest training row, in tokens
MAX_LENGTH = 2048
#: Rows with token arrays that a task is meant to sort (three arrays of the longest: 24 KB a row).
WIDE_ROWS = 1 << 12


def training_rows(df: DataFrame, max_length: int = MAX_LENGTH, ids="token_ids") -> DataFrame:
    """Truncate to ``max_length``; attention mask of ones; labels = a copy
    of the ids (the prompt is not masked)."""
    t = F.slice(ids, 1, max_length)
    return (df.withColumn("input_ids", t)
              .withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
              .withColumn("labels", F.col("input_ids")))


def batch_ids(df: DataFrame, batch_size: int, ord_col="ord") -> DataFrame:
    """Batches of exactly ``batch_size`` rows in order (the last may be
    shorter): by dense position, as gaps in ``ord_col`` are no rows.  Rows may
    hold token arrays, so a task numbers few of them."""
    from .ordering import positions_within
    dense = positions_within(df, [], [ord_col], out="_pos", rows=WIDE_ROWS)
    return dense.withColumn("batch", F.floor((F.col("_pos") - 1) / batch_size).cast("bigint")).drop("_pos")


def pad_batches(df: DataFrame, pad_id: int = 0, batch="batch") -> DataFrame:
    """R2: right-pad every row to its batch's longest row (labels with -100).
    A batch is ``batch_size`` rows, so the window is small; the rows are counted
    (reading no token) for enough tasks."""
    from .ordering import spread
    w = Window.partitionBy(batch)
    d = spread(df, [batch], -(-df.select(batch).count() // WIDE_ROWS)).withColumn("_n", F.max(F.size("input_ids")).over(w) - F.size("input_ids"))
    pad = lambda v: F.array_repeat(F.lit(v), F.col("_n").cast("int"))
    return (d.withColumn("input_ids", F.concat("input_ids", pad(pad_id)))
             .withColumn("attention_mask", F.concat("attention_mask", pad(0)))
             .withColumn("labels", F.concat("labels", pad(LABEL_PAD)))
             .withColumnRenamed("_n", "n_pad"))


def mean_loss(losses: DataFrame, group=("run_id",), loss="loss") -> DataFrame:
    """Mean per-sample loss, 0 when there is none."""
    return losses.groupBy(*group).agg(F.coalesce(F.avg(loss), F.lit(0.0)).alias("mean_loss"),
                                      F.count(loss).alias("n_samples"))


def early_stopping(history: DataFrame, patience: int = 3, run="run_id", epoch="epoch", loss="loss",
                   min_delta: float = 0.0) -> DataFrame:
    """A10: an epoch improves when its loss is below the best one so far by more
    than ``min_delta``; training stops at the first epoch that ends ``patience``
    consecutive non-improving epochs.  With ``min_delta`` above 0 the best loss
    is that of the last improving epoch, which depends on the order of all
    earlier ones (``_early_stopping_delta``).

    (run_id, stop_epoch [NULL = never], epochs_run, best_loss, best_epoch).
    Running minimum and "last improvement" are skew-safe running aggregates
    (``ordering.running``); the result is one aggregate per run — no array of
    a run's history is ever built and no join on the run key is needed."""
    if min_delta:
        return _early_stopping_delta(history, patience, run, epoch, loss, min_delta)
    from .ordering import running, slice_bounds
    bounds = slice_bounds(history, [run], [epoch])
    h = running(history, [run], [epoch], loss, "min", "_best_before", inclusive=False, bounds=bounds)
    h = h.withColumn("_impr", F.col(loss) < F.coalesce(F.col("_best_before"), F.lit(float("inf"))))
    h = h.withColumn("_ie", F.when(F.col("_impr"), F.col(epoch)))
    h = running(h, [run], [epoch], "_ie", "max", "_last", bounds=bounds)
    h = h.withColumn("_best", F.least(F.col(loss), F.col("_best_before")))
    h = h.withColumn("_counter", F.col(epoch) - F.coalesce(F.col("_last"), F.lit(0)))
    stopping = F.when(F.col("_counter") >= patience, F.col(epoch))
    state = F.struct(F.col("_best").alias("b"), F.col("_last").alias("e"))
    g = h.groupBy(run).agg(
        F.min(stopping).alias("stop_epoch"), F.max(epoch).alias("_max"),
        F.min_by(state, stopping).alias("_at_stop"), F.max_by(state, F.col(epoch)).alias("_at_end"))
    best = F.coalesce(F.col("_at_stop"), F.col("_at_end"))
    return g.select(run, "stop_epoch", F.coalesce("stop_epoch", "_max").alias("epochs_run"),
                    best["b"].alias("best_loss"), best["e"].alias("best_epoch"))


#: Epochs of one slice of a run.
SLICE_EPOCHS = 1 << 16


def _early_stopping_delta(history: DataFrame, patience: int, run: str, epoch: str, loss: str, min_delta: float) -> DataFrame:
    """Early stopping as a chain of pointers instead of a fold over a run.

    An improving epoch points to the next one, the first later epoch below its
    loss by more than ``min_delta``; training goes on only if that is at most
    ``patience`` epochs away.  So a chain enters a slice of the run in one of its
    first ``patience`` epochs, whatever came before: every slice (with the next
    ``patience`` epochs behind it) finds by pointer doubling where each of these
    entries leaves it, and a run's slices, ``patience`` rows each, are chained."""
    import numpy as np

    from .ordering import positions_within
    width = max(SLICE_EPOCHS, 2 * patience)
    h = positions_within(history.select(run, epoch, loss), [run], [epoch], out="_pos").withColumn("_pos", F.col("_pos") - 1)
    own, place = F.floor(F.col("_pos") / width), F.col("_pos") % width
    h = h.withColumn("_slice", F.explode(F.when((own > 0) & (place < patience), F.array(own, own - 1)).otherwise(F.array(own))))
    kinds = {f.name: f.dataType.simpleString() for f in history.schema.fields}

    def slice_ends(rows: pd.DataFrame) -> pd.DataFrame:
        """Per entry: the entry of the next slice it leads to (NULL: none), or where training stops and with what."""
        rows = rows.sort_values("_pos")
        first = int(rows["_slice"].iloc[0]) * width
        x, e = rows[loss].to_numpy(float), rows[epoch].to_numpy()
        n, inside = len(rows), int((rows["_pos"] < first + width).sum())
        to = np.arange(n)
        for k in range(min(patience, n - 1), 0, -1):  # the nearest one is written last
            at = np.arange(n - k)
            better = x[at + k] < x[at] - min_delta
            to[at[better]] = at[better] + k
        to[inside:] = np.arange(inside, n)
        while True:
            further = to[to]
            if (further == to).all():
                break
            to = further
        out = []
        for entry in range(min(patience, inside) if first else 1):
            t = int(to[entry])
            stops = t < inside and t + patience < n
            out.append((rows[run].iloc[0], first // width, entry, t - inside if t >= inside else None, e[t + patience] if stops else None,
                        e[t + patience] if stops else e[-1], x[t], e[t]))
        return pd.DataFrame(out, columns=[run, "_slice", "_entry", "_exit", "stop_epoch", "epochs_run", "best_loss", "best_epoch"]).astype(
            {"_exit": "Int64", "stop_epoch": "Int64"})

    result = (f"stop_epoch {kinds[epoch]}, epochs_run {kinds[epoch]}, best_loss {kinds[loss]}, best_epoch {kinds[epoch]}")
    ends = h.groupBy(run, "_slice").applyInPandas(slice_ends, f"{run} {kinds[run]}, _slice long, _entry int, _exit int, {result}")

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        steps = {(s, i): k for k, (s, i) in enumerate(zip(rows["_slice"], rows["_entry"]))}
        s, i = 0, 0
        while True:
            row = rows.iloc[[steps[s, i]]]
            if row["_exit"].isna().iloc[0]:
                return row[[run, "stop_epoch", "epochs_run", "best_loss", "best_epoch"]].astype({"stop_epoch": "Int64"})
            s, i = s + 1, int(row["_exit"].iloc[0])
    return ends.groupBy(run).applyInPandas(chain, f"{run} {kinds[run]}, {result}")
