"""Model calls and generated samples.

The model is a plain Python function ``fn(list[str]) -> list[str]`` injected by
the caller; ``batch_inference`` runs it inside ``mapInPandas`` on Arrow
batches.  Everything around the call is DataFrame
code.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsontext import is_json
from ..functions.text import py_strip
from ..session import path_exists, persist_once, ship_package

ModelFn = Callable[[list], list]


def _is_timeout(e: Exception) -> bool:
    """A timeout by type or, as clients wrap them, by its text."""
    return isinstance(e, TimeoutError) or any(w in str(e).lower() for w in ("timeout", "timed out"))


#: Call slots of this worker process, by their number.  They outlive a task: a call that ran out
#: of time keeps its slot until it really ends.
_SLOTS: dict[int, threading.Semaphore] = {}


def _slots(n: int) -> threading.Semaphore:
    return _SLOTS.setdefault(n, threading.Semaphore(n))


def _limited(fn: ModelFn, prompts: list, limit_s: float | None, slots: threading.Semaphore | None = None) -> list:
    """``fn(prompts)`` in one of the ``slots``, with an optional time limit.  Python cannot end a
    running call, so a call beyond the limit holds its slot on and the next one waits for it."""
    slots = slots or threading.Semaphore(1)
    if not limit_s:
        with slots:
            return list(fn(prompts))
    if not slots.acquire(timeout=limit_s):
        raise TimeoutError(f"no call slot was free for {limit_s} s: earlier calls timed out and still run")
    box: dict = {}

    def run():
        try:
            box["out"] = list(fn(prompts))
        except Exception as e:  # noqa: BLE001 - handed to the caller
            box["error"] = e
        finally:
            slots.release()
    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(limit_s)
    if "error" in box:
        raise box["error"]
    if "out" in box:
        return box["out"]
    raise TimeoutError(f"model call timed out after {limit_s} s")


def _call_with_retries(fn: ModelFn, prompts: list, max_retries: int, base_wait: float, accept=None,
                       limit_s: float | None = None, slots: threading.Semaphore | None = None):
    """One batch: (responses, errors, attempts), one of each per prompt.

    Every prompt has ``max_retries`` tries.  The batch is sent whole once; rows
    that fail then, with the batch or by ``accept`` (a check that raises on an
    answer that does not parse), go on one by one with the tries they have
    left (one at least), so healthy rows are not sent again for a bad one.  Waits grow as
    ``base_wait * 2**k`` (``3**k`` after a timeout)."""
    n = len(prompts)
    answers, errors, tries = [None] * n, [None] * n, [0] * n

    def attempt(rows: list) -> Exception | None:
        """Sends the rows; the last error, if any row still has none of its tries succeeded."""
        last = None
        for i in rows:
            tries[i] += 1
        try:
            out = _limited(fn, [prompts[i] for i in rows], limit_s, slots)
            if len(out) != len(rows):
                raise ValueError(f"model returned {len(out)} answers for {len(rows)} prompts")
        except Exception as e:  # noqa: BLE001 - the model is user code
            for i in rows:
                errors[i] = f"{type(e).__name__}: {e}"
            return e
        for i, answer in zip(rows, out):
            try:
                if accept is not None:
                    accept(answer)
                answers[i], errors[i] = answer, None
            except Exception as e:  # noqa: BLE001 - an answer that does not parse is a failed try
                errors[i], last = f"{type(e).__name__}: {e}", e
        return last

    def pause(k: int, e: Exception) -> None:
        if base_wait > 0:
            time.sleep(base_wait * (3 if _is_timeout(e) else 2) ** k)

    e = attempt(list(range(n))) if n else None
    most = max(max_retries, 2) if n > 1 else max_retries  # a try of its own for each row of a failed batch
    if e is not None and most > 1:
        pause(0, e)
    for i in range(n):
        while errors[i] is not None and tries[i] < most:
            e = attempt([i])
            if e is not None and tries[i] < most:
                pause(tries[i] - 1, e)
    return answers, errors, tries


def must_be_json(answer) -> None:
    """``accept`` for prompts that ask for JSON: the whole answer must parse, or else (N10's order)
    its fenced part, or what lies between its first opening and last closing bracket."""
    import json
    text = str(answer).strip()
    try:
        json.loads(text)
        return
    except ValueError:
        pass
    for mark in ("```json", "```"):
        if mark in text and "```" in text.split(mark, 1)[1]:
            json.loads(text.split(mark, 1)[1].split("```", 1)[0])
            return
    starts = [k for k in (text.find("{"), text.find("[")) if k >= 0]
    if starts:
        end = text.rfind("}" if text[min(starts)] == "{" else "]")
        text = text[min(starts):end + 1]
    json.loads(text)


def batch_inference(df: DataFrame, fn: ModelFn, prompt="prompt", keys=("id",), concurrency: int | None = None,
                    batch_size: int = 8, max_retries: int = 3, base_wait: float = 1.0, accept=None,
                    limit_s: float | None = None, window: int = 1) -> DataFrame:
    """G1: (keys…, response, error, attempts) for every prompt row.

    A task has ``window`` calls in flight at most, one batch each, and returns
    their answers in the order of its rows.  ``concurrency`` bounds the calls
    of the whole job, however many partitions the prompts have: they are dealt
    to ``concurrency // window`` tasks (so ``window`` is at most that bound);
    left out, the input's partitioning stays.  ``accept(answer)`` may raise to
    have an answer tried again; ``limit_s`` bounds the wait for one call, which
    counts as in flight until it ends.  Model output is not repeatable, so persist
    the result (``sqlmill.session.persist_once``) before using it twice."""
    keys = list(keys)
    schema = T.StructType(
        [f for f in df.select(*keys).schema.fields]
        + [T.StructField("response", T.StringType()), T.StructField("error", T.StringType()),
           T.StructField("attempts", T.IntegerType())])

    if window < 1 or (concurrency and window > concurrency):
        raise ValueError(f"window must lie between 1 and concurrency, not {window}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = _slots(window)

        def answered(chunk: pd.DataFrame) -> pd.DataFrame:
            out = chunk[keys].copy()
            out["response"], out["error"], out["attempts"] = _call_with_retries(
                fn, chunk[prompt].tolist(), max_retries, base_wait, accept, limit_s, slots)
            return out
        chunks = (pdf.iloc[s:s + batch_size] for pdf in batches for s in range(0, len(pdf), batch_size))
        with ThreadPoolExecutor(window) as pool:
            waiting: deque = deque()
            for chunk in chunks:
                if len(waiting) == window:
                    yield waiting.popleft().result()
                waiting.append(pool.submit(answered, chunk))
            while waiting:
                yield waiting.popleft().result()

    ship_package(df.sparkSession)
    rows = df.select(*keys, prompt)
    return (rows.repartition(concurrency // window) if concurrency else rows).mapInPandas(run, schema)


def parse_samples(responses: DataFrame, keys=("topic_id",), response="response"):
    """(keys…, line_no, input, output) from JSON-lines model output.

    Lines are stripped; blank lines and lines starting with '#' or '//' are
    skipped; a line must be a JSON object with string ``input`` and
    ``output`` (both stripped).  Returns (samples, rejected) where rejected =
    (keys…, line_no, line) for non-comment lines that failed — the reference
    instead loses the whole topic on a non-string value (deliberate divergence)."""
    keys = list(keys)
    lines = responses.select(*keys, F.posexplode(F.split(py_strip(response), "\n", -1)).alias("line_no", "raw"))
    lines = lines.select(*keys, F.col("line_no").cast("bigint").alias("line_no"), py_strip("raw").alias("line"))
    fields = F.from_json("line", "input variant, output variant", {"allowSingleQuotes": "false"})
    lines = lines.withColumn("v", F.when(is_json("line") & F.col("line").startswith("{"), fields))
    typ = lambda name: F.schema_of_variant(F.col(f"v.{name}"))
    ok = F.col("v").isNotNull() & (typ("input") == "STRING") & (typ("output") == "STRING")
    skip = (F.col("line") == "") | F.col("line").startswith("#") | F.col("line").startswith("//")
    sample = F.struct(*[F.col(k) for k in keys], F.col("line_no"),
                      py_strip(F.try_variant_get("v.input", "$", "string")).alias("input"),
                      py_strip(F.try_variant_get("v.output", "$", "string")).alias("output"))
    # generators instead of filters keep the parse from being inlined twice
    samples = lines.select(F.inline(F.when(~skip & F.coalesce(ok, F.lit(False)), F.array(sample))))
    rejected = lines.select(F.inline(F.when(~skip & ~F.coalesce(ok, F.lit(False)),
                                            F.array(F.struct(*[F.col(k) for k in keys], "line_no", "line")))))
    return samples, rejected


def cap_per_topic(samples: DataFrame, targets: DataFrame, keys=("topic_id",), order=("pass", "line_no")) -> DataFrame:
    """Keep the first ``target`` samples of each topic in generation order.
    A topic's samples come from one or two model answers, so the window is small."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    j = samples.join(targets.select(*keys, "target"), keys)
    return j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.col("target")).drop("_rn", "target")


def topic_shortfall(samples: DataFrame, targets: DataFrame, keys=("topic_id",)) -> DataFrame:
    """(keys…, target, n_samples, shortfall) — topics with a zero count still appear."""
    keys = list(keys)
    n = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"))
    j = targets.select(*keys, "target").join(n, keys, "left").fillna(0, ["n_samples"])
    return j.withColumn("shortfall", F.greatest(F.col("target") - F.col("n_samples"), F.lit(0)))


def union_topics(first: DataFrame, topup: DataFrame, targets: DataFrame, keys=("topic_id",)) -> DataFrame:
    """G5 + G3: first-pass samples, then top-up samples, capped per topic."""
    both = first.withColumn("pass", F.lit(1)).unionByName(topup.withColumn("pass", F.lit(2)))
    return cap_per_topic(both, targets, keys)


def cached_inference(df: DataFrame, fn: ModelFn, cache_path: str, prompt="prompt", keys=("id",),
                     **kwargs) -> DataFrame:
    """G1 with answers stored by prompt hash under ``cache_path`` (a table in the
    shared folder).  Only prompts without a stored successful answer reach the
    model; new successful answers are appended, so a rerun or a resumed job
    never pays for the same prompt twice.  Returns (keys…, response, error).

    Calls happen in the one write job; the returned frame reads the stored
    answers (and the failures of this call), it does not call the model."""
    spark = df.sparkSession
    keys = list(keys)
    h = F.sha2(F.col(prompt), 256)
    d = df.select(*keys, prompt).withColumn("prompt_hash", h)
    if path_exists(spark, cache_path):
        done = spark.read.parquet(cache_path)
    else:
        done = spark.createDataFrame([], "prompt_hash string, response string")
    todo = d.join(done.select("prompt_hash"), "prompt_hash", "left_anti").dropDuplicates(["prompt_hash"])
    # the call result is written once; both the cache append and the error
    # rows read that copy, so no prompt is sent to the model twice
    fresh = persist_once(batch_inference(todo.select("prompt_hash", prompt), fn, prompt=prompt,
                                         keys=("prompt_hash",), **kwargs), spark, "answers")
    fresh.where(F.col("error").isNull()).select("prompt_hash", "response").write.mode("append").parquet(cache_path)
    stored = spark.read.parquet(cache_path).dropDuplicates(["prompt_hash"])
    # prompts whose call failed this time keep the model's error text
    errs = fresh.where(F.col("error").isNotNull()).select("prompt_hash", F.col("error").alias("_err"))
    return (d.join(stored, "prompt_hash", "left").join(errs, "prompt_hash", "left")
             .select(*keys, "response", F.when(F.col("response").isNull(), F.coalesce("_err", F.lit("no answer")))
                     .alias("error")))
