"""Queries for sinks (round trips through files), scans, captions, training
data, and run monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import captions as C
from ..operators import evaluation as ev
from ..operators import generation as G
from ..operators import parse
from ..operators import prompts as PR
from ..operators import runs as R
from ..operators import training as TR
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import files as S
from ..sources import fixtures, ordered
from .oracle_base import D1, D6, PAIRS, blank, q, strip
from .queries_eval import TEXT_METRICS
from .queries_gen import render_sql
from .queries_text import SHAREGPT_SQL, conversation_pairs
from .registry import register

ALPACA_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])


def _d1(spark, sf_dir):
    return fixtures.samples(spark, sf_dir)


# ---------------------------------------------------------------- K1 / K2 / K3 / K4 / S1 / S2

@register("export_alpaca", f"with {D1} select {q(W.DEFAULT_INSTRUCTION)} as instruction, input, output from d1")
def q_export_alpaca(spark, sf_dir):
    path = scratch_path(spark, "alpaca")
    W.export(_d1(spark, sf_dir), path, "Alpaca")
    return S.scan_jsonl(spark, path, ALPACA_SCHEMA)


SHAREGPT_SCHEMA = T.StructType([T.StructField("conversations", T.ArrayType(parse.TURN))])


@register("scan_jsonl", f"""with {D1} select {strip('input')} as question, {strip('output')} as sql from d1
 where not {blank('input')} and not {blank('output')}""")
def q_scan_jsonl(spark, sf_dir):
    """K2 export, S1 scan, N2 parse: the ShareGPT round trip."""
    path = scratch_path(spark, "sharegpt")
    W.export(_d1(spark, sf_dir), path, "sharegpt")
    back = S.ensure_not_empty(S.scan_jsonl(spark, path, SHAREGPT_SCHEMA))
    return parse.parse_sharegpt(back, keys=())


@register("scan_json_array", f"""with {D1} select sample_id as ord,
 case when input <> '' then {strip("concat(input, chr(10), input)")} else '' end as question,
 {strip('output')} as sql from d1""")
def q_scan_json_array(spark, sf_dir):
    """Alpaca rows (instruction = input = the question) written as JSON arrays, read back (S2), parsed."""
    d = _d1(spark, sf_dir).select(F.col("sample_id").alias("ord"), F.col("input").alias("instruction"),
                                  "input", "output")
    path = scratch_path(spark, "arrays")
    S.write_json_arrays(d, path)
    schema = T.StructType([T.StructField("ord", T.LongType())] + ALPACA_SCHEMA.fields)
    return parse.parse_alpaca(S.scan_json_array(spark, path, schema))


@register("scan_large_json_array", f"""with {D1} select sample_id as ord, input as instruction, input, output from d1""")
def q_scan_large_json_array(spark, sf_dir):
    """All samples as one JSON array in one file, read back by byte ranges."""
    d = _d1(spark, sf_dir).select(F.col("sample_id").alias("ord"), F.col("input").alias("instruction"), "input", "output")
    path = scratch_path(spark, "array")
    S.write_json_arrays(d.coalesce(1), path, rows_per_file=1 << 40)
    schema = T.StructType([T.StructField("ord", T.LongType())] + ALPACA_SCHEMA.fields)
    return ordered.scan_large_json_array(spark, path, schema)


def _in_order(rows, order, path):
    W.write_in_order(rows, path, order)
    return path


@register("first_n_file_order", f"""with {D1} select row_number() over (order by ord) - 1 as ord, input, output from d1
 order by d1.ord limit 1000""")
def q_first_n_file_order(spark, sf_dir):
    """Samples exported in order (K1) to several files; the first 1000 in file order."""
    d = _d1(spark, sf_dir).select(F.col("ord").alias("_o"), "input", "output")
    path = _in_order(d, "_o", scratch_path(spark, "ordered"))
    return ordered.first_n_in_file_order(spark, path, "input string, output string", 1000)


@register("export_in_order", f"""with {D1} select row_number() over (order by ord) - 1 as ord, input, output from d1""")
def q_export_in_order(spark, sf_dir):
    """K1 in generation order: every sample's place in the files, read in file order."""
    d = _d1(spark, sf_dir).select(F.col("ord").alias("_o"), "input", "output")
    path = _in_order(d, "_o", scratch_path(spark, "ordered"))
    return S.with_file_order(S.scan_jsonl(spark, path, "input string, output string"))


@register("zip_sources", f"""with {PAIRS} select row_number() over (order by ord) - 1 as ord, prediction, reference from pairs""")
def q_zip_sources(spark, sf_dir):
    """J1 without keys: predictions and references in files that are split differently, put side by side."""
    p = fixtures.prediction_pairs(spark, sf_dir)
    left = _in_order(p.select("ord", "prediction"), "ord", scratch_path(spark, "predictions"))
    right = scratch_path(spark, "references")
    W.write_in_order(p.select("ord", "reference"), right, "ord", parts=3)
    return ordered.zip_in_file_order(S.scan_jsonl(spark, left, "prediction string"), S.scan_jsonl(spark, right, "reference string"))


@register("write_samples", f"with {D1} select db_id, input, output from d1")
def q_write_samples(spark, sf_dir):
    path = scratch_path(spark, "samples")
    W.write_samples(_d1(spark, sf_dir), path)
    back = spark.read.schema("input string, output string, db_id bigint").json(path)
    return back.select(F.col("db_id").cast("bigint").alias("db_id"), "input", "output")


@register("eval_report", TEXT_METRICS)
def q_eval_report(spark, sf_dir):
    """K7: metrics and detail rows written as two outputs; the metrics read back."""
    from ..session import persist_once
    pairs = fixtures.prediction_pairs(spark, sf_dir)
    folder = scratch_path(spark, "report")
    scored = persist_once(ev.scored_pairs(pairs), spark, "scored")   # score once, write twice
    W.write_report(ev.metrics_from_scored(scored), ev.details_from_scored(scored), folder)
    return spark.read.schema("run_id bigint, exact_match double, token_f1 double, total_samples bigint").json(
        f"{folder}/metrics")


# ---------------------------------------------------------------- S10 / S11 / J5 / F9 / A7 / G2 / K5

UPLOADS = """up as (select page_id, concat(regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1),
   case when page_id % 10 = 9 then '.txt' else '.png' end) as name,
   case when page_id % 10 = 9 then 'text/plain' else 'image/png' end as mime, encode(html) as content from pages),
st as (select page_id, name as original_name,
   concat(md5(cast(page_id as varchar)), case when regexp_replace(name, '^\\.+', '') like '%.%'
     then concat('.', string_split(regexp_replace(name, '^\\.+', ''), '.')[-1]) else '' end) as saved_name,
   octet_length(content) as size from up where starts_with(mime, 'image/')),
req as (select saved_name as file from st union all
   select concat('missing-', cast(page_id as varchar), '.png') from st where page_id % 17 = 0),
mp as (select saved_name, original_name from st where page_id % 3 <> 0),
res as (select r.file, s.saved_name is not null as "exists", coalesce(m.original_name, r.file) as original_name
   from req r left join st s on r.file = s.saved_name left join mp m on r.file = m.saved_name),
cap as (select saved_name as file, case when size % 7 <> 0 then concat('A page of ', cast(size as varchar), ' bytes') end as description,
   case when size % 7 = 0 then 'caption call failed' end as error from st),
status as (select res.file, original_name,
   case when "exists" and cap.error is null and cap.description is not null then 'success' else 'failed' end as status,
   case when "exists" and cap.error is null and cap.description is not null then cap.description end as description,
   case when not ("exists" and cap.error is null and cap.description is not null)
        then (case when not "exists" then '文件不存在' else cap.error end) end as error
   from res left join cap on res.file = cap.file)"""


@register("image_payload", f"""with {UPLOADS} select name, mime, octet_length(content) as size, to_base64(content) as payload
 from up where starts_with(mime, 'image/')""")
def q_image_payload(spark, sf_dir):
    return S.image_payload(fixtures.uploads(spark, sf_dir))


@register("upload_manifest", f"with {UPLOADS} select original_name, saved_name, size from st")
def q_upload_manifest(spark, sf_dir):
    return fixtures.stored_uploads(spark, sf_dir).drop("page_id")


def _resolved(spark, sf_dir):
    st = fixtures.stored_uploads(spark, sf_dir)
    req, mapping = fixtures.caption_requests(spark, sf_dir)
    return st, C.resolve_requests(req, st, mapping)


@register("name_mapping", f'with {UPLOADS} select file, "exists", original_name from res')
def q_name_mapping(spark, sf_dir):
    return _resolved(spark, sf_dir)[1]


def jvm_captions(st):
    """Stand-in caption model as a JVM expression (so the status logic is oracle-checked)."""
    fail = F.col("size") % 7 == 0
    return st.select(F.col("saved_name").alias("file"),
                     F.when(~fail, F.concat(F.lit("A page of "), F.col("size").cast("string"), F.lit(" bytes")))
                     .alias("description"),
                     F.when(fail, F.lit("caption call failed")).alias("error"))


def _status(spark, sf_dir):
    st, res = _resolved(spark, sf_dir)
    return C.caption_status(res, jvm_captions(st))


@register("caption_status", f"with {UPLOADS} select * from status")
def q_caption_status(spark, sf_dir):
    return _status(spark, sf_dir)


@register("caption_counts", f"with {UPLOADS} select status, count(*) as n from status group by status")
def q_caption_counts(spark, sf_dir):
    return C.caption_counts(_status(spark, sf_dir))


def stand_in_vision(prompts):
    """Deterministic stand-in for a vision endpoint: fails on payloads whose
    length is a multiple of 7, otherwise describes the payload size."""
    out = []
    for p in prompts:
        if len(p) % 7 == 0:
            raise RuntimeError("vision call failed")
        out.append(f"An image payload of {len(p)} base64 characters")
    return out


@register("caption_inference", f"""with {UPLOADS}, p as (select name, length(to_base64(content)) as n from up
 where starts_with(mime, 'image/'))
select name, case when n % 7 <> 0 then concat('An image payload of ', cast(n as varchar), ' base64 characters') end as response,
 case when n % 7 = 0 then 'RuntimeError: vision call failed' end as error from p""")
def q_caption_inference(spark, sf_dir):
    """Caption calls over the image payloads; a failing call fails only its own row."""
    p = S.image_payload(fixtures.uploads(spark, sf_dir))
    r = G.batch_inference(p, stand_in_vision, prompt="payload", keys=("name",), base_wait=0.0, max_retries=2)
    return r.select("name", "response", "error")


@register("export_multimodal", f"""with {UPLOADS} select original_name as image, '{W.IMAGE_QUESTION}' as user_content,
 description as assistant_content from status where status = 'success'""")
def q_export_multimodal(spark, sf_dir):
    ok = _status(spark, sf_dir).where(F.col("status") == "success")
    path = W.export_multimodal(ok, scratch_path(spark, "captions"))
    back = spark.read.schema(
        "messages array<struct<role:string,content:string>>, images array<string>").json(path)
    return back.select(F.col("images")[0].alias("image"), F.col("messages")[0]["content"].alias("user_content"),
                       F.col("messages")[1]["content"].alias("assistant_content"))


# ---------------------------------------------------------------- R1-R3 / A9 / A10

MAX_LENGTH, BATCH = TR.MAX_LENGTH, 8


def _train_rows(spark, sf_dir):
    p = conversation_pairs(spark, sf_dir)
    t = p.select("conv_id", PR.build_prompt("question", "sql").alias("prompt"))
    t = t.withColumn("token_ids", TR.char_token_ids("prompt"))
    return TR.training_rows(t, MAX_LENGTH)


TRAIN_SQL = f"""with p as ({SHAREGPT_SQL}),
t as (select conv_id, list_transform(regexp_extract_all({render_sql(
    PR.TRAIN_TEMPLATE, system=q(PR.SYSTEM_PROMPT), question='question', sql='sql')}, '(?s).'), lambda c: unicode(c)) as ids from p),
r as (select conv_id, len(ids) as full_length, ids[1:{MAX_LENGTH}] as input_ids from t)"""


@register("training_rows", TRAIN_SQL + """ select conv_id, full_length, len(input_ids) as n_tokens,
 array_to_string(input_ids, ',') as input_ids, len(input_ids) as mask_sum, true as labels_equal from r""")
def q_training_rows(spark, sf_dir):
    r = _train_rows(spark, sf_dir)
    return r.select("conv_id", F.size("token_ids").cast("bigint").alias("full_length"),
                    F.size("input_ids").cast("bigint").alias("n_tokens"),
                    F.array_join("input_ids", ",").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_sum"),
                    (F.col("labels") == F.col("input_ids")).alias("labels_equal"))


@register("batch_ids", TRAIN_SQL + f" select conv_id, floor((row_number() over (order by conv_id) - 1) / {BATCH})::bigint as batch from r")
def q_batch_ids(spark, sf_dir):
    return TR.batch_ids(conversation_pairs(spark, sf_dir).select("conv_id"), BATCH, "conv_id")


@register("pad_batches", TRAIN_SQL + f""",
b as (select *, floor((row_number() over (order by conv_id) - 1) / {BATCH})::bigint as batch from r),
m as (select *, max(len(input_ids)) over (partition by batch) - len(input_ids) as n_pad from b)
select conv_id, batch, n_pad, len(input_ids) + n_pad as padded_length,
 array_to_string(list_concat(input_ids, list_transform(range(n_pad), lambda x: 0)), ',') as input_ids,
 array_to_string(list_concat(list_transform(input_ids, lambda x: 1), list_transform(range(n_pad), lambda x: 0)), ',') as attention_mask,
 array_to_string(list_concat(input_ids, list_transform(range(n_pad), lambda x: -100)), ',') as labels from m""")
def q_pad_batches(spark, sf_dir):
    p = TR.pad_batches(TR.batch_ids(_train_rows(spark, sf_dir), BATCH, "conv_id"))
    return p.select("conv_id", "batch", F.col("n_pad").cast("bigint").alias("n_pad"),
                    F.size("input_ids").cast("bigint").alias("padded_length"),
                    F.array_join("input_ids", ",").alias("input_ids"),
                    F.array_join("attention_mask", ",").alias("attention_mask"),
                    F.array_join("labels", ",").alias("labels"))


@register("mean_loss", f"with {D6} select run_id, coalesce(avg(loss), 0.0) as mean_loss, count(loss) as n_samples from d6 group by run_id")
def q_mean_loss(spark, sf_dir):
    return TR.mean_loss(fixtures.epoch_losses(spark, sf_dir))


@register("early_stopping", f"""with {D6},
h as (select *, min(loss) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding) as bb from d6),
h2 as (select *, loss < coalesce(bb, 'inf'::double) as impr from h),
h3 as (select *, epoch - coalesce(max(case when impr then epoch end) over (partition by run_id order by epoch
  rows between unbounded preceding and current row), 0) as counter from h2),
s as (select run_id, min(case when counter >= 3 then epoch end) as stop_epoch, max(epoch) as mx from h3 group by run_id),
j as (select h3.*, s.stop_epoch from h3 join s using (run_id) where epoch <= coalesce(s.stop_epoch, s.mx))
select run_id, any_value(stop_epoch) as stop_epoch, max(epoch) as epochs_run,
 arg_min(loss, (loss, epoch)) as best_loss, arg_min(epoch, (loss, epoch)) as best_epoch from j group by run_id""")
def q_early_stopping(spark, sf_dir):
    return TR.early_stopping(fixtures.epoch_losses(spark, sf_dir))


# ---------------------------------------------------------------- T1 / T2 / N17 / A8

LOG = """lg as (select user_id as run_id, ts, event_id as seq, event_type,
  case when event_type = 'error' then 'ERROR' when event_type = 'signup' then 'CRITICAL'
   when event_type = 'purchase' then 'WARNING' when event_type = 'click' then 'DEBUG' else 'INFO' end as level_name,
  event_id % 6 + 1 as step, concat(event_type, ' event ', cast(event_id as varchar)) as message from events)"""


def _log(spark, sf_dir):
    return fixtures.run_log(spark, sf_dir, keep=("event_type",))


@register("log_level", f"""with {LOG} select run_id, seq, case lower(level_name) when 'debug' then 'debug' when 'info' then 'info'
 when 'warning' then 'warning' when 'error' then 'error' when 'critical' then 'error' else 'info' end as level from lg""")
def q_log_level(spark, sf_dir):
    return fixtures.run_log(spark, sf_dir).select("run_id", "seq", R.log_level("level_name").alias("level"))


@register("latest_logs", f"""with {LOG} select run_id, rank, seq, message from
 (select *, row_number() over (partition by run_id order by ts desc, seq desc) as rank from lg) where rank <= 10""")
def q_latest_logs(spark, sf_dir):
    return R.latest_logs(fixtures.run_log(spark, sf_dir), n=10).select("run_id", "rank", "seq", "message")


@register("run_status", f"""with {LOG}, g as (select run_id, arg_max(step, (ts, seq)) as current_step,
  arg_max(event_type, (ts, seq)) as lt, min(ts) as st, max(ts) as et from lg group by run_id)
select run_id, current_step, 6 as total_steps, floor(current_step / 6 * 100)::int as progress,
 case when lt = 'error' then 'failed' when current_step >= 6 then 'completed' else 'running' end as status,
 date_diff('microsecond', st, et) / 1e6 as duration_sec from g""")
def q_run_status(spark, sf_dir):
    return R.run_status(_log(spark, sf_dir))


@register("batch_throughput", """select user_id as run_id, event_id as batch_no, 8::bigint as n, value as seconds,
 case when value = 0 then null else 8 / value end as samples_per_sec from events""")
def q_batch_throughput(spark, sf_dir):
    return R.batch_throughput(fixtures.batch_timings(spark, sf_dir))


@register("throughput_stats", """select user_id as run_id, sum(8)::bigint as total_samples, count(*) as n_batches,
 sum(value) as total_time, case when sum(8) = 0 then null else sum(value) / sum(8) end as avg_time_per_sample,
 case when sum(value) = 0 then null else sum(8) / sum(value) end as throughput from events group by user_id""")
def q_throughput_stats(spark, sf_dir):
    return R.throughput_stats(fixtures.batch_timings(spark, sf_dir))


# ---------------------------------------------------------------- K8: benchmark samples report

def _bench_samples(spark, sf_dir):
    """Benchmark rows (N3) with a stand-in model that answers each question with
    its reference in a SQL fence; generated = extracted SQL (N8), stripped."""
    from ..functions.sqltext import extract_sql
    from ..functions.text import py_strip
    v = parse.bench_view(fixtures.mixed_corpus(spark, sf_dir), keys=("dataset_id", "ord"))
    out = F.concat(F.lit("```sql\n"), F.col("reference"), F.lit("\n```"))
    return v.select("dataset_id", F.col("ord").alias("id"), "question", "reference",
                    py_strip(extract_sql(out)).alias("generated"))


def _bench_samples_sql() -> str:
    from .queries_eval import extract_sql_sql
    from .queries_text import MIXED_CTE
    x = "concat('```sql', chr(10), reference, chr(10), '```')"
    return f"""with {MIXED_CTE},
f as (select *, case when c is not null then 'sharegpt' when instruction is not null then 'alpaca' end as format from mixed),
v as (select dataset_id, ord as id,
 case when format = 'alpaca' then {strip("concat(coalesce(instruction, ''), ' ', coalesce(input, ''))")}
      else {strip("case when coalesce(len(c), 0) > 0 then coalesce(c[1].content, '') else '' end")} end as question,
 case when format = 'alpaca' then {strip("coalesce(output, '')")}
      else {strip("case when coalesce(len(c), 0) > 1 then coalesce(c[-1].content, '') else '' end")} end as reference
 from f where format is not null)
select dataset_id, id, question, reference, {strip(f"coalesce({extract_sql_sql(x)}, {strip(x)})")} as generated from v"""


@register("bench_samples", _bench_samples_sql())
def q_bench_samples(spark, sf_dir):
    """K8: throughput stats and sample rows written as two outputs; the samples read back."""
    folder = scratch_path(spark, "bench-report")
    W.write_report(R.throughput_stats(fixtures.batch_timings(spark, sf_dir), batch_size=8),
                   _bench_samples(spark, sf_dir), folder)
    return spark.read.schema("dataset_id string, id bigint, question string, reference string, generated string") \
        .json(f"{folder}/details")
