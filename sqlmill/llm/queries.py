"""The registered query of each operator, and the pipeline, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import audit, bpe, exact_dedup, jaccard, langid, line_dedup, merkle, packing, quality, sharding, suffix, topk, toxicity
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_line_dedup", oracle="""
with l as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
w as (select doc_id, unnest(range(0, len(lines) - 2)) as pos, lines from l where len(lines) >= 3),
h as (select doc_id, pos, [lines[pos + 1], lines[pos + 2], lines[pos + 3]] as win from w),
o as (select doc_id, pos, row_number() over (partition by win order by doc_id, pos) as rn from h),
c as (select distinct doc_id, pos + unnest([0, 1, 2]) as j from o where rn > 1),
e as (select doc_id, unnest(range(0, len(lines))) as j, lines from l),
m as (select e.doc_id, e.j, lines[e.j + 1] as line, c.j is not null as gone
      from e left join c on c.doc_id = e.doc_id and c.j = e.j),
s as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by j), false) as opens from m)
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_removed, cast(sum(opens::int) as bigint) as n_spans,
       coalesce(string_agg(line, chr(10) order by j) filter (not gone), '') as text
from s group by doc_id
""")
def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_spans", "text")


@register("op2_packing")
def op2_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op3_exact_dedup", oracle="""
with d as (select doc_id, length(coalesce(text, '')) as n,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm from documents),
r as (select doc_id, norm, first_value(doc_id) over (partition by norm order by n desc, doc_id) as keep_id,
             count(*) over (partition by norm) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from r
""")
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_rows(table(spark, sf_dir, "documents"))


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.teaches())
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op5_bpe")
def op5_bpe(spark, sf_dir):
    coded = bpe.encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op6_sharding")
def op6_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))
    rows = docs.select("doc_id", (F.octet_length("bytes") + 1).cast("long").alias("size"), F.crc32("bytes").alias("text_crc32"))
    return sharding.shuffle_to_shards(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = langid.train(docs, ~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op8_topk_search", oracle="""
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
      from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""")
def op8_topk_search(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@register("op9_ngram_jaccard", oracle="""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
e as materialized (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as s
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as materialized (select doc_id, count(*) as n from e group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.s = b.s and a.doc_id <> b.doc_id group by all),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id as id, doc_id as c from documents union select l.b, r.c from r join l on l.a = r.id),
m as (select id, min(c) as component_id from r group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id
from documents d left join n on n.doc_id = d.doc_id join m on m.id = d.doc_id
""")
def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.linked(table(spark, sf_dir, "documents"))


@register("op10_suffix_array", oracle="""
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as materialized (select doc_id, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as i from d)),
f as (select s, min(doc_id) as least from w group by s having count(*) > 1),
g as (select w.doc_id, w.i from w join f on f.s = w.s and f.least < w.doc_id),
b as (select *, i > coalesce(lag(i) over (partition by doc_id order by i), -1000) + 50 as opens from g),
k as (select *, sum(opens::int) over (partition by doc_id order by i rows unbounded preceding) as run from b),
r as (select doc_id, run, min(i) as a, max(i) + 50 as e from k group by all),
p as (select *, coalesce(lag(e) over (partition by doc_id order by a), 0) as before from r),
x as (select p.doc_id, count(*) as n_spans, cast(sum(e - a) as bigint) as n_removed,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(h), 2 * max(e) + 1) as kept
      from p join d using (doc_id) group by p.doc_id)
select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join x using (doc_id)
""")
def op10_suffix_array(spark, sf_dir):
    done = suffix.dedup_bytes(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_merkle_manifest", oracle="""
with recursive bits as (select i, i as c, 0 as k from range(256) t(i)
      union all select i, xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end), k + 1 from bits where k < 8),
crc as materialized (select list(c order by i) as t from bits where k = 8),
d as materialized (select *, coalesce(xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
             string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 3 = 0, false) as changed
      from documents, crc),
p as materialized (select doc_id, lang, changed, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as body,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') as low from d),
f as materialized (select doc_id, lang, sha256(head || body) as leaf, sha256(head || case when changed then low else body end) as used from p),
l as materialized (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from f),
u as (select lang, 0 as level, pos, leaf as h, n from l
      union all
      select lang, level + 1, pos // 8, sha256(string_agg(h, '' order by pos)), (any_value(n) + 7) // 8 from u where n > 1 group by lang, level, pos // 8),
u1 as materialized (select * from u),
s as materialized (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as groups from u1 where n = 1),
v as (select 0 as level, place as pos, subroot as h, groups as n from s
      union all
      select level + 1, pos // 8, sha256(string_agg(h, '' order by pos)), (any_value(n) + 7) // 8 from v where n > 1 group by level, pos // 8),
v1 as materialized (select * from v),
r as (select h as root from v1 where n = 1),
us as materialized (select a.lang, a.level, a.pos, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as lft,
             coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as rgt
      from u1 a join u1 b on a.lang is not distinct from b.lang and a.level = b.level and a.pos // 8 = b.pos // 8 where a.n > 1 group by all),
vs as materialized (select a.level, a.pos, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as lft,
             coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as rgt
      from v1 a join v1 b on a.level = b.level and a.pos // 8 = b.pos // 8 where a.n > 1 group by all),
w as (select lang, pos as leaf_at, pos, 0 as level, used as h, '' as proof from l
      union all
      select w.lang, leaf_at, w.pos // 8, w.level + 1, sha256(lft || w.h || rgt), proof || lft || rgt
      from w join us on w.lang is not distinct from us.lang and w.level = us.level and w.pos = us.pos),
w1 as materialized (select lang, leaf_at, arg_max(h, level) as h, arg_max(proof, level) as proof from w group by lang, leaf_at),
x as (select w1.lang, leaf_at, place as pos, 0 as level, h, proof from w1 join s on w1.lang is not distinct from s.lang
      union all
      select lang, leaf_at, x.pos // 8, x.level + 1, sha256(lft || x.h || rgt), proof || lft || rgt
      from x join vs on x.level = vs.level and x.pos = vs.pos),
x1 as materialized (select lang, leaf_at, arg_max(h, level) as h, arg_max(proof, level) as proof from x group by lang, leaf_at)
select l.doc_id, l.leaf, subroot, root, sha256(proof) as proof_sha256, x1.h as folded_root, x1.h = root as verified
from l join x1 on l.lang is not distinct from x1.lang and l.pos = x1.leaf_at join s on l.lang is not distinct from s.lang, r
""")
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", audit.UPPER, audit.UPPER.lower())
    tampered = F.when(changed, merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lowered]))
    rows = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], carry={"tampered": tampered})
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")).alias("proof_sha256"),
                       merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op12_quality")
def op12_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op13_filter_audit", oracle="""
with d as materialized (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
least as materialized (select t, min(doc_id) as least from d group by t),
m as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
f as materialized (select part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
             regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] as fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
      from d join least using (t) left join m using (doc_id)),
c as materialized (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
x as (select unnest([1, 2, 3, 4, 5]) as i),
o as materialized (select [a.i, b.i, c.i, d.i, e.i] as way from x a, x b, x c, x d, x e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s as materialized (select way, i as step, way[i] as me, way[:i - 1] as earlier from o, x),
g as (select part, way, step, me, n, good, toxic, fails[me] as mine,
             len(list_filter(earlier, lambda k: fails[k])) > 0 as gone, len(list_filter(fails, lambda k: k)) as many from c, s),
r as materialized (select part, way, step, me, sum(n) filter (not gone and not mine) as kept, sum(n) filter (not gone and mine) as removed,
             sum(n) filter (gone and mine) as redundant, sum(n) filter (mine and many = 1) as unique_fails,
             sum(good) filter (not gone and mine) as good_lost, sum(toxic) filter (not gone and mine) as toxic_lost from g group by all)
select part, list_aggregate(list_transform(way, lambda k: 'ABCDE'[k]), 'string_agg', '') as filter_order, step::int as step,
       coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
       coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, me), 0)::bigint as shapley
from r
""")
def op13_filter_audit(spark, sf_dir):
    rows = audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.report(audit.coalitions(rows, len(audit.NAMES)), audit.NAMES)
