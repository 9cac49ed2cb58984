"""Registered queries of the corpus operators, and their DuckDB statements.

A query reads whole tables and binds an operator to its production
parameters; the operator does the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.divergence import source_divergence
from riskspark.llm.embedding_dups import near_duplicates
from riskspark.llm.exact_dedup import exact_dedup
from riskspark.llm.language import identify_languages
from riskspark.llm.mixing import pareto_mix
from riskspark.llm.ngram_join import similar_documents
from riskspark.llm.packing import pack_documents
from riskspark.llm.phrases import collocations
from riskspark.llm.quality import score_quality
from riskspark.llm.tokens import count_tokens
from riskspark.llm.topk import top_k
from riskspark.llm.toxicity import toxic_documents
from riskspark.llm.warc import archive_pages

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id", "class_links")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_exact_topk": op4_exact_topk,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_source_mix": op7_source_mix,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity_chain": op10_toxicity_chain,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_source_divergence": op13_source_divergence,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
with t as (select doc_id, {_LOWER} as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
select t.doc_id, g.keep_id, cast(g.group_size as bigint) as group_size,
       t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g on t.norm = g.norm""",
    "op4_exact_topk": """
with v as (
  select vec_id, row_number() over (order by vec_id) as rid, embedding from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
w as (
  select rid, vec_id, unnest(range(len(embedding))) as j,
         cast(floor(64 * cast(unnest(embedding) as double)) as bigint) as w from v),
p as (
  select q.rid as qrid, q.vec_id as query_id, c.rid, c.vec_id, cast(sum(q.w * c.w) as bigint) as score
  from w q join w c on q.j = c.j and q.rid <> c.rid
  where q.vec_id % 20 = 0 group by all),
r as (
  select *, cast(row_number() over (partition by qrid order by score desc, vec_id, rid) as integer) as rank from p)
select query_id, rank, vec_id, score from r where rank <= 20""",
    "op7_source_mix": r"""
with d as (
  select doc_id, source,
         cast(coalesce(length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')), 0) as bigint) as size,
         (cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), 'null')), 1, 12) as bigint) + 0.5::double) / 281474976710656.0::double as u
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
         ([5.0::double, 2.0::double, 1.0::double])[1 + (row_number() over (order by source asc nulls last) - 1) % 3] as w
  from d group by source),
f as (
  select *, source_size::double * 2 as bound,
         1.5::double * sum(source_size::double) over () - coalesce(sum(source_size::double * 2) over before, 0.0::double) as remaining,
         sum(w) over () - coalesce(sum(w) over before, 0.0::double) as remaining_w
  from s
  window before as (order by source_size::double * 2 / w, source asc nulls last rows between unbounded preceding and 1 preceding)),
c as (select *, remaining * w >= bound * remaining_w as cut from f),
l as (
  select *, (1.5::double * sum(source_size::double) over () - sum(case when cut then bound else 0.0::double end) over ())
            / nullif(sum(case when cut then 0.0::double else w end) over (), 0.0::double) as level
  from c),
t as (
  select source, source_size, case when cut then bound else w * level end as target from l),
e as (
  select d.doc_id, d.source, d.size, d.u, t.source_size, t.target,
         least(coalesce(t.target / nullif(t.source_size::double, 0.0::double), 0.0::double), 2.0::double) as expected
  from d join t on d.source is not distinct from t.source),
p as (
  select *, cast(floor(expected) as bigint) as whole, expected - floor(expected) as p from e),
o as (
  select *, case when p > 0 then (u / (1 - u)) / (p / (1 - p)) end as odds from p),
r as (
  select *, case when odds is not null then
            least(cast(floor(odds / (1 + odds) * 68719476736.0::double) as bigint), 68719476735) end as rk,
         target - sum(whole * size) over (partition by source) as budget
  from o),
x as (
  select *, sum(case when rk is null then 0 else size end) over (
           partition by source order by rk asc nulls last, doc_id asc nulls first, size
           rows between unbounded preceding and current row) - size as passed
  from r)
select doc_id, size, source_size, target,
       cast(size * (whole + case when rk is not null and passed + size / 2.0::double <= budget then 1 else 0 end) as bigint) as taken
from x""",
    "op11_embedding_near_dedup": """
with recursive a as (
  select row_number() over () as rid, vec_id, embedding is not null and len(embedding) > 0
         and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
         and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok,
         cast(embedding as double[]) as v from embeddings),
links as (
  select x.rid as one, y.rid as two from a x join a y on x.rid <> y.rid
  where x.ok and y.ok and list_cosine_similarity(x.v, y.v) >= 0.9),
reach as (
  select rid as one, rid as two from a
  union select r.one, l.two from reach r join links l on r.two = l.one),
c as (
  select r.one, min(a.vec_id) as component_id from reach r join a on a.rid = r.two group by r.one)
select a.vec_id, (select count(*) from links l where l.one = a.rid) as n_links, c.component_id,
       a.vec_id is not distinct from c.component_id as kept
from a join c on c.one = a.rid""",
    "op12_phrase_collocations": rf"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
g as (
  select lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) as phrase
  from w, (values (1), (2), (3)) as sizes(k)),
f as (select lang, k, phrase, count(*) as a, string_split(phrase, ' ') as ws from g group by lang, k, phrase),
n as (select lang, cast(sum(a) as bigint) as n from f where k = 1 group by lang),
c as (select * from f where k > 1 and a >= 10),
parts as (
  select lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as phrase from c where k = 3),
covered as (select lang, phrase, max(a) as longer from parts group by lang, phrase),
kept as (
  select c.* from c left join covered v on c.k = 2 and v.lang = c.lang and v.phrase = c.phrase
  where v.longer is null or 100 * v.longer < 50 * c.a),
cuts as (
  select lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') as head, array_to_string(ws[cut + 1:k], ' ') as rest
  from kept, (values (1), (2)) as places(cut) where cut < k),
s as (
  select c.lang, c.phrase, c.a, c.cut, x.a as l, y.a as r,
         cast((cast(1000000 as hugeint) * c.a * c.a) // (cast(x.a as hugeint) * y.a) as bigint) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.head join f y on y.lang = c.lang and y.phrase = c.rest),
lowest as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, n.n as n, score from ranked join n using (lang) where rank <= 2000""",
    "op13_source_divergence": rf"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
t as (select rid, lang, source, unnest(terms) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct rid) >= 30),
size as (select lang, count(*) as v from kept group by lang),
c as (select t.lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) as total from c group by all),
groups as (
  select g.lang, g.source, coalesce(total, 0) as total, coalesce(v, 0) as v
  from (select distinct lang, source from d) g
  left join totals o on o.lang = g.lang and o.source = g.source left join size s on s.lang = g.lang),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         cast(1 + (cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as bigint) as p
  from groups g join kept k on k.lang = g.lang
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
lang_totals as (select lang, sum(total) as total, max(v) as v from groups group by lang),
q as (
  select k.lang, k.term,
         cast(1 + (cast(1000000000 as hugeint) * (sum(p.n) + 5)) // (any_value(o.total) + 5 * any_value(o.v)) as bigint) as q
  from kept k join p on p.lang = k.lang and p.term = k.term join lang_totals o on o.lang = k.lang group by k.lang, k.term),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
terms as (
  select p.lang, p.source, p.term as item, p.p - q.q as value
  from p join q on q.lang = p.lang and q.term = p.term where p.n > 0 and p.p > q.q)
select lang, source, 'pair' as part, item, value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from pairs
union all
select lang, source, 'term', item, value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from terms
qualify row_number() over (partition by lang, source order by value desc, item) <= 50""",
}
