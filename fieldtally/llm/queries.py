"""Registered queries of the operators in this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import (
    chat, context_tree, credentials, decontaminate, hard_negatives, jaccard, learned_partitions, packing, repeats, stratified, token_store,
    topk, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.new_store(spark)
    token_store.write(table(spark, sf_dir, "documents"), path, vocabulary="byte_bpe_50k.json", end=2)
    return token_store.crc32_of(token_store.read(spark, path))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.judged(decontaminate.find(docs, benchmark, window=13, shingle=5), percent=5)


@query
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"), folds=10)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return credentials.digests(credentials.find(docs, credentials.learn(docs, per_kind=2_000, miss=0.01)))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), vocabulary="word_bpe_49k.json", end=1, capacity=4096)
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=4096)


@query
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole(table(spark, sf_dir, "embeddings"), scale=64)
    return topk.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


CHECKS["op6_exact_topk"] = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as w
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
    from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
    from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
    added = spark.sql(f"select * from {probe} as t(conv_id, turn, role, text)")
    return chat.read_back(chat.format_chats(rows.unionByName(added)))


CHECKS["op8_chat_format"] = """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (
    select *, row_number() over w as nth, lag(role) over w as before, row_number() over (
               partition by conv_id order by turn desc nulls last, role desc, text desc) as from_end,
           replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;') as body,
           case role when 'system' then 11 when 'user' then 13 when 'assistant' then 7
                else 14 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;'))
           end as marks
    from turns window w as (partition by conv_id order by turn nulls first, role, text)),
judged as (
    select *, case when nth = 1 then role in ('system', 'user') else
                  (before, role) in (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) end as good
    from marked)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by nth)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by nth) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(body) + marks)::bigint as formatted_chars,
       case when bool_and(good) then max(role) filter (from_end = 1) else 'error' end as state,
       bool_and(good) as valid,
       bool_and(good) and max(role) filter (from_end = 1) = 'assistant' as complete
from judged group by conv_id
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), sample=10_000, longest=50_000)
    return toxicity.judged(toxicity.score(docs, model), least=0.7)


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), n=5, threshold=0.8, recall=0.999)


CHECKS["op10_ngram_jaccard"] = """
with recursive docs as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents where text is not null),
grams as (
    select distinct doc_id, array_to_string(w[i:i + 4], ' ') as gram
    from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
pairs as (
    select a.doc_id as x, b.doc_id as y
    from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id
    having count(*) >= 0.8 * ((select n from sizes where doc_id = a.doc_id) + (select n from sizes where doc_id = b.doc_id) - count(*))),
reach(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, p.y from reach r join pairs p on r.other = p.x),
same as (
    select doc_id, md5(string_agg(gram, '|' order by gram)) as grams from grams group by doc_id)
select d.doc_id, (select min(other) from reach r where r.doc_id = d.doc_id) as class_id,
       coalesce((select min(b.doc_id) from same a join same b on a.grams = b.grams where a.doc_id = d.doc_id), d.doc_id) as representative,
       (select count(*) from pairs p where p.x = d.doc_id) as n_links
from documents d
"""


@query
def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.remove(table(spark, sf_dir, "documents"), length=50))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

CHECKS["op2_decontamination"] = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
items as (select coalesce(item_id::varchar, '') as item, {_WORDS} as w from benchmark),
windows as (
    select distinct item, least(13, len(w)) as n, array_to_string(w[i:i + 12], ' ') as t
    from (select item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from items where len(w) > 0)),
places as (
    select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as t
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from docs, (select distinct n from windows) where len(w) >= n)),
hits as (select doc_id, i, p.n, item from places p join windows using (n, t)),
counted as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(i, i + n)) as word from hits) group by doc_id),
found as (select doc_id, list_sort(list(distinct item)) as items from hits group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join counted using (doc_id) left join found using (doc_id)
"""

CHECKS["op7_suffix_repeats"] = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
starts as (select doc_id, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, n - 49)) as i from docs where n >= 50)),
least as (select s, min(doc_id) as first from starts group by s having count(distinct doc_id) > 1),
gone as (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from starts join least using (s) where first < doc_id),
runs as (select doc_id, i, sum((before is null or i > before + 50)::int) over (partition by doc_id order by i) as run from gone),
spans as (
    select doc_id, min(i) as a, max(i) + 50 as z, lag(max(i) + 50, 1, 0) over (partition by doc_id order by min(i)) as kept_from
    from runs group by doc_id, run),
cut as (
    select doc_id, sum(z - a)::bigint as n_removed, count(*) as n_spans, max(z) as last,
           string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' order by a) as kept
    from spans join docs using (doc_id) group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) as kept_sha256
from docs left join cut using (doc_id)
"""


@query
def op11_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = learned_partitions.usable(table(spark, sf_dir, "embeddings"))
    model, index = learned_partitions.learn(learned_partitions.candidates(vectors, k=20), k=20, target=0.95)
    return learned_partitions.search(model, index, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.whole(vectors, scale=256, label_column=label)
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 50 == 0), positives=5, negatives=3, low=50, high=95)


CHECKS["op12_hard_negatives"] = """
with whole as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as w
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.w, c.w)::bigint as score
    from whole a join whole c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score
    from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stratified.index(table(spark, sf_dir, "documents"))
    return stratified.rank(index, stratified.items(table(spark, sf_dir, "benchmark")), k=50)


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

CHECKS["op13_lexical_search"] = f"""
with docs as (select row_number() over () as doc, doc_id, {_TERMS} as w from documents),
items as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
totals as (select count(*)::bigint as n_docs, sum(len(w))::bigint as n_terms from docs where len(w) > 0),
tfs as (select doc, term, count(*)::bigint as tf from (select doc, unnest(w) as term from docs) where term in (select term from items) group by doc, term),
weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as weight
    from (select term, count(*) as df from tfs group by term), totals),
norms as (select doc, doc_id, 100 - 50 + (50 * len(w) * n_docs) // n_terms as m from docs, totals where len(w) > 0),
scored as (
    select item_id, doc, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
    from items join tfs using (term) join weights using (term) join norms using (doc) group by item_id, doc, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
from scored where score > 0
qualify rank <= 50
"""
