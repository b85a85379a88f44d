"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex.llm import (
    ann,
    html_text,
    infill,
    language,
    lm,
    mixing,
    near_vectors,
    packing,
    phrases,
    quality,
    simhash,
    substring,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = substring.dedup_units(table(spark, sf, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return cut.select("doc_id", "kept_text", spans.alias("removed"))


@query
def op2_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@query
def op3_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    sizes = mixing.document_sizes(table(spark, sf, "documents"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(table(spark, sf, "documents"))


@query
def op6_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf, "embeddings"))


@query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op8_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


@query
def op9_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(mixing.document_sizes(table(spark, sf, "documents")).select("doc_id", "size"))


@query
def op11_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


@query
def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return infill.fill_in_middle(table(spark, sf, "documents"))


@query
def op13_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


ORACLE = {
    "op1_substring_dedup": r"""
with sentences as (
  select doc_id, text, unnest(regexp_extract_all(text, '[^\n]*?[.!?][\x20\x09\x0B-\x0D]+|[^\n]*\n|[^\n]+')) as piece,
         generate_subscripts(regexp_extract_all(text, '[^\n]*?[.!?][\x20\x09\x0B-\x0D]+|[^\n]*\n|[^\n]+'), 1) as s
  from documents where text <> ''),
tokens as (
  select doc_id, text, s, case when len(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')) > 25
    then regexp_extract_all(piece, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') else [piece] end as toks
  from sentences),
parted as (select doc_id, text, s, unnest(toks) as tok, generate_subscripts(toks, 1) as t from tokens),
lowered as (
  select *, translate(tok, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from parted),
subs as (
  select *, coalesce(sum((md5(regexp_extract(low, '[^\x20\x09-\x0D]+'))[1] in ('0', '8'))::int) over (
    partition by doc_id, s order by t rows between unbounded preceding and 1 preceding), 0) as sub
  from lowered),
units as (
  select doc_id, text, s, sub, string_agg(tok, '' order by t) as piece, string_agg(low, '' order by t) as low
  from subs group by all),
numbered as (
  select *, row_number() over w as k, (sum(length(piece)) over w - length(piece))::bigint as starts,
         regexp_extract_all(low, '[^\x20\x09-\x0D]+') as words
  from units window w as (partition by doc_id order by s, sub)),
marked as (
  select *, len(words) = 0 or row_number() over (partition by array_to_string(words, ' ') order by doc_id, k) > 1 as again,
         coalesce(sum(ends_with(piece, chr(10))::int) over (
           partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) as line
  from numbered),
runs as (select *, sum((not again)::int) over (partition by doc_id order by k) as run from marked),
cut as (
  select *, again and (sum(case when again then len(words) else 0 end) over (partition by doc_id, run) >= 10
                       or bool_and(again) over (partition by doc_id, line) and sum(len(words)) over (partition by doc_id, line) > 0) as gone
  from runs),
islands as (select *, k - row_number() over (partition by doc_id order by k) as island from cut where gone),
spans as (
  select doc_id, any_value(text) as text, min(starts) as a, max(starts + length(piece)) as b, max(k) as k
  from islands group by doc_id, island),
trimmed as (
  select doc_id, k, a, b, a > 0 and substr(text, a, 1) <> chr(10) and substr(text, b, 1) = chr(10) as trim from spans),
kept as (
  select c.doc_id, string_agg(case when not gone then piece when trim then chr(10) else '' end, '' order by c.k) as kept_text
  from cut c left join trimmed t on t.doc_id = c.doc_id and t.k = c.k group by c.doc_id),
removed as (
  select doc_id, string_agg(concat(a, '-', b - trim::int), ',' order by a) as removed
  from trimmed where a < b - trim::int group by doc_id)
select d.doc_id, case when d.text is null or d.text = '' then d.text else coalesce(k.kept_text, '') end as kept_text,
       coalesce(r.removed, '') as removed
from documents d left join kept k using (doc_id) left join removed r using (doc_id)
""",
    "op3_mix_sources": r"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(concat_ws(':', 'mix', doc_id::varchar)) as key
  from documents),
totals as (select source, sum(size)::bigint as source_size from sizes group by source),
weighted as (
  select source, source_size, 3 * source_size as cap,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3)::int + 1]::bigint as weight
  from totals),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over before, 0))::bigint as remaining,
         (sum(weight) over () - coalesce(sum(weight) over before, 0))::bigint as share
  from weighted
  window before as (order by cap::double / weight::double, source nulls last rows between unbounded preceding and 1 preceding)),
level as (
  select max(remaining::double / share::double) as level from levels
  where remaining::double / share::double <= cap::double / weight::double),
targets as (
  select source, source_size, least(cap::double, coalesce(level, 0) * weight::double) as target from levels, level),
plans as (
  select *, floor(target)::bigint as budget,
         case when source_size > 0 then floor(target)::bigint // source_size else 0 end as epochs from targets),
placed as (
  select s.doc_id, s.size, p.source_size, p.target, p.epochs, p.budget - p.epochs * p.source_size as rest,
         coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size
                                    rows between unbounded preceding and 1 preceding), 0) as used
  from sizes s join plans p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - used)))::bigint as taken
from placed
""",
    "op11_phrase_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
counts as (
  select lang, k, phrase, count(*)::bigint as n from (
    select lang, 1 as k, unnest(w) as phrase from cut
    union all
    select lang, 2, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from cut
    union all
    select lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) from cut)
  group by all),
totals as (select lang, sum(n)::bigint as n from counts where k = 1 group by lang),
cands as (select lang, k, phrase, n as a, string_split(phrase, ' ') as w from counts where k > 1 and n >= 10),
cuts as (
  select c.lang, c.phrase, c.a, i.k as cut, l.n as l, r.n as r,
         ((1000000::hugeint * c.a * c.a) // (l.n::hugeint * r.n))::bigint as score
  from cands c join (values (1), (2)) i(k) on i.k < c.k
  join counts l on l.lang = c.lang and l.k = i.k and l.phrase = array_to_string(c.w[1:i.k], ' ')
  join counts r on r.lang = c.lang and r.k = c.k - i.k and r.phrase = array_to_string(c.w[i.k + 1:], ' ')),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (
  select lang, phrase, max(a) as longest from (
    select lang, array_to_string(w[1:2], ' ') as phrase, a from cands where k = 3
    union all select lang, array_to_string(w[2:3], ' '), a from cands where k = 3)
  group by all),
ranked as (
  select s.*, row_number() over (partition by s.lang order by score desc, s.a desc, s.phrase) as rank
  from lowest s left join longer g on g.lang = s.lang and g.phrase = s.phrase
  where not coalesce(100 * longest >= 50 * s.a, false))
select lang, rank, phrase, a, l, r, t.n, score from ranked join totals t using (lang) where rank <= 2000
""",
    "op12_fill_in_middle": r"""
with cut as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents),
drawn as (
  select *, len(u)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
         ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from cut),
parts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
         case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
made as (
  select *, array_to_string(u[1:lo], '') as p, array_to_string(u[lo + 1:hi], '') as m, array_to_string(u[hi + 1:], '') as s
  from parts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then concat('<P>', p, '<S>', s, '<M>', m)
              else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
       sha256(text) as restored_sha256
from made
""",
}
