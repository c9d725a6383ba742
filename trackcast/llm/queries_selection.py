"""Registered queries of the operators that judge, draw and mine (11, 12, 13)."""

from __future__ import annotations

from trackcast.llm.collocations import mine_collocations
from trackcast.llm.common import table
from trackcast.llm.importance import importance_resample
from trackcast.llm.register import register
from trackcast.llm.url_filter import filter_urls

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@register("op11_url_filter", rf"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as host from u),
p as (
  select page_id, translate(host, {_LOWER}) as host, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') as path from h),
r as (
  select page_id, host, path, case
    when starts_with(path, '/en/') and ends_with('.' || host, '.www.example.com') then 'www.example.com/en/'
    when starts_with(path, '/en/') and ends_with('.' || host, '.example.com') then 'example.com/en/'
    when starts_with(path, '/es/') and ends_with('.' || host, '.net') then 'net/es/'
    when starts_with(path, '/fr/') and ends_with('.' || host, '.net') then 'net/fr/'
    when starts_with(path, '/') and ends_with('.' || host, '.com') then 'com/' end as rule from p)
select page_id, host, path, rule, case
  when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
  when regexp_matches(host, 'casino|poker|free-bet|viagra|porn|xxx\.') then 'block' else 'allow' end as verdict from r""")
def op11_url_filter(spark, sf_dir):
    """Verdict on every url of pages by the default rules and globs."""
    return filter_urls(table(spark, sf_dir, "pages"))


@register("op12_importance_resampling", rf"""
with recursive bits(i, v, k) as (
  select i, i::bigint, 0 from range(256) t(i)
  union all select i, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8),
crc as (select list(v order by i) as steps from bits where k = 8),
w as (
  select 'd' as side, doc_id as id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LOWER}),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents
  union all
  select 't', item_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LOWER}),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') from benchmark),
f as (
  select side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from w),
b as (
  select f, list_transform(string_split(regexp_replace(hex(encode(f)), '(..)', '\1 ', 'g'), ' ')[:-2],
    lambda x: ('0x' || x)::bigint) as bytes from (select distinct f from f)),
name as (
  select f, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, steps[xor(c, x) % 256 + 1]), 4294967295::bigint),
    4294967295) % 10000 as bucket from b, crc),
sums as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 't') as t from f join name using (f) group by bucket),
total as (select sum(s) as s, sum(t) as t from sums),
gain as (
  select bucket, floor(1000 * ln(((sums.t + 1)::double * (total.s + 10000)::double)
    / ((sums.s + 1)::double * (total.t + 10000)::double)))::bigint as gain from sums, total),
mean as (
  select id, floor(sum(gain)::double / count(*))::bigint as weight from f join name using (f) join gain using (bucket)
  where side = 'd' group by id),
scored as (
  select w.id as doc_id, len(ws) as n_words, greatest(2 * len(ws) - 1, 0)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint
      as score from w left join mean on mean.id = w.id where side = 'd'),
place as (
  select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id) end as place,
    count(*) filter (where n_words >= 20) over () as able from scored)
select doc_id, n_features, weight, score, case when place <= 25 * able // 100 then place end as rank from place""")
def op12_importance_resampling(spark, sf_dir):
    """A quarter of all documents of 20 words or more, drawn towards the distribution of benchmark."""
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_collocations", rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from w, range(1, 5) t(k) where len(ws) >= k),
f as (select lang, k as size, phrase, count(*) as f from grams group by all having count(*) >= 30),
total as (select lang, count(*) as n from grams where k = 1 group by lang),
cut as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as ws, unnest(range(1, size)) as k from f where size > 1),
cuts as (
  select cut.lang, cut.size, cut.phrase, a, k, x.f as l, y.f as r, (2000000::hugeint * a) // (x.f + y.f) as score
  from cut join f x on x.lang = cut.lang and x.phrase = array_to_string(ws[1:k], ' ')
    join f y on y.lang = cut.lang and y.phrase = array_to_string(ws[k + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_part as (
  select lang, a, unnest(list_concat([array_to_string(ws[1:size - 1], ' '), array_to_string(ws[2:], ' ')],
    case when size = 4 then [array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' '), array_to_string(ws[3:4], ' ')] else [] end))
    as phrase from (select distinct lang, size, phrase, a, ws from cut) where size > 2),
most as (select lang, phrase, max(a) as most from inner_part group by all),
kept as (
  select best.* from best left join most using (lang, phrase) where most is null or 100 * most < 80 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join total using (lang) where rank <= 2000""")
def op13_collocations(spark, sf_dir):
    """The first 2,000 collocations of every language of documents."""
    return mine_collocations(table(spark, sf_dir, "documents"))
