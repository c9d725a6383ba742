"""Registered queries of the dedup operators (1, 2, 5, 10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackcast.llm.common import table
from trackcast.llm.exact_dedup import exact_dedup
from trackcast.llm.line_dedup import line_dedup
from trackcast.llm.near_dedup import near_duplicates
from trackcast.llm.register import register
from trackcast.llm.substring_dedup import substring_dedup
from trackcast.llm.suffix_dedup import suffix_dedup


@register("op1_exact_dedup", """
with d as (select doc_id, coalesce(text, '') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t""")
def op1_exact_dedup(spark, sf_dir):
    """Exact dedup of every row of documents."""
    return exact_dedup(table(spark, sf_dir, "documents"))


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    """Repeated strings of 200 bytes removed from every row of documents."""
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_substring_dedup", r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
win as (
  select doc_id, i, array_to_string(ws[i:i + 49], ' ') as s
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
first as (select s, min(doc_id) as first_id from win group by s),
gone as (
  select distinct doc_id, i + k as p
  from (select win.doc_id, win.i, unnest(range(0, 50)) as k from win join first using (s) where first_id < win.doc_id)),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w),
kept as (
  select words.doc_id, count(gone.p) as n_removed,
    coalesce(string_agg(word, ' ' order by words.p) filter (where gone.p is null), '') as text
  from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p group by words.doc_id)
select w.doc_id, len(ws) as n_words, coalesce(kept.n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept on w.doc_id = kept.doc_id""")
def op2_substring_dedup(spark, sf_dir):
    """Windows of 50 words that a smaller document has, removed from every row of documents."""
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_minhash_near_dedup", r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
sh as (
  select distinct doc_id, s from (
    select doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as s from w where len(ws) > 1
    union all select doc_id, ws[1] from w where len(ws) = 1)),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
link as (
  select x, y from common c join size p on p.doc_id = x join size q on q.doc_id = y where 100 * c.n >= 80 * (p.n + q.n - c.n)),
both_ways as (select x, y from link union all select y, x from link),
reach(a, b) as (
  select doc_id, doc_id from documents union select r.a, l.y from reach r join both_ways l on l.x = r.b)
select d.doc_id, coalesce(size.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join size on size.doc_id = d.doc_id
join (select a, min(b) as component_id from reach group by a) c on c.a = d.doc_id""")
def op5_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate classes of all documents on 2-word shingles at similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@register("op4_line_dedup")
def op4_line_dedup(spark, sf_dir):
    """Repeated runs of two lines or more removed from every row of documents."""
    return line_dedup(table(spark, sf_dir, "documents"), extend=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
