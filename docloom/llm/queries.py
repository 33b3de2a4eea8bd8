"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docloom.llm import (
    bpe,
    conversations,
    decontaminate,
    html_text,
    importance,
    line_crf,
    lsh_forest,
    mixing,
    nearest,
    quality_rules,
    suffix_dedup,
    warc,
    window_dedup,
)
from docloom.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.digests(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(table(spark, sf_dir, "conversations"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_suffix_dedup,
            op2_warc,
            op3_mixing,
            op4_nearest,
            op5_html_text,
            op6_quality_rules,
            op7_line_crf,
            op8_bpe,
            op9_lsh_forest,
            op10_window_dedup,
            op11_importance,
            op12_conversations,
            op13_decontaminate,
        )
    }


#: Payloads by digest; the smallest page of each is the response.
_OP2 = """
with p as (
  select page_id, coalesce(strlen(html), 0)::bigint as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest
  from pages),
q as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as leader
  from p)
select page_id, payload_bytes, payload_digest,
  case when leader is not null and leader is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when leader is distinct from page_id then leader end as refers_to
from q
"""

#: Windows as texts of 35 words, counted.
_OP10 = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select doc_id, unnest(range(1, len(w) - 33)) as i, w from d where len(w) >= 35),
g as (
  select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as h from s),
r as (
  select doc_id, i from g qualify count(*) over (partition by h) > 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 35)) as k from r),
words as (
  select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as k from d),
kept as (
  select words.doc_id, string_agg(x, ' ' order by words.k) as t, count(*) as n
  from words anti join gone on words.doc_id = gone.doc_id and words.k = gone.k group by 1)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""


#: Words of a text for op11 and op13.
_SMALL_WORDS = r"""
regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: crc32 is the exclusive or of one number for each byte, which depends on the byte and on
#: how many follow, and of one for the length; both come from the table of single bytes.
_CRC_TABLE = """
bits as (
  select b, b as v, 0 as step from range(256) t(b)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, step + 1 from bits where step < 8),
single as materialized (select b, v from bits where step = 8)"""

#: crc32 of the texts f in the table known, which also has their bytes x in hexadecimal and
#: their number n.
_CRC = """
longest as materialized (select coalesce(max(n), 0) as n from known),
byte_at as (
  select b, v, 0 as k from single
  union all
  select byte_at.b, xor(byte_at.v >> 8, single.v), k + 1
  from byte_at join single on single.b = byte_at.v & 255 where k < (select n from longest)),
start_at as (
  select 4294967295::bigint as v, 0 as k
  union all
  select xor(start_at.v >> 8, single.v), k + 1
  from start_at join single on single.b = start_at.v & 255 where k < (select n from longest)),
bytes as (
  select f, n, unnest(range(n)) as i, x from known),
sums as (
  select f, any_value(n) as n, bit_xor(byte_at.v) as v
  from bytes join byte_at on byte_at.k = bytes.n - 1 - i
    and byte_at.b = ('0x' || substr(x, (2 * i + 1)::int, 2))::int
  group by f),
crc as materialized (
  select f, xor(xor(sums.v, start_at.v), 4294967295) as crc from sums join start_at on start_at.k = sums.n)"""

_OP11 = f"""
with recursive {_CRC_TABLE},
words as materialized (
  select 0 as kind, doc_id as id, row_number() over () as row, WORDS as w from documents
  union all
  select 1, item_id, -row_number() over (), WORDS from benchmark),
feats as materialized (
  select kind, row, unnest(w) as f from words
  union all
  select kind, row, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words
  union all
  select kind, row, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  from words),
known as materialized (select f, hex(encode(f)) as x, strlen(f) as n from (select distinct f from feats)),
{_CRC},
placed as materialized (select kind, row, crc % 10000 as bucket from feats join crc using (f)),
totals as (
  select (count(*) filter (kind = 0))::double as own, (count(*) filter (kind = 1))::double as aim from placed),
gain as (
  select bucket, floor(1000::double * ln(
    (((count(*) filter (kind = 1)) + 1::double) * (any_value(totals.own) + 10000))
    / (((count(*) filter (kind = 0)) + 1::double) * (any_value(totals.aim) + 10000))))::bigint as gain
  from placed, totals group by bucket),
weighed as (
  select row, count(*) as n_features, sum(gain)::bigint as weight from placed join gain using (bucket)
  where kind = 0 group by row),
scored as (
  select id as doc_id, len(w) >= 20 as can, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000::double * ln(-ln(
      (('0x' || substr(sha256('42:' || id::varchar), 1, 8))::bigint::double + 0.5::double) / 4294967296::double)))::bigint as score
  from words left join weighed using (row) where kind = 0),
ranked as (
  select *, row_number() over (partition by can order by score desc, doc_id) as r, count(*) filter (can) over () as n
  from scored)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score,
  (case when can and r <= 5 * n // 100 then r end)::bigint as rank
from ranked
""".replace("WORDS", _SMALL_WORDS)

#: Both passes of the dynamic programming in step over all conversations: v holds the costs
#: of the best end from the states nothing, system, user and assistant said (1 to 4).
_OP12 = f"""
with recursive {_CRC_TABLE},
given as materialized (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as f
  from conversations),
known as materialized (select f, hex(encode(f)) as x, strlen(f) as n from (select distinct f from given)),
{_CRC},
damaged as (
  select conv_id, turn, case when crc % 20 = 4 then 'user' else role end as role,
    case crc % 20 when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case crc % 20 when 0 then 0 when 3 then 2 else 1 end)) as copy
  from given join crc using (f)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i
  from damaged),
faults as (
  select *, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
    row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as open_end, left(role, 1) as who
  from placed),
rows as materialized (
  select conv_id, turn, i, role, text, who, blank, again and not blank as duplicate,
    open_end and not blank and not again as truncated, blank or again as doomed,
    case when open_end then 5 else 0 end as pay,
    coalesce(lag(who) over (partition by conv_id order by i) || who not in ('su', 'ua', 'au'), false) as illegal
  from faults),
counts as materialized (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal
  from rows group by conv_id),
back as (
  select conv_id, n as i, [0, 10, 5, 0]::bigint[] as v from counts
  union all
  select conv_id, i, [least(g[1], 5 + u), least(g[2], 5 + u), u, least(g[4], 5 + u)]
  from (
    select conv_id, i, g, least(g[3], 5 + g[4]) as u
    from (
      select r.conv_id, b.i - 1 as i, [
        least(2 + v[1], case when not doomed then pay + 1 + v[3] end, case when not doomed and who = 'u' then pay + v[3] end,
          case when not doomed and who = 's' then pay + v[2] end),
        least(2 + v[2], case when not doomed then pay + 1 + v[3] end, case when not doomed and who = 'u' then pay + v[3] end),
        least(2 + v[3], case when not doomed then pay + 1 + v[4] end, case when not doomed and who = 'a' then pay + v[4] end),
        least(2 + v[4], case when not doomed then pay + 1 + v[3] end, case when not doomed and who = 'u' then pay + v[3] end)
      ] as g
      from back b join rows r on r.conv_id is not distinct from b.conv_id and r.i = b.i))),
costs as materialized (select * from back),
ahead as (
  select conv_id, 0::bigint as i, 1 as state, '' as audit, null::varchar as said from counts
  union all
  select conv_id,
    case when edit = 'I' then i else i + 1 end,
    case edit when 'D' then state when 'K' then (case who when 's' then 2 when 'u' then 3 else 4 end) else next end,
    audit || edit,
    case when edit = 'D' then said
      else coalesce(said || chr(10), '') || (case edit when 'K' then role else (case next when 3 then 'user' else 'assistant' end) end)
        || ':' || (case edit when 'I' then '' else text end) end
  from (
    select a.*, r.role, r.text, r.who, case when state = 3 then 4 else 3 end as next,
      case when h.v[state] = 2 + b.v[state] then 'D'
        when h.v[state] = 5 + h.v[case when state = 3 then 4 else 3 end] then 'I'
        when not doomed and ((who = 'u' and state <> 3 and h.v[state] = pay + b.v[3]) or (who = 'a' and state = 3 and h.v[state] = pay + b.v[4])
          or (who = 's' and state = 1 and h.v[state] = pay + b.v[2])) then 'K'
        else 'R' end as edit
    from ahead a join costs h on h.conv_id is not distinct from a.conv_id and h.i = a.i
    left join costs b on b.conv_id is not distinct from a.conv_id and b.i = a.i + 1
    left join rows r on r.conv_id is not distinct from a.conv_id and r.i = a.i + 1
    where b.i is not null or h.v[state] > 0)),
done as (
  select conv_id, arg_max(audit, len(audit)) as audit, arg_max(coalesce(said, ''), len(audit)) as said from ahead group by conv_id),
every as (select distinct conv_id from conversations)
select every.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(costs.v[1], 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(said, '')) as repaired_sha256
from every left join counts on counts.conv_id is not distinct from every.conv_id
left join costs on costs.conv_id is not distinct from every.conv_id and costs.i = 0
left join done on done.conv_id is not distinct from every.conv_id
"""

#: Windows as texts, joined by length.
_OP13 = """
with d as materialized (select doc_id, row_number() over () as row, WORDS as w from documents),
items as (select item_id::varchar as item, WORDS as w from benchmark),
patterns as materialized (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as t
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
lengths as (select distinct n from patterns),
places as (
  select row, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n),
found as materialized (
  select row, i, p.n, item
  from (select row, i, n, array_to_string(w[i:i + n - 1], ' ') as t from places) s join patterns p using (n, t)),
hit as (
  select row, count(distinct k) as n_hit from (select row, unnest(range(i, i + n)) as k from found) group by row),
named as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct row, item from found) group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row) left join named using (row)
""".replace("WORDS", _SMALL_WORDS)


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": _OP2,
        "op10_window_dedup": _OP10,
        "op11_importance": _OP11,
        "op12_conversations": _OP12,
        "op13_decontaminate": _OP13,
    }
