"""DuckDB statements that compute the registered queries another way.

Documents are taken apart line by line instead of by one pattern, subtrees and
ancestors by self-joins instead of running windows, the packing and the splitting
by recursion.
"""

from __future__ import annotations

# Fixed values, written out so that a wrong one in the library shows.
FILTER_KEYWORDS = [
    "content",
    "contents",
    "table of contents",
    "index",
    "summary",
    "preface",
    "foreword",
    "acknowledgement",
    "acknowledgment",
    "acknowledgements",
    "acknowledgments",
    "references",
    "reference",
    "bibliography",
    "",
    "about",
    "about this",
    "revision history",
    "change log",
    "version history",
    "glossary",
    "abbreviations",
    "disclaimer",
    "nomenclature",
    "notation",
    "list of figures",
    "list of tables",
    "list of symbols",
    "figure",
]
TECHNICAL_KEYWORDS = [
    "analysis",
    "calculation",
    "model",
    "method",
    "theory",
    "equation",
    "performance",
    "flow",
    "physics",
    "aerodynamic",
    "dynamics",
    "component",
    "system",
    "design",
    "optimization",
    "simulation",
]
WHITESPACE = '\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000'
CHUNKING = {"chunk_size": 600, "overlap": 50}
TIGHT_CHUNK_SIZE, TIGHT_BACKGROUND = 210, 180
SEGMENT_TOKENS = 200

WS = "(" + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
WS_CLASS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS_CLASS}]"
NL = "chr(10)"
ID = "printf('chunk_%06d', {})"


def tokens(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{TOKEN}'))"


MD_DOCS = f"""
  md_docs as (
    select 'file_' || (conv_id // 10) || '.json' as source_file,
      string_agg(
        repeat('#', case role when 'system' then 1 when 'user' then 2 else 3 end) || ' ' ||
        case when (conv_id * 3 + turn) % 7 = 0 then 'References'
             when (conv_id + turn) % 11 = 0 then 'Flow index'
             when turn % 5 = 4 then 'Overview'
             when (conv_id + 2 * turn) % 4 = 0 and trim(split_part(text, '.', 1)) <> ''
               then replace(split_part(text, '.', 1), {NL}, ' ')
             else 'Topic ' || conv_id || ' ' || turn end || {NL} ||
        text || case when (conv_id + turn) % 9 = 0 then {NL} || {NL} || '#### Aside' || {NL} || 'short' else '' end,
        {NL} || {NL} order by conv_id, turn) as md
    from conversations group by 1)"""

HEADINGS = f"""{MD_DOCS},
  numbered_lines as (
    select source_file, unnest(string_split(md, {NL})) as line,
      unnest(range(len(string_split(md, {NL})))) as line_no
    from md_docs),
  marked_lines as (
    select *, regexp_matches(line, '^#{{1,6}}\\s+.*\\S') as is_head from numbered_lines),
  headed_lines as (
    select *, sum(is_head::int) over (partition by source_file order by line_no) - 1 as pos
    from marked_lines),
  headings as (
    select source_file, pos::int as pos,
      length(regexp_extract(max(line) filter (is_head), '^#+'))::int as level,
      trim(regexp_replace(max(line) filter (is_head), '^#+', ''), {WS}) as title,
      trim(coalesce(string_agg(line, {NL} order by line_no) filter (not is_head), ''), {WS}) as body
    from headed_lines where pos >= 0 group by source_file, pos)"""


def normalized(c: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace(lower({c}),
      '[^\p{{L}}\p{{N}}_{WS_CLASS}]', ' ', 'g'), '[{WS_CLASS}]+', ' ', 'g'))"""


NORMALIZED = rf"""{HEADINGS},
  normalized as (
    select *, {normalized("title")} as heading
    from headings),
  technical as (
    select *, {" or ".join(f"contains(heading, '{k}')" for k in TECHNICAL_KEYWORDS)} as is_technical
    from normalized)"""

# Windows of the longer text as long as the shorter one, also hanging off its ends;
# equally long texts take both parts. The longest common subsequence is a fold of
# bit sets over the window's characters.
BUILT_IN = f"select unnest([{', '.join(f"'{k}'" for k in FILTER_KEYWORDS if k)}]) as keyword"
FLAGGED = f"""{NORMALIZED},
  keywords as ({BUILT_IN}),
  pairs as (
    select distinct heading, is_technical, keyword from technical, keywords where heading <> ''),
  sides as (
    select heading, keyword,
      case when len(heading) <= len(keyword) then heading else keyword end as s,
      case when len(heading) <= len(keyword) then keyword else heading end as t
    from pairs
    union all
    select heading, keyword, keyword, heading from pairs where len(heading) = len(keyword)),
  partial_windows as (
    select heading, keyword, s, substring(t, greatest(o, 0) + 1, least(o + len(s), len(t)) - greatest(o, 0)) as w
    from (select *, unnest(range(1 - len(s), len(t))) as o from sides)),
  compared as (
    select heading, keyword, s, w from partial_windows
    union
    select heading, keyword, keyword, heading from pairs),
  folded as (
    select heading, keyword, s, w,
      list_reduce(
        list_transform(string_split(w, ''), lambda c: list_sum(list_transform(range(len(s)),
          lambda i: case when s[i + 1] = c then 1::bigint << i else 0 end))::bigint),
        lambda v, m: (((v + (v & m)) | (v - (v & m))) & ((1::bigint << len(s)) - 1)),
        (1::bigint << len(s)) - 1) as rest
    from compared),
  best as (
    select heading, keyword, max(200.0 * (len(s) - bit_count(rest)) / (len(s) + len(w))) as score
    from folded group by heading, keyword),
  verdicts as (
    select heading, bool_or(score >= case when not is_technical then 85
      when list_has_all(string_split(heading, ' '), string_split(keyword, ' ')) then 90 else 97 end) as hit
    from pairs join best using (heading, keyword) group by heading),
  flagged as (
    select n.*, n.heading = '' or v.hit as is_toc
    from technical n left join verdicts v using (heading))"""

SKIPPED = f"""{FLAGGED},
  skipped as (
    select f.*, exists (
      select 1 from flagged j
      where j.source_file = f.source_file and j.pos <= f.pos and j.is_toc
        and not exists (
          select 1 from flagged k
          where k.source_file = f.source_file and k.pos > j.pos and k.pos <= f.pos
            and k.level <= j.level)) as skipped
    from flagged f)"""

SECTIONS = f"""{SKIPPED},
  sections as (
    select source_file, pos, level, title, body as content
    from skipped where not skipped and len(body) > 20)"""

ENTRIES = rf"""{SECTIONS},
  ancestors as (
    select s.source_file, s.pos, a.pos as up_pos, a.title as up_title
    from sections s join sections a
      on a.source_file = s.source_file and a.pos < s.pos and a.level < s.level
    where not exists (
      select 1 from sections k
      where k.source_file = s.source_file and k.pos > a.pos and k.pos < s.pos and k.level <= a.level)),
  entries as (
    select s.*, (row_number() over (partition by s.source_file order by s.pos) - 1)::int as entry_pos,
      coalesce(h.titles, []) as hierarchy,
      array_to_string(list_append(coalesce(h.titles, []), s.title), ' > ') as full_path,
      len(regexp_extract_all(content, '[^{WS_CLASS}]+'))::int as word_count
    from sections s left join (
      select source_file, pos, list(up_title order by up_pos) as titles
      from ancestors group by all) h using (source_file, pos))"""


def budgeted(chunk_size: int, max_background: int) -> str:
    """Entries with background, the background cut to leave room, and the budget."""
    room = chunk_size - 100
    inner = "substring(background, 14, len(background) - 27)"
    label = "'[BACKGROUND]' || chr(10) || {} || chr(10) || '[/BACKGROUND]'"
    again = label.format(f"'[TRUNCATED] ' || right(substring({inner}, 13), {room - 30})")
    whole = label.format(f"'[TRUNCATED] ' || right({inner}, {room - 28})")
    return f"""{ENTRIES},
  looked_up as (
    select e.source_file, e.entry_pos, string_agg(f.content, {NL} || {NL} order by u.depth) as raw
    from (select source_file, entry_pos, unnest(hierarchy) as title, unnest(range(len(hierarchy))) as depth
          from entries) u
    join entries e using (source_file, entry_pos)
    join (select source_file, title, arg_min(trim(content, {WS}), entry_pos) as content
          from entries group by all) f
      on f.source_file = u.source_file and f.title = u.title
    group by all),
  with_background as (
    select e.*, case when coalesce(raw, '') = '' then '' else {label.format(
        f"case when len(raw) > {max_background} then '[TRUNCATED] ' || right(raw, {max_background - 12}) else raw end"
    )} end as background
    from entries e left join looked_up using (source_file, entry_pos)),
  budgeted as (
    select * exclude (background, shrunk), shrunk as background,
      greatest({chunk_size} - len(shrunk), 100)::int as budget
    from (select *, case when background = '' or {chunk_size} - len(background) >= 100 then background
            when contains({inner}, '[TRUNCATED] ') then {again} else {whole} end as shrunk
          from with_background))"""


def pieces(keys: str, source: str, text: str, budget: str, overlap: int) -> str:
    """Recursive cutting of ``text``; result table ``pieces`` (keys, idx, piece)."""

    def last(reach: int, test: str) -> str:
        return (
            f"list_max(list_filter(range(greatest(start, lim - {reach}) + 1, lim), lambda i: {test}))"
        )

    here = "around[i - base + 1]"
    after = "around[i - base + 2]"
    sentence = last(200, f"{here} in ('.', '!', '?') and contains({WS}, {after})")
    paragraph = last(200, f"{here} = {NL} and {after} = {NL}")
    newline = last(100, f"{here} = {NL}")
    word = last(50, f"contains({WS}, {here})")
    return f"""
  long_texts as (
    select {keys}, {text} as body, len({text}) as size, ({budget})::bigint as budget
    from {source} where len({text}) > {budget}),
  cuts as (
    select {keys}, 0::bigint as step, -1::bigint as start, 0::bigint as stop, 0::bigint as next_start
    from long_texts
    union all
    select {keys}, step + 1, start, stop, greatest(start + 1, stop - {overlap})
    from (
      select {keys}, step, start, size,
        case when lim >= size then lim
             when sentence is not null and sentence + 1 <> lim then sentence + 1
             when paragraph is not null and paragraph + 2 <> lim then paragraph + 2
             when newline is not null and newline + 1 <> lim then newline + 1
             when word is not null and word + 1 <> lim then word + 1
             else lim end as stop
      from (
        select *, {sentence} as sentence, {paragraph} as paragraph, {newline} as newline, {word} as word
        from (
          select *, string_split(substring(body, base + 1, lim + 1 - base), '') as around
          from (
            select {keys}, c.step, c.next_start as start, c.next_start + l.budget as lim,
              greatest(c.next_start + l.budget - 200, 0) as base, l.body, l.size
            from cuts c join long_texts l using ({keys})
            where c.stop < l.size)))) ),
  pieces as (
    select {keys}, (row_number() over (partition by {keys} order by step) - 1)::int as idx, piece
    from (select {keys}, step, trim(substring(body, start + 1, stop - start), {WS}) as piece
          from cuts join long_texts using ({keys}) where step > 0)
    where piece <> ''
    union all
    select {keys}, 0, {text} from {source} where len({text}) <= {budget})"""


def chunked() -> str:
    size, overlap = CHUNKING["chunk_size"], CHUNKING["overlap"]
    return rf"""{budgeted(size, int(size * 0.4))},
  {pieces("source_file, entry_pos", "budgeted", "content", "budget", overlap)},
  chunks as (
    select source_file, entry_pos, idx as chunk_index, full_path, title, p.piece,
      case when background <> '' then background || {NL} || {NL} || p.piece else p.piece end as full_text,
      len(background)::int as background_size,
      row_number() over (order by source_file, entry_pos, idx) as chunk_number
    from budgeted join pieces p using (source_file, entry_pos))"""


STATS = f"""
  stats as (
    select e.source_file, 'chunks_' || regexp_replace(e.source_file, '\\.json$', '') || '.json' as output_file,
      original_entries, total_chunks, original_total_chars::bigint as original_total_chars,
      chunked_total_chars::bigint as chunked_total_chars
    from (select source_file, count(*) as original_entries, sum(len(content)) as original_total_chars
          from entries group by all) e
    join (select source_file, count(*) as total_chunks, sum(len(full_text)) as chunked_total_chars
          from chunks group by all) c using (source_file))"""

DOC_TEXTS = "docs as (select 'doc_' || doc_id || '.txt' as source_file, text from documents)"
DOC_PARAGRAPHS = f"""docs as (
    select 'doc_' || doc_id || '.txt' as source_file, replace(text, {NL}, {NL} || {NL}) as text
    from documents)"""


def quarter(c: str) -> str:
    return f"len({c}) // 4"


def segments(docs: str, count=tokens, longer: str = "used + unit + count") -> str:
    """Greedy packing, one part (a paragraph, or a sentence of one) per round.

    ``count`` counts a text, ``longer`` is the count of the open segment with the part.

    ``unit`` says whether the part at the front is a paragraph (0) or a sentence (1).
    An oversized first paragraph is put back as sentences.
    """
    part = "queue[1]"
    return f"""{docs},
  packing as (
    select source_file, string_split(text, {NL} || {NL}) as queue, []::varchar[] as later,
      ''::varchar as cur, 0::bigint as used, 0::int as unit, null::varchar as emitted, 0::bigint as step
    from docs
    union all
    select source_file,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then string_split(part, '. ')
           when unit = 1 and len(queue) = 1 then later
           else queue[2:] end,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then queue[2:]
           when unit = 1 and len(queue) > 1 then later
           else []::varchar[] end,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then ''
           when unit = 1 and cur = '' and count > {SEGMENT_TOKENS} then ''
           when cur = '' then part
           when longer <= {SEGMENT_TOKENS} then cur || sep || part
           else part end,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then 0
           when unit = 1 and cur = '' and count > {SEGMENT_TOKENS} then 0
           when cur = '' then count
           when longer <= {SEGMENT_TOKENS} then longer
           else count end,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then 1
           when unit = 1 and len(queue) = 1 then 0
           else unit end,
      case when unit = 0 and cur = '' and count > {SEGMENT_TOKENS} then null
           when unit = 1 and cur = '' and count > {SEGMENT_TOKENS} then trim(part, {WS})
           when cur = '' then null
           when longer <= {SEGMENT_TOKENS} then null
           else trim(cur, {WS}) end,
      step + 1
    from (
      select *, {part} as part, {count(part)} as count,
        case unit when 0 then {NL} || {NL} else '. ' end as sep, {longer} as longer
      from packing where len(queue) > 0)),
  segments as (
    select source_file, (row_number() over (partition by source_file order by step, closing) - 1)::int as seg_idx, text
    from (
      select source_file, step, 0 as closing, emitted as text from packing where emitted is not null
      union all
      select source_file, step, 1, trim(cur, {WS}) from packing where len(queue) = 0 and cur <> ''))"""


INCOMING = f"""incoming as (
    select {ID.format("doc_id")} as chunk_id, text as document, source, lang from documents)"""
STORED = f"""stored as (
    select {ID.format("doc_id")} as chunk_id, 'old ' || text as document
    from documents where doc_id in (select doc_id from labels))"""


def centroids(by: str, stored: str = "true") -> str:
    return f"""
  cells as (
    select {by} as query_id, unnest(embedding)::double as x, unnest(range(len(embedding))) as i
    from embeddings),
  queries as (
    select query_id, list(x order by i) as q
    from (select query_id, i, avg(x) as x from cells group by all) group by query_id),
  ranked as (
    select query_id, {ID.format("vec_id")} as chunk_id, vec_id,
      list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - embedding[i]) * (q[i] - embedding[i]))) as distance
    from queries, embeddings where {stored}),
  hits as (
    select *, row_number() over (partition by query_id order by distance, chunk_id)::int as rank from ranked)"""


TOY = "list_value({})".format(
    ", ".join(
        f"1000.0::double * (len(text) - len(replace(text, '{c}', ''))) / greatest(1, len(text))"
        for c in "aeinorst"
    )
)


def oracle_sql() -> dict[str, str]:
    size, overlap = CHUNKING["chunk_size"], CHUNKING["overlap"]
    loaded = """
  files as (
    select 'chunks_conv_' || conv_id || '.json' as source_file, conv_id from conversations group by conv_id)"""
    entry_rows = f"""
with {ENTRIES} select source_file, entry_pos, content, title, full_path, level,
  len(content)::int as content_length, word_count from entries"""
    chunk_id = r"""printf('chunk_%06d_%s_%s_%d', chunk_number, regexp_replace(source_file, '\.json$', ''),
    left(replace(trim(regexp_replace(title, '[^\p{L}\p{N} _-]', '', 'g')), ' ', '_'), 30), chunk_index)"""
    return {
        "token_counts": f"""
with {DOC_TEXTS} select source_file, len(text)::int as n_chars, {tokens("text")}::bigint as n_tokens from docs""",
        "token_rollup": f"""
select source as source_file, sum(len(text))::bigint as n_chars, sum({tokens("text")})::bigint as n_tokens,
  grouping(source) = 1 as is_total from documents group by rollup (source)""",
        "page_concat": """
with p as (select 'doc_' || conv_id || '.txt' as source_file, turn,
    case when turn % 4 = 3 or conv_id % 25 = 7 then '' else text end as text from conversations)
select source_file, text, len(text)::int as n_chars from (
  select source_file, coalesce(string_agg(text, ' ' order by turn) filter (text <> ''), '') as text
  from p group by source_file)""",
        "token_segments": f"with recursive {segments(DOC_PARAGRAPHS)} select source_file, seg_idx, text from segments",
        "token_segments_sentences": f"with recursive {segments(DOC_TEXTS)} select source_file, seg_idx, text from segments",
        "token_segments_quarter": f"""
with recursive {segments(DOC_PARAGRAPHS, quarter, "len(cur || sep || part) // 4")}
select source_file, seg_idx, text from segments""",
        "convert_remembered": f"""
with recursive {segments(DOC_PARAGRAPHS)}
select regexp_replace(source_file, '\\.txt$', '.md') as source_file,
  coalesce(string_agg('> ' || s.text, {NL} || {NL} || '---' || {NL} || {NL} order by seg_idx), '') as md
from docs left join segments s using (source_file) group by source_file""",
        "md_reassemble": f"""
with recursive {segments(DOC_PARAGRAPHS)}
select regexp_replace(source_file, '\\.txt$', '.md') as source_file,
  coalesce(string_agg(s.text, {NL} || {NL} || '---' || {NL} || {NL} order by seg_idx), '') as md
from docs left join segments s using (source_file) group by source_file""",
        "success_rate": f"""
with recursive {segments(DOC_PARAGRAPHS)},
failed as (select distinct source_file from segments where contains(text, '@')),
unread as (select distinct conv_id from conversations where conv_id % 10 in (3, 6))
select (select count(*) from docs) as successful,
  (select count(*) from docs anti join failed using (source_file)) as fully_converted,
  (select count(*) from docs) + (select count(*) from unread) as files""",
        "headings": f"with {HEADINGS} select source_file, pos, level, title, body from headings",
        "heading_normalize": f"with {NORMALIZED} select source_file, pos, heading as normalized from normalized",
        "heading_technical": f"with {NORMALIZED} select source_file, pos, is_technical from technical",
        "toc_flag": f"with {FLAGGED} select source_file, pos, title, is_toc from flagged",
        "fuzzy_keywords": "with "
        + FLAGGED.replace(
            BUILT_IN,
            f"select distinct {normalized("regexp_extract(text, '[^ \\n]+[ \\n][^ \\n]+')")} as keyword from benchmark",
        )
        + " select source_file, pos, title, is_toc from flagged",
        "skip_subtree": f"with {SKIPPED} select source_file, pos, level, skipped from skipped",
        "sections": f"with {SECTIONS} select source_file, pos, level, title, content from sections",
        "hierarchy": f"""
with {ENTRIES} select source_file, entry_pos, pos, array_to_string(hierarchy, ' | ') as hierarchy from entries""",
        "entries": entry_rows,
        "entry_summary": f"""
with {ENTRIES} select source_file, count(*) as entries, sum(word_count)::bigint as total_words,
  sum(len(content))::bigint as total_chars, round(avg(word_count), 6) as words_per_entry
from entries group by source_file""",
        "background": f"""
with {budgeted(size, int(size * 0.4))} select source_file, entry_pos, background from with_background""",
        "chunk_budget": f"""
with {budgeted(TIGHT_CHUNK_SIZE, TIGHT_BACKGROUND)} select source_file, entry_pos, background, budget from budgeted""",
        "chunk_split": f"""
with recursive {DOC_TEXTS}, {pieces("source_file", "docs", "text", "5000", 200)}
select source_file, idx as piece_idx, piece from pieces""",
        "chunks": f"""
with recursive {chunked()} select source_file, entry_pos, chunk_index, full_text as content, full_path,
  len(full_text)::int as chunk_size, background_size, len(piece)::int as content_size from chunks""",
        "chunk_ids": rf"""
with recursive {chunked()}
select source_file, entry_pos, chunk_index, chunk_number,
  {chunk_id} as chunk_id,
  sha256(concat_ws(chr(31), source_file, full_path, entry_pos, chunk_index, full_text)) as stable_id
from chunks""",
        "chunk_stats": f"""
with recursive {chunked()}, {STATS}
select *, round(chunked_total_chars / total_chunks, 6) as average_chunk_size,
  {size}::int as target_chunk_size, {overlap}::int as overlap_size from stats""",
        "chunk_stats_total": f"""
with recursive {chunked()}, {STATS}
select count(*) as files, sum(original_entries)::bigint as original_entries,
  sum(total_chunks)::bigint as total_chunks, sum(original_total_chars)::bigint as original_total_chars,
  sum(chunked_total_chars)::bigint as chunked_total_chars,
  round(sum(chunked_total_chars) / sum(total_chunks), 6) as average_chunk_size,
  {size}::int as target_chunk_size, {int(size * 0.4)}::int as max_background_size from stats""",
        "existing_ids": f"select distinct {ID.format('doc_id')} as chunk_id from documents",
        "collection_info": """
select 'document_chunks' as collection_name, count(*) as document_count,
  'warehouse' as database_path from documents""",
        "filter_new_chunks": f"""
with {INCOMING}, {STORED} select chunk_id, document from incoming
where chunk_id not in (select chunk_id from stored)""",
        "default_ids": """
with rows as (
    select doc_id, text as document, case when l.doc_id is not null then 'doc_' || d.doc_id end as chunk_id
    from documents d left join (select distinct doc_id from labels) l using (doc_id)),
  stored as (
    select 'doc_' || doc_id as chunk_id from labels where toxic = 1
    union all select distinct 'chunk_' || conv_id from conversations),
  accepted as (
    select doc_id, document, coalesce(chunk_id, 'chunk_' || (row_number() over (order by doc_id) - 1)) as chunk_id
    from rows where chunk_id is null or chunk_id not in (select chunk_id from stored))
select chunk_id, document, doc_id from accepted where chunk_id not in (select chunk_id from stored)""",
        "embed_attach": f"""
select {ID.format("doc_id")} as chunk_id, embedding is null as embedding_missing, 64::int as dim,
  round(coalesce(list_sum(list_transform(embedding, lambda x: x::double)), 0), 6) as total
from documents left join embeddings on vec_id = doc_id""",
        "insert_missing": f"""
with {INCOMING}, {STORED}
select chunk_id, document, true as embedding_missing from stored
union all
select chunk_id, document, vec_id is null from incoming left join embeddings on {ID.format("vec_id")} = chunk_id
where chunk_id not in (select chunk_id from stored)""",
        "insert_force": f"""
with {INCOMING}, {STORED}
select chunk_id, document, true as embedding_missing from stored
where chunk_id not in (select chunk_id from incoming)
union all
select chunk_id, document, vec_id is null from incoming left join embeddings on {ID.format("vec_id")} = chunk_id""",
        "insert_force_ignore": f"""
with {INCOMING}, {STORED}
select i.chunk_id, coalesce(s.document, i.document) as document,
  s.chunk_id is not null or vec_id is null as embedding_missing
from incoming i left join stored s using (chunk_id) left join embeddings on {ID.format("vec_id")} = i.chunk_id""",
        "upsert_partial": f"""
select {ID.format("doc_id")} as chunk_id,
  case when doc_id in (select doc_id from labels where toxic = 1) then 'withdrawn' else text end as document,
  not exists (select 1 from embeddings where vec_id = doc_id) as embedding_missing
from documents""",
        "insert_missing_stable": f"""
with d as (
  select {ID.format("doc_id")} as id, text, doc_id in (select doc_id from labels) as known,
    not exists (select 1 from embeddings where vec_id = doc_id) as missing
  from documents)
select case when known then id else 'again_' || id end as chunk_id, sha256(id) as stable_id, text as document,
  not known or missing as embedding_missing from d""",
        "load_chunks": f"""
with {loaded}
select source_file as input_file,
  (row_number() over (partition by conv_id order by turn) - 1)::int as item_pos, text as content,
  case when role <> 'system' then printf('chunk_%06d_%d', conv_id, turn) end as chunk_id,
  len(text)::int as chunk_size
from files join conversations using (conv_id)""",
        "reject_files": """
select distinct case conv_id % 10 when 3 then 'lone_' else 'oops_' end || conv_id || '.json' as source_file,
  case conv_id % 10 when 3 then 'not an array' else 'not JSON' end as reason
from conversations where conv_id % 10 in (3, 6)""",
        "text_roundtrip": f"with {DOC_TEXTS} select source_file, text from docs",
        "entry_roundtrip": entry_rows,
        "chunk_roundtrip": rf"""
with recursive {chunked()}
select 'chunks_' || source_file as input_file,
  (row_number() over (partition by source_file order by entry_pos, chunk_index) - 1)::int as item_pos,
  full_text as content, {chunk_id} as chunk_id, source_file, full_path, len(full_text)::int as chunk_size,
  background_size, len(piece)::int as content_size
from chunks""",
        "named_files": f"""
with {ENTRIES},
counts as (select source_file, count(*) as entries, sum(len(content))::bigint as chars from entries group by 1)
select regexp_replace(source_file, '\\.json$', '') as name, md, entries, chars
from md_docs left join counts using (source_file)""",
        "knn_single": f"""
with {centroids("0")} select chunk_id, round(distance, 6) as distance from hits where rank <= 5""",
        "knn_join": f"""
with {centroids("label")} select query_id, rank, chunk_id, round(distance, 6) as distance from hits where rank <= 3""",
        "knn_join_many": f"""
with pairs as (
  select q.vec_id as query_id, {ID.format("r.vec_id")} as chunk_id,
    list_sum(list_transform(range(1, len(q.embedding) + 1),
      lambda i: pow(q.embedding[i]::double - r.embedding[i]::double, 2))) as distance
  from embeddings q, embeddings r),
hits as (select *, row_number() over (partition by query_id order by distance, chunk_id)::int as rank from pairs)
select query_id, rank, chunk_id, round(distance, 6) as distance from hits where rank <= 3""",
        "knn_cells": f"""
with {centroids("label", "vec_id % 7 not in (1, 2, 3)")}
select query_id, rank, chunk_id, round(distance, 6) as distance from hits where rank <= 3""",
        "knn_join_gaps": f"""
with {centroids("label", "vec_id % 7 not in (1, 2, 3)")}
select query_id, rank, chunk_id, round(distance, 6) as distance from hits where rank <= 3""",
        "search_text": f"""
with d as (select {ID.format("doc_id")} as chunk_id, {TOY} as v from documents),
q as (select item_id as query_id, {TOY} as v from benchmark),
h as (
  select query_id, chunk_id,
    list_sum(list_transform(range(1, 9), lambda i: pow(q.v[i]::float::double - d.v[i]::float::double, 2))) as distance
  from q, d),
r as (select *, row_number() over (partition by query_id order by distance, chunk_id) as rank from h)
select query_id, rank::int as rank, chunk_id, round(distance, 6) as distance from r where rank <= 3""",
        "search_hydrated": f"""
with {centroids("label")}, {INCOMING}
select query_id, rank, h.chunk_id, coalesce(i.source, 'Unknown') as source, coalesce(i.lang, 'Unknown') as path,
  left(coalesce(i.document, ''), 200) || '...' as preview, round(1 - distance, 6) as similarity
from hits h left join incoming i using (chunk_id) where rank <= 3""",
    }
