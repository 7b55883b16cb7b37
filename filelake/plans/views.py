"""SQL views of the checks, as common table expressions over the given tables."""

from __future__ import annotations

import re

from filelake import constants as C
from filelake.plans.inputs import SLOTS, DIM, ROOT

_SLOT_LIST = "[" + ",".join(f"'{e}'" for e in SLOTS) + "]"
_TYPES = ",\n".join(f"('{e}','{c}','{C.PREFIXES[c]}','{m}')" for e, c, m in C.FILE_TYPES)


# Rounds in which the checks apply the moving feed.
_ROUNDS = 60


def _feed_sql(path_no: str) -> str:
    return f"""
select event_id as seq,
  case event_type when 'error' then 'deleted' when 'view' then 'folder' else 'file' end as kind,
  'id:' || user_id as raw_id, 'F' || p || x as name,
  '/Team' || (p % 7) || '/F' || p || x as path_display,
  lower('/Team' || (p % 7) || '/F' || p || x) as path_lower,
  'r' || (event_id % 3) as rev,
  cast(floor(value * case when x = '.zip' then 64.0 * 3145728 else 3145728.0 end) as bigint) as size,
  ts as server_modified, lower(x) as ext
from (select *, {_SLOT_LIST}[p % 17 + 1] as x from (select *, {path_no} as p from events))"""


def _time_sql(ts: str) -> str:
    return (
        f"case when date_trunc('second', {ts}) = {ts} then strftime({ts}, '%Y-%m-%d %H:%M:%S') "
        f"else strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') end"
    )


VIEWS: dict[str, str] = {
    "ext_dim": f"select * from (values\n{_TYPES}) as t(ext, category, prefix, mime)",
    "changes": _feed_sql("user_id"),
    "moves": _feed_sql("user_id + day(ts) % 2 + (value > 400)::int"),
    "ev": f"""
select c.*, replace(c.raw_id, 'id:', '') as file_id, x.category, x.prefix, x.mime, c.ext = '.zip' as archive,
  c.kind = 'file' and (c.ext = '.zip' and c.size <= {C.MAX_ARCHIVE_BYTES}
    or x.category is not null and c.size <= {C.MAX_FILE_BYTES}) as ok
from changes c left join ext_dim x on c.ext = x.ext""",
    "held": """
select *, nullif(last_value(case when kind = 'deleted' then '' when ok then rev end ignore nulls)
  over (partition by path_lower order by seq rows between unbounded preceding and 1 preceding), '') as prev_rev
from ev where kind <> 'folder'""",
    "outcomes": f"""
select seq, path_lower, file_id, category, archive, prev_rev, case
  when kind = 'deleted' and archive then 'archive_deleted'
  when kind = 'deleted' then case when prev_rev is null then 'skipped' else 'deleted' end
  when archive and rev = prev_rev then 'unchanged'
  when archive then case when size > {C.MAX_ARCHIVE_BYTES} then 'skipped' else 'archive' end
  when category is null or size > {C.MAX_FILE_BYTES} then 'skipped'
  when rev = prev_rev then 'unchanged' else 'synced' end as outcome
from held
union all
select seq, path_lower, file_id, category, archive, null, 'folder' from ev where kind = 'folder'""",
    "owners": """
select * from (select *, row_number() over (partition by path_lower order by seq desc) as rn
  from ev where ok or kind = 'deleted') where rn = 1 and kind = 'file'""",
    "live": """
select * exclude (rn, rn2) from (select *, row_number() over (partition by file_id order by seq desc) as rn2
  from owners) where rn2 = 1""",
    "moved_ev": f"""
select c.*, replace(c.raw_id, 'id:', '') as file_id, x.category, x.prefix, c.ext = '.zip' as archive,
  c.kind = 'file' and (c.ext = '.zip' and c.size <= {C.MAX_ARCHIVE_BYTES}
    or x.category is not null and c.size <= {C.MAX_FILE_BYTES}) as ok
from moves c left join ext_dim x on c.ext = x.ext""",
    "moved_live": """
select * exclude (rn, rm) from (
  select *, row_number() over (partition by file_id order by seq desc) as rm from (
    select *, row_number() over (partition by path_lower order by seq desc) as rn
    from moved_ev where ok or kind = 'deleted') where rn = 1 and kind = 'file') where rm = 1""",
    # The feed applied event by event, as the fixpoint of its two rules; more rounds than its longest chain change nothing.
    "replayed": f"""
with recursive acts as (
  select seq, kind, path_lower, file_id, rev, size, category, archive, ok from moved_ev where kind <> 'folder'
), rounds as (
  select 0 as n, seq, ok as taken, cast(null as varchar) as target, cast(null as varchar) as held from acts
  union all
  select n + 1, seq, ok and coalesce(held <> rev, true), target, held from (
    select *, nullif(last_value(case when kind = 'file' and ok then rev when target is not null then '' end ignore nulls) over (
        partition by case when kind = 'file' then file_id when target is not null then target else '#' || seq end
        order by seq rows between unbounded preceding and 1 preceding), '') as held
    from (
      select n, a.*, case when kind = 'deleted' then nullif(last_value(
          case when taken then file_id when kind = 'deleted' then '' end ignore nulls) over (
          partition by path_lower order by seq rows between unbounded preceding and 1 preceding), '') end as target
      from rounds r join acts a using (seq) where n < {_ROUNDS}))
)
select a.*, r.taken, r.target, case
  when kind = 'deleted' and archive then 'archive_deleted'
  when kind = 'deleted' then case when target is null then 'skipped' else 'deleted' end
  when archive and rev = held then 'unchanged'
  when archive then case when size > {C.MAX_ARCHIVE_BYTES} then 'skipped' else 'archive' end
  when category is null or size > {C.MAX_FILE_BYTES} then 'skipped'
  when rev = held then 'unchanged' else 'synced' end as outcome
from rounds r join acts a using (seq) where n = {_ROUNDS}""",
    "replayed_paths": """
select path_lower, file_id from (
  select *, row_number() over (partition by path_lower order by seq desc) as rn from replayed where taken or kind = 'deleted')
where rn = 1 and kind <> 'deleted'""",
    "replayed_revs": """
select owner as file_id, rev from (
  select *, row_number() over (partition by owner order by seq desc) as rn
  from (select *, coalesce(target, file_id) as owner from replayed where ok or target is not null))
where rn = 1 and kind <> 'deleted'""",
    "replayed_members": """
select path as path_lower, id as file_id from (
  select t.path_lower || '!/' || v.inner_path as path, t.file_id || '___' || replace(v.inner_path, '/', '_') as id,
    row_number() over (partition by t.path_lower || '!/' || v.inner_path order by t.seq desc, v.pos desc) as rn
  from (select path_lower, file_id, max(seq) as seq from replayed where taken and archive group by all) t
    join visible v on t.file_id = v.file_id
    left join (select path_lower, max(seq) as seq from replayed where kind = 'deleted' and archive group by all) g
      on t.path_lower = g.path_lower
  where v.category is not null and (g.seq is null or t.seq > g.seq)) where rn = 1""",
    "boxes": """
select path_lower, path_display, row_number() over (order by path_lower) - 1 as box
from (select distinct path_lower, path_display from changes where kind = 'file' and ext = '.zip')""",
    "moved_boxes": """
select path_lower, path_display, row_number() over (order by path_lower) - 1 as box
from (select distinct path_lower, path_display from moves where kind = 'file' and ext = '.zip')""",
    "boxed": f"""
select doc_id, lang, text, 'src/' || doc_id || slot as inner_path, 'src_' || doc_id || slot as inner_id, x.category,
  x.prefix, case when x.category = 'docs' then lower(slot) else '' end as suffix,
  cast(octet_length(encode(text)) as bigint) as n_bytes
from (select *, {_SLOT_LIST}[n_chars % 17 + 1] as slot from documents) d join ext_dim x on lower(slot) = x.ext""",
    "box_members": """
select l.file_id as zip_id, l.rev, m.*, l.file_id || '___' || inner_id as file_id, l.path_lower || '!/' || inner_path as path
from live l join boxes b on l.path_lower = b.path_lower
  join boxed m on m.doc_id % (select count(*) from boxes) = b.box""",
    "meta": f"""
select file_id, path_display as path, rev, mime as mime_type, size, {_time_sql('server_modified')} as server_modified,
  category, '{ROOT}/' || prefix || file_id || case when category = 'docs' then ext else '' end as object_uri,
  name as caption, prefix || file_id || case when category = 'docs' then ext else '' end as object_key
from live where not archive""",
    "rev_index": "select file_id, arg_min(rev, seq) as rev from ev where kind = 'file' group by file_id",
    "members": f"""
select cast(3 + 17 * (doc_id % 4) as varchar) as file_id, doc_id as pos, n_chars * 65536 as file_size,
  case when doc_id % 23 = 0 then '__MACOSX/' || doc_id || '.png'
       when doc_id % 29 = 0 then source || '/.h' || doc_id || '.png'
       when doc_id % 37 = 0 then source || '/d' || doc_id || '/'
       else source || case when lang = 'en' then '/' else '_' end || 'f' || (n_chars % 1000)
         || {_SLOT_LIST}[n_chars % 17 + 1] end as inner_path
from documents""",
    "visible": f"""
select m.*, b.filename, b.ext, x.category, x.prefix, x.mime
from members m, lateral (select split_part(m.inner_path, '/', -1) as filename,
    lower(regexp_extract(m.inner_path, '(?s)\\A.*?[^./][^/]*(\\.[^./]*)\\z', 1)) as ext) b
  left join ext_dim x on b.ext = x.ext
where m.inner_path not like '%/' and m.inner_path not like '\\_\\_MACOSX%' escape '\\'
  and b.filename not like '.%' and m.file_size <= {C.MAX_MEMBER_BYTES}""",
    "expanded": f"""
select * exclude (rn) from (select v.file_id as zip_id, v.file_id || '___' || replace(inner_path, '/', '_') as file_id,
  l.path_lower || '!/' || inner_path as path, l.rev, v.mime as mime_type, v.file_size as size,
  {_time_sql('l.server_modified')} as server_modified, v.category,
  '{ROOT}/' || v.prefix || v.file_id || '___' || replace(inner_path, '/', '_')
    || case when v.category = 'docs' then v.ext else '' end as object_uri,
  v.filename as caption, l.path_display as source_zip, v.pos,
  row_number() over (partition by v.file_id || '___' || replace(inner_path, '/', '_') order by v.pos desc) as rn
from visible v join live l on v.file_id = l.file_id
where l.archive and v.category is not null) where rn = 1""",
    "stored_meta": f"""
select file_id, path, rev, size, category, object_uri, object_key from meta where true
union all select file_id, path, rev, size, category, object_uri, replace(object_uri, '{ROOT}/', '') from expanded""",
    "catalog": """
select file_id, path, rev, size, category, object_uri, object_key from stored_meta where true
union all select file_id, path_display, rev, size, 'archive', null, null from live where archive""",
    "all_revs": """
select file_id, rev from rev_index where true
union all select distinct v.file_id || '___' || replace(v.inner_path, '/', '_'), r.rev
from visible v join rev_index r on v.file_id = r.file_id where v.category is not null""",
    "member_totals": """
select file_id, count(category) as n_members, count(*) - count(category) as n_skipped,
  count(distinct case when category is not null then inner_path end) as n_paths,
  count(case when category = 'docs' then 1 end) as n_docs
from visible group by file_id""",
    "path_index": """
select distinct path_lower, file_id from ev where kind = 'file'
union all
select distinct h.path_lower || '!/' || v.inner_path, v.file_id || '___' || replace(v.inner_path, '/', '_')
from visible v join (select distinct file_id, path_lower from ev where kind = 'file' and archive) h
  on v.file_id = h.file_id where v.category is not null""",
    "previous_cursor": """
select max(event_id) as cursor from events
where ts < (select max(date_trunc('day', ts)) from events)""",
    "images": """
select vec_id as file_id, 'r' || (label % 3) as rev,
  cast(floor(abs(cast(embedding[1] as double)) * 167772160.0) as bigint) as size from embeddings""",
    "emb_state": "select doc_id as file_id, 'r' || (quality + toxic) as rev from labels",
    "docs": """
select doc_id, text, source || '-' || doc_id || '.txt' as title, 'mirror/docs/' || doc_id || '.txt' as link
from documents""",
    "queries": f"select item_id as query_id, text, cast({C.COMBINED_TOP_K} as bigint) as k from benchmark",
    "query_weights": f"""
select query_id, bucket, n / sqrt(sum(n * n) over (partition by query_id)) as weight from (
  select query_id, cast('0x' || substr(md5(term), 1, 8) as bigint) % {DIM} as bucket, cast(count(*) as double) as n
  from (select query_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as term from queries)
  group by all)""",
    "components": f"""
select vec_id, generate_subscripts(embedding, 1) - 1 as bucket, cast(unnest(embedding) as double) as x
from embeddings""",
    "neighbors": f"""
select query_id, datapoint_id, distance, rank from (
  select *, row_number() over (partition by query_id order by distance desc, datapoint_id) as rank from (
    select query_id, vec_id as datapoint_id, round(sum(weight * x), {C.SCORE_DIGITS}) + 0.0 as distance
    from query_weights join components using (bucket) group by all))
  join queries using (query_id) where rank <= k""",
    "doc_terms": """
select doc_id, len(toks) as dl, unnest(toks) as term
from (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as toks from documents)""",
    "postings": "select term, doc_id, count(*) as tf, dl from doc_terms group by all",
    "doc_stats": """
select doc_id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as dl from documents""",
    "query_terms": """
select distinct query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as term from queries""",
    "scored": f"""
select query_id, doc_id, round(sum(ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * tf * {C.BM25_K1 + 1}
  / (tf + {C.BM25_K1} * ({1 - C.BM25_B} + {C.BM25_B} * dl / avg_dl))), {C.SCORE_DIGITS}) as score
from query_terms join postings using (term)
  join (select term, count(*) as df from postings group by term) using (term),
  (select count(*) as n_docs, cast(sum(dl) as double) / count(*) as avg_dl from doc_stats)
group by all""",
    "page": """
select query_id, doc_id, score, rank from (
  select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scored)
  join queries using (query_id) where rank <= k""",
    "snippets": f"""
select query_id, doc_id, substring(text, coalesce(min(nullif(strpos(lower(text), term), 0)), 1), {C.SNIPPET_CHARS}) as snippet
from page join query_terms using (query_id) join documents using (doc_id) group by query_id, doc_id, text""",
    "doc_uris": f"""
select '{ROOT}/mirror/docs/' || lpad(cast(doc_id as varchar), 12, '0') || {_SLOT_LIST}[doc_id % 17 + 1] as uri,
  doc_id, n_chars from documents""",
    "import_ops": f"""
select op_id, count(*) as n_uris, count(*) filter (n_chars > 3000) as n_long from (
  select *, (row_number() over (order by uri) - 1) // {C.IMPORT_BATCH} as op_id from doc_uris) group by op_id""",
    "import_counts": """
select op_id, case op_id % 6 when 1 then 0 when 2 then n_uris - n_long when 5 then 0 else n_uris end as success,
  case op_id % 6 when 1 then n_uris when 2 then n_long when 5 then n_uris else 0 end as failed from import_ops""",
}


def with_views(sql: str) -> str:
    """``sql`` with the views it names, directly or through others, put before it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:from|join)\s+([a-z_]+)", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    # A query with views of its own continues the list.
    return f"with {head},\n{body[4:]}" if body.startswith("with") else f"with {head}\n{body}"
