"""Queries over the change feed, archives, catalog and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P
from filelake.operators import archive, catalog, quality, replay, retrieve, sync
from filelake.operators.skew import latest
from filelake.plans import inputs as I
from filelake.plans.registry import query
from filelake.sources import feed

_FEED = "seq, kind, raw_id, name, path_display, path_lower, rev, size, server_modified"


# --- feed scans --------------------------------------------------------------------------------


@query("feed_baseline", f"select {_FEED} from changes")
def feed_baseline(spark, sf):
    return I.changes(spark, sf)


@query("feed_since_cursor", f"select {_FEED} from changes where seq > (select cursor from previous_cursor)")
def feed_since_cursor(spark, sf):
    return I.since_cursor(spark, sf)


@query("feed_cursor", """
select case when cursor is null then 'baseline' else 'incremental' end as mode, cursor as old_cursor,
  count(*) filter (cursor is null or seq > cursor) as n_events, max(seq) as new_cursor
from changes cross join previous_cursor group by cursor""")
def feed_cursor(spark, sf):
    return feed.advance(I.changes(spark, sf), I.previous_cursor(spark, sf))


@query("list_prefix", "select object_key, size as length from stored_meta where object_key like 'mirror/images/%'")
def list_prefix(spark, sf):
    return catalog.with_prefix(I.objects(spark, sf), "mirror/images/").select("object_key", "length")


@query("docs_glob", "select object_key, size as length from stored_meta where object_key like 'mirror/docs/%'")
def docs_glob(spark, sf):
    return catalog.with_prefix(I.objects(spark, sf), "mirror/docs/").select("object_key", "length")


@query("object_size_probe", """
select file_id, rev, coalesce(length, 0) as length from (
  select file_id, arg_max(rev, seq) as rev, 'mirror/images/' || file_id as object_key
  from ev where kind = 'file' and category = 'images' group by file_id)
left join (select object_key, size as length from stored_meta where true) using (object_key)""")
def object_size_probe(spark, sf):
    seen = sync.enrich(I.changes(spark, sf)).where((F.col("kind") == "file") & (F.col("category") == "images"))
    wanted = seen.groupBy("file_id").agg(F.max_by("rev", "seq").alias("rev")).withColumn(
        "object_key", P.object_key(F.lit("images"), F.col("file_id"), F.lit(""))
    )
    return catalog.sizes_of(wanted, I.objects(spark, sf)).select("file_id", "rev", "length")


# --- projections -------------------------------------------------------------------------------


@query("clean_id", "select seq, replace(raw_id, 'id:', '') as file_id from changes")
def clean_id(spark, sf):
    return I.changes(spark, sf).select("seq", P.clean_id(F.col("raw_id")).alias("file_id"))


@query("file_ext", r"""
select name, lower(regexp_extract(name, '(?s)\A.*?[^./][^/]*(\.[^./]*)\z', 1)) as ext
from (select name from changes where true union all select inner_path from members where true
  union all select url from pages)""")
def file_ext(spark, sf):
    names = I.changes(spark, sf).select("name").unionAll(I.members(spark, sf).select("inner_path"))
    names = names.unionAll(I.table(spark, sf, "pages").select("url"))
    return names.select("name", P.extension(F.col("name")).alias("ext"))


@query("categorize", "select seq, name, category from ev")
def categorize(spark, sf):
    return I.changes(spark, sf).select("seq", "name", P.category(F.col("name")).alias("category"))


@query("mime_type", f"select seq, name, coalesce(mime, '{C.DEFAULT_MIME}') as mime_type from ev")
def mime_type(spark, sf):
    return I.changes(spark, sf).select("seq", "name", P.mime_type(F.col("name")).alias("mime_type"))


@query("object_key", """
select seq, prefix || file_id || case when category = 'docs' then ext else '' end as object_key from ev""")
def object_key(spark, sf):
    e = sync.enrich(I.changes(spark, sf))
    return e.select("seq", P.object_key(F.col("category"), F.col("file_id"), F.col("ext")).alias("object_key"))


@query("meta_key", "select seq, 'mirror/meta/' || file_id || '.json' as meta_key from ev")
def meta_key(spark, sf):
    return I.changes(spark, sf).select("seq", P.meta_key(P.clean_id(F.col("raw_id"))).alias("meta_key"))


@query("object_uri", f"""
select seq, '{I.ROOT}/' || prefix || file_id || case when category = 'docs' then ext else '' end as object_uri from ev""")
def object_uri(spark, sf):
    e = sync.enrich(I.changes(spark, sf))
    key = P.object_key(F.col("category"), F.col("file_id"), F.col("ext"))
    return e.select("seq", P.object_uri(I.ROOT, key).alias("object_uri"))


_META = "file_id, path, rev, mime_type, size, server_modified, category, object_uri, caption"


@query("file_meta", f"select {_META} from meta")
def file_meta(spark, sf):
    return I.meta(spark, sf).drop("source_zip", "extracted_count")


@query("member_id", r"""
select pos, file_id || '___' || replace(inner_path, '/', '_') as member_id,
  '/a/' || file_id || '.zip!/' || inner_path as member_path from members""")
def member_id(spark, sf):
    zip_path = F.concat(F.lit("/a/"), "file_id", F.lit(".zip"))
    return I.members(spark, sf).select(
        "pos", P.member_id(F.col("file_id"), F.col("inner_path")).alias("member_id"),
        P.member_path(zip_path, F.col("inner_path")).alias("member_path"),
    )


@query("uri_to_id", r"""
select uri, regexp_extract(split_part(uri, '/', -1), '(?s)\A(.*?[^./][^/]*)(\.[^./]*)\z', 1) as file_id,
  regexp_extract(uri, '(?s)\A.*?[^./][^/]*(\.[^./]*)\z', 1) as ext from doc_uris""")
def uri_to_id(spark, sf):
    uri = F.col("uri")
    return I.doc_uris(spark, sf).select("uri", P.uri_id(uri).alias("file_id"), P.raw_extension(uri).alias("ext"))


# --- predicates --------------------------------------------------------------------------------


@query("drop_folders", "select seq, kind, path_lower from changes where kind <> 'folder'")
def drop_folders(spark, sf):
    return I.changes(spark, sf).where(F.col("kind") != "folder").select("seq", "kind", "path_lower")


@query("supported_only", "select seq, name, category from ev where kind = 'file' and category is not null")
def supported_only(spark, sf):
    e = sync.enrich(I.changes(spark, sf))
    return e.where((F.col("kind") == "file") & F.col("category").isNotNull()).select("seq", "name", "category")


@query("size_limit", f"""
select seq, size from ev where kind = 'file' and not archive and size <= {C.MAX_FILE_BYTES}""")
def size_limit(spark, sf):
    e = sync.enrich(I.changes(spark, sf))
    keep = (F.col("kind") == "file") & ~F.col("archive") & (F.col("size") <= C.MAX_FILE_BYTES)
    return e.where(keep).select("seq", "size")


@query("archive_limit", """
select seq, outcome from outcomes join changes using (seq) where kind = 'file' and archive""")
def archive_limit(spark, sf):
    c = sync.classify(I.changes(spark, sf))
    return c.where((F.col("kind") == "file") & F.col("archive")).select("seq", "outcome")


@query("archive_detect", """
select seq, name, path_lower like '%.zip' as archive from changes where kind <> 'folder'""")
def archive_detect(spark, sf):
    e = sync.enrich(I.changes(spark, sf))
    return e.where(F.col("kind") != "folder").select("seq", "name", "archive")


@query("member_filter", "select pos, inner_path, filename, file_size from visible")
def member_filter(spark, sf):
    v = archive.visible_members(I.members(spark, sf))
    return v.select("pos", "inner_path", "filename", "file_size")


@query("images_only", "select file_id, rev, size from meta where category = 'images'")
def images_only(spark, sf):
    return I.meta(spark, sf).where(F.col("category") == "images").select("file_id", "rev", "size")


# --- joins and outcomes ------------------------------------------------------------------------


@query("rev_unchanged", """
select e.seq, e.file_id, e.rev, r.rev as held_rev, coalesce(e.rev = r.rev, false) as unchanged
from ev e left join rev_index r on e.file_id = r.file_id where e.kind = 'file'""")
def rev_unchanged(spark, sf):
    out = sync.unchanged_against(I.changes(spark, sf), I.rev_index(spark, sf))
    return out.select("seq", "file_id", "rev", "held_rev", "unchanged")


_RESOLVED = """(select c.seq, c.path_lower, p.file_id, case when p.file_id is null then 'skipped' else 'deleted' end as outcome
from changes c left join path_index p on c.path_lower = p.path_lower
where c.kind = 'deleted' and c.path_lower not like '%.zip')"""


@query("delete_resolve", f"select seq, path_lower, file_id, outcome from {_RESOLVED} d")
def delete_resolve(spark, sf):
    return sync.resolve_deletes(I.changes(spark, sf), I.path_index(spark, sf))


@query("delete_objects", f"""
select distinct d.path_lower, d.file_id, m.object_key, 'mirror/meta/' || d.file_id || '.json' as meta_key
from {_RESOLVED} d left join meta m on d.file_id = m.file_id where d.file_id is not null""")
def delete_objects(spark, sf):
    resolved = sync.resolve_deletes(I.changes(spark, sf), I.path_index(spark, sf))
    return sync.doomed_objects(resolved, I.meta(spark, sf))


@query("archive_cascade", """
select distinct g.path_lower as archive_path, p.path_lower as child_path, p.file_id as child_id
from path_index p join (select distinct path_lower from changes where kind = 'deleted' and path_lower like '%.zip') g
  on starts_with(p.path_lower, g.path_lower || '!/')""")
def archive_cascade(spark, sf):
    c = I.changes(spark, sf)
    gone = c.where((F.col("kind") == "deleted") & F.col("path_lower").endswith(".zip"))
    return sync.archive_cascade(gone, I.path_index(spark, sf))


@query("sync_outcomes", "select outcome, count(*) as n from outcomes group by outcome")
def sync_outcomes(spark, sf):
    return sync.outcome_counts(sync.classify(I.changes(spark, sf)))


@query("event_outcomes", "select seq, file_id, prev_rev, outcome from outcomes")
def event_outcomes(spark, sf):
    return sync.classify(I.changes(spark, sf)).select("seq", "file_id", "prev_rev", "outcome")


@query("sync_counters", """
with per_archive as (
  select coalesce(sum((outcome = 'archive')::int * n_members), 0) as members,
    coalesce(sum((outcome = 'archive')::int * n_skipped), 0) as skipped,
    coalesce(sum((outcome = 'archive_deleted' and prev_rev is not null)::int * n_paths), 0) as deleted,
    coalesce(sum((outcome = 'archive')::int * n_docs), 0) as docs
  from outcomes join member_totals using (file_id) where archive)
select 'synced' as counter, cast(count(*) as bigint) as n from outcomes where outcome = 'synced'
union all select 'unchanged', count(*) from outcomes where outcome = 'unchanged'
union all select 'deleted', cast((select count(*) from outcomes where outcome = 'deleted') + deleted as bigint) from per_archive
union all select 'skipped', cast((select count(*) from outcomes where outcome = 'skipped') + skipped as bigint) from per_archive
union all select 'zip_extracted', cast(members as bigint) from per_archive
union all select 'docs_imported',
  cast((select count(*) from outcomes where outcome = 'synced' and category = 'docs') + docs as bigint) from per_archive""")
def sync_counters(spark, sf):
    return sync.counters(sync.classify(I.changes(spark, sf)), archive.member_totals(I.members(spark, sf)))


@query("fold_latest", "select path_lower, file_id, rev, seq, size, category from live")
def fold_latest(spark, sf):
    return I.live(spark, sf).select("path_lower", "file_id", "rev", "seq", "size", "category")


@query("replay_outcomes", "select seq, outcome from outcomes where outcome <> 'folder'")
def replay_outcomes(spark, sf):
    """On a feed of paired paths and ids the exact replay must agree with the window form."""
    settled = replay.replay(I.changes(spark, sf))
    return settled.where(~F.col("kind").startswith("seed")).select("seq", "outcome")


@query("replay_exact", "select seq, path_lower, file_id, outcome, target from replayed")
def replay_exact(spark, sf):
    """Events of the feed in which files move between paths, as applied one by one."""
    settled = replay.replay(I.moves(spark, sf))
    return settled.select("seq", "path_lower", "file_id", "outcome", "target")


@query("replay_index", """
select path_lower, file_id from replayed_paths where path_lower not in (select path_lower from replayed_members)
union all select path_lower, file_id from replayed_members""")
def replay_index(spark, sf):
    """Path index left by the same feed, archive members included; rounds look only at what can still change."""
    inside = archive.visible_members(I.members(spark, sf))
    return replay.final_index(replay.replay(I.moves(spark, sf), frontier_from=0), inside)


# --- archives ----------------------------------------------------------------------------------

_MEMBER = "zip_id, file_id, path, rev, mime_type, size, server_modified, category, object_uri, caption, source_zip"


@query("archive_expand", f"select {_MEMBER}, pos from expanded")
def archive_expand(spark, sf):
    return archive.expand(I.live_archives(spark, sf), I.members(spark, sf), I.ROOT)


@query("member_meta", f"select {_MEMBER.replace('zip_id, ', '')} from expanded")
def member_meta(spark, sf):
    rows = archive.expand(I.live_archives(spark, sf), I.members(spark, sf), I.ROOT)
    return rows.drop("zip_id", "pos")


@query("archive_meta", """
select l.file_id, l.path_display as path, l.rev, 'archive' as category, l.size,
  case when date_trunc('second', l.server_modified) = l.server_modified
    then strftime(l.server_modified, '%Y-%m-%d %H:%M:%S')
    else strftime(l.server_modified, '%Y-%m-%d %H:%M:%S.%f') end as server_modified,
  coalesce(t.n_members, 0) as extracted_count
from live l left join member_totals t on l.file_id = t.file_id where l.archive""")
def archive_meta(spark, sf):
    return archive.archive_meta(I.live_archives(spark, sf), I.members(spark, sf))


@query("archive_counts", """
select a.file_id, coalesce(t.n_members, 0) as n_members, coalesce(t.n_skipped, 0) as n_skipped
from (select distinct file_id from ev where archive) a left join member_totals t on a.file_id = t.file_id""")
def archive_counts(spark, sf):
    heads = sync.enrich(I.changes(spark, sf)).where("archive").select("file_id").distinct()
    return heads.join(archive.member_totals(I.members(spark, sf)), "file_id", "left").select(
        "file_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("n_members", "n_skipped")]
    )


@query("member_collisions", """
select file_id || '___' || replace(inner_path, '/', '_') as member_id, count(distinct inner_path) as n_paths
from visible where category is not null group by 1 having count(distinct inner_path) > 1""")
def member_collisions(spark, sf):
    return archive.collisions(I.members(spark, sf))


# --- catalog reports and sets ------------------------------------------------------------------


@query("category_counts", "select category, count(*) as n from catalog group by category")
def category_counts(spark, sf):
    return catalog.category_counts(I.catalog(spark, sf))


@query("ext_breakdown", r"""
select regexp_extract(object_uri, '(\.[a-z]+)$', 1) as ext, count(*) as n from stored_meta where category = 'docs' group by 1""")
def ext_breakdown(spark, sf):
    return catalog.ext_breakdown(I.stored_meta(spark, sf))


@query("coverage", """
select category, count(*) as total, count(r.rev) as done, round(100.0 * count(r.rev) / count(*), 1) as percent
from catalog m left join all_revs r on m.file_id = r.file_id and m.rev = r.rev group by category""")
def coverage(spark, sf):
    held = I.all_revs(spark, sf).withColumn("done", F.lit(True))
    rows = I.catalog(spark, sf).join(held, ["file_id", "rev"], "left")
    done, total = F.count_if(F.col("done").isNotNull()), F.count(F.lit(1))
    return rows.groupBy("category").agg(
        total.alias("total"), done.alias("done"), catalog.percent(done, total).alias("percent")
    )


@query("rev_rebuild", """
select file_id, arg_max(rev, seq) as rev from ev where kind = 'file' and file_id <> '' and rev <> '' group by file_id""")
def rev_rebuild(spark, sf):
    sidecars = sync.enrich(I.changes(spark, sf)).where(F.col("kind") == "file")
    return catalog.rebuild_revs(sidecars, "seq")


_VALID = """(select distinct coalesce(nullif(regexp_extract(object_uri, '/mirror/images/([^/]+)$', 1), ''),
  nullif(regexp_extract(object_uri, '/mirror/docs/([^/]+)[.][a-z]+$', 1), '')) as file_id from (
    select object_uri from meta where true union all select object_uri from expanded))"""


def _listing(spark, sf):
    stored = archive.expand(I.live_archives(spark, sf), I.members(spark, sf), I.ROOT)
    return I.meta(spark, sf).select("object_uri").unionAll(stored.select("object_uri"))


@query("id_sets", f"select file_id from {_VALID} v where file_id is not null")
def id_sets(spark, sf):
    return catalog.valid_ids(_listing(spark, sf))


@query("resync_keep", f"select file_id, rev from rev_index where file_id in (select file_id from {_VALID} v)")
def resync_keep(spark, sf):
    return catalog.resync_keep(I.rev_index(spark, sf), catalog.valid_ids(_listing(spark, sf)))


@query("resync_removed", f"""
select file_id, rev from rev_index where file_id not in (select file_id from {_VALID} v where file_id is not null)""")
def resync_removed(spark, sf):
    return catalog.resync_removed(I.rev_index(spark, sf), catalog.valid_ids(_listing(spark, sf)))


@query("resync_summary", f"""
select count(*) as original, count(*) - count(v.file_id) as removed, count(v.file_id) as kept
from rev_index r left join {_VALID} v on r.file_id = v.file_id""")
def resync_summary(spark, sf):
    return catalog.resync_summary(I.rev_index(spark, sf), catalog.valid_ids(_listing(spark, sf)))


@query("keep_ids", """
select file_id from meta where category = 'images' union select file_id from meta where category = 'docs'
union select file_id from expanded where category in ('images', 'docs')""")
def keep_ids(spark, sf):
    m = I.meta(spark, sf)
    stored = archive.expand(I.live_archives(spark, sf), I.members(spark, sf), I.ROOT)
    good = F.col("category").isin("images", "docs")
    return m.where(good).select("file_id").union(stored.where(good).select("file_id")).distinct()


@query("stale_ids", "select file_id from rev_index except select file_id from live")
def stale_ids(spark, sf):
    return I.rev_index(spark, sf).select("file_id").subtract(I.live(spark, sf).select("file_id"))


@query("apply_deletes", f"""
select object_key, size as length from (
  select prefix || file_id || case when category = 'docs' then ext else '' end as object_key, size from (
    select *, row_number() over (partition by file_id order by seq desc) as rn from ev where ok and not archive) where rn = 1)
where object_key not in (select m.object_key from {_RESOLVED} d join meta m on d.file_id = m.file_id)""")
def apply_deletes(spark, sf):
    c = I.changes(spark, sf)
    stored = sync.enrich(c).where(sync.acceptable() & ~F.col("archive"))
    listing = latest(stored, "file_id", "seq").select(
        P.object_key(F.col("category"), F.col("file_id"), F.col("ext")).alias("object_key"),
        F.col("size").alias("length"),
    )
    doomed = sync.doomed_objects(sync.resolve_deletes(c, I.path_index(spark, sf)), I.meta(spark, sf))
    return catalog.apply_deletes(listing, doomed)


@query("sample_keys", "select object_key from stored_meta order by object_key limit 20")
def sample_keys(spark, sf):
    return I.objects(spark, sf).select("object_key").orderBy("object_key").limit(20)


@query("display_fields", """
select seq, size // 1048576 as mib, size // 1073741824 as gib, round(value, 4) as shown,
  substring(path_display, 1, 120) as label from changes join events on seq = event_id""")
def display_fields(spark, sf):
    values = I.table(spark, sf, "events").select(F.col("event_id").alias("seq"), "value")
    return I.changes(spark, sf).join(values, "seq").select(
        "seq", P.whole_mib(F.col("size")).alias("mib"), P.whole_gib(F.col("size")).alias("gib"),
        retrieve.shown_distance(F.col("value")).alias("shown"),
        retrieve.shown_snippet(F.col("path_display")).alias("label"),
    )


# --- quality -----------------------------------------------------------------------------------


@query("dq_mirror", """
with c as (select count(*) filter (category = 'images') as images, count(*) filter (category = 'docs') as docs,
    count(*) filter (category = 'media') as media, count(*) as sidecars,
    (select count(*) from path_index) as paths from catalog)
select 'images' as "check", images as value, true as passed from c union all select 'docs', docs, true from c
union all select 'media', media, true from c union all select 'images_or_docs', images + docs, images + docs > 0 from c
union all select 'sidecars', sidecars, sidecars > 0 from c union all select 'paths', paths, paths > 0 from c""")
def dq_mirror(spark, sf):
    return quality.mirror_report(I.catalog(spark, sf), I.path_index(spark, sf))


@query("dq_embeddings", """
select count(i.file_id) as images, count(*) filter (i.rev = s.rev) as embedded,
  count(*) filter (i.rev <> s.rev) as outdated, count(*) filter (i.file_id is null) as stale,
  round(100.0 * count(*) filter (i.rev = s.rev) / count(i.file_id), 1) as coverage
from images i full join emb_state s on i.file_id = s.file_id""")
def dq_embeddings(spark, sf):
    return quality.embedding_report(I.images(spark, sf), I.emb_state(spark, sf))


@query("dq_integrity", """
with n as (select
  (select count(*) from path_index where file_id not in (select file_id from catalog)) as a,
  (select count(*) from all_revs where file_id not in (select file_id from catalog)) as b,
  (select count(*) from catalog where file_id not in (select file_id from path_index)) as c,
  (select count(*) from catalog where file_id not in (select file_id from all_revs)) as d,
  (select count(*) from catalog where category is null) as e)
select 'paths_without_meta' as "check", a as value, a = 0 as passed from n union all select 'revs_without_meta', b, b = 0 from n
union all select 'meta_without_path', c, c = 0 from n union all select 'meta_without_rev', d, d = 0 from n
union all select 'meta_without_category', e, e = 0 from n""")
def dq_integrity(spark, sf):
    return quality.integrity_report(I.path_index(spark, sf), I.all_revs(spark, sf), I.catalog(spark, sf))
