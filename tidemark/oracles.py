"""Plain SQL that gives the result of each query in `queries`.

The statements state the semantics a second way (windows, correlated EXISTS,
recursive CTEs, ASOF joins) and serve as the correctness check on one node.
"""

from __future__ import annotations

from tidemark.bindings import PLAIN, select_text
from tidemark.catalog import CATALOG, DELETED
from tidemark.plans.cascade import CATALOG_KEYS, CATALOG_RULES

ORACLES: dict[str, str] = {}

# Named building blocks: derived tables first, then steps over them. A block
# may use the blocks it lists.
BLOCKS: dict[str, tuple[list[str], str]] = {}


def block(name: str, uses: list[str], text: str) -> None:
    BLOCKS[name] = (uses, text)


def _closure(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        for inner in BLOCKS[name][0]:
            visit(inner)
        if name not in done:
            done.append(name)

    for n in names:
        visit(n)
    return done


def oracle(name: str, uses: list[str], body: str, recursive: str = "") -> None:
    ctes = [f"{b} as ({BLOCKS[b][1].strip()})" for b in _closure(uses)]
    if recursive:
        ctes.append(recursive.strip())
    head = "with recursive " if recursive else "with "
    ORACLES[name] = (head + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()


for table in (
    "feed",
    "mutations",
    "inodes",
    "users",
    "groups",
    "projects",
    "datasets",
    "xattrs",
    "admin_log",
    "app_log",
    "provenance",
    "xattr_buffer",
    "provenance_inodes",
    "changes",
    "responses",
):
    # "groups" is a keyword in window frames.
    block({"groups": "owner_groups"}.get(table, table), [], select_text(table, PLAIN))

LOG_PK = "dataset_id || '-' || inode_id || '-' || logical_time"
PROV_PK = (
    "inode_id || '-' || inode_operation || '-' || io_logical_time || '-' || io_timestamp || '-' || "
    "io_app_id || '-' || io_user_id"
)

# --- sources ---------------------------------------------------------------

oracle(
    "feed_subscribe",
    ["mutations"],
    """
select case when operation = 0 then 'INSERT' else 'UPDATE' end as op, commit_epoch, inode_id,
  logical_time, inode_name
from mutations where operation in (0, 2, 3, 4)
""",
)
oracle(
    "feed_deletes",
    ["mutations"],
    """
select 'DELETE' as op, commit_epoch, inode_id, logical_time - 1 as logical_time,
  inode_name || '~' as inode_name
from mutations where operation = 1
""",
)
oracle("scan_normalised", [], "select doc_id, lang, 'é-' || source as source from documents")
oracle(
    "scan_filtered",
    ["datasets"],
    """select id, inode_name, projectId as "projectId" from datasets where searchable = 1""",
)
oracle(
    "scan_snapshot",
    ["admin_log"],
    """
select id, commit_epoch, row_number() over (order by commit_epoch, id) as position from admin_log
""",
)

# --- order, dedup, batching ------------------------------------------------

oracle(
    "feed_order_epoch",
    ["mutations"],
    f"""
select {LOG_PK} as log_pk, commit_epoch,
  row_number() over (order by commit_epoch, inode_id, logical_time, dataset_id) as position
from mutations
""",
)
oracle(
    "feed_closed_epochs",
    ["feed"],
    """
select event_id, commit_epoch, commit_epoch < (select max(commit_epoch) from feed) as released
from feed
""",
)
oracle(
    "feed_gci",
    ["feed"],
    """
select event_id, wide_epoch as commit_epoch, wide_epoch >> 32 as gci from feed
where wide_epoch >> 32 < (select max(wide_epoch >> 32) from feed)
""",
)
PHASE = """
case when inode_id = dataset_i_id and inode_operation in ('XATTR_ADD', 'XATTR_UPDATE')
    and i_xattr_name = 'core' then 0
  when inode_id = dataset_i_id and inode_operation = 'DELETE' then 2 else 1 end
"""
oracle(
    "feed_order_phase",
    ["provenance"],
    f"""
select {PROV_PK} || '-' || tb as log_pk, phase, row_number() over (order by commit_epoch,
  dataset_i_id, ds_logical_time, phase, inode_id, io_logical_time, tb) as position
from (select *, {PHASE} as phase from provenance) p
""",
)
oracle(
    "feed_order_app",
    ["app_log"],
    """
select id || '-' || state || '-' || timestamp as log_pk,
  row_number() over (order by commit_epoch, id, state, timestamp) as position
from app_log
""",
)
oracle(
    "bootstrap_dedup",
    ["feed"],
    """
select event_id, commit_epoch, k, case when k >= 30 then 'live' else 'snapshot' end as captured
from feed
""",
)
oracle(
    "dedup_pk",
    [],
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_partkey, l_suppkey, l_quantity) = 1
""",
)
oracle(
    "batch_by_count",
    ["mutations"],
    """
select batch_id, count(*) as n, min(logical_time) as first_time, max(logical_time) as last_time
from (
  select logical_time, (row_number() over (order by commit_epoch, inode_id, logical_time,
    dataset_id) - 1) // 64 as batch_id
  from mutations) m
group by batch_id
""",
)
oracle(
    "bundle_bytes",
    [],
    """
select lang, doc_id, bytes, cast((sum(bytes) over (partition by lang order by doc_id) - bytes)
  // 50000 as bigint) as bundle_id
from (select lang, doc_id, cast(strlen(text) as bigint) as bytes from documents) d
""",
)

# --- lookups and enrichment ------------------------------------------------

oracle(
    "lookup_equal",
    [],
    """
select l_suppkey, count(*) as n from lineitem where l_returnflag = 'R' and l_linenumber = 1
group by l_suppkey
""",
)
oracle(
    "lookup_unique",
    [],
    """
select o_custkey, o_orderkey, o_orderstatus from orders
qualify count(*) over (partition by o_custkey) = 1
""",
)
oracle(
    "lookup_exists",
    [],
    """
select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as has_orders
from customer
""",
)
oracle(
    "lookup_delete",
    [],
    """
select count(*) as n, 'left' as what from lineitem where not exists
  (select 1 from orders where o_orderkey = l_orderkey and o_orderpriority = '1-URGENT')
union all
select count(*), 'deleted' from lineitem where exists
  (select 1 from orders where o_orderkey = l_orderkey and o_orderpriority = '1-URGENT')
""",
)
block(
    "owned",
    ["mutations", "inodes", "users", "owner_groups"],
    """
select m.*, i.id is not null as inode_found, i.size, i.user_id, i.group_id,
  coalesce(u.name, '-1') as owner, coalesce(g.name, '-1') as owner_group
from mutations m
left join inodes i on i.parent_id = m.inode_parent_id and i.name = m.inode_name
  and i.partition_id = m.inode_partition_id and i.id = m.inode_id
left join users u on u.id = i.user_id
left join owner_groups g on g.id = i.group_id
where m.operation in (0, 2, 3)
""",
)
oracle(
    "enrich_owner",
    ["owned"],
    f"select {LOG_PK} as log_pk, inode_found, size, owner, owner_group from owned",
)
block(
    "resolved",
    ["inodes", "projects", "datasets", "mutations"],
    """
select ids.dataset_id, coalesce(d.name, '-1') as dataset_name,
  coalesce(case when d.name like '%\\_featurestore.db' escape '\\' then
      (select p.id from projects p where p.id = (select max(x.projectId) from datasets x
         where x.inode_name = d.name having count(*) = 1)
       and exists (select 1 from inodes q where q.parent_id = 2 and q.name = p.projectname))
    else (select p.id from inodes q join projects p on p.projectname = q.name
          where q.id = d.parent_id and q.parent_id = 2) end, -1) as project_id,
  coalesce(case when d.name like '%\\_featurestore.db' escape '\\' then
      (select p.projectname from projects p where p.id = (select max(x.projectId) from datasets x
         where x.inode_name = d.name having count(*) = 1)
       and exists (select 1 from inodes q where q.parent_id = 2 and q.name = p.projectname))
    else (select q.name from inodes q where q.id = d.parent_id and q.parent_id = 2) end, '-1')
    as project_name
from (select id as dataset_id from inodes union select dataset_id from mutations) ids
left join inodes d on d.id = ids.dataset_id
""",
)
oracle("resolve_project", ["resolved"], "select * from resolved")
oracle(
    "admin_target",
    ["admin_log", "datasets", "projects"],
    """
select a.id, d.projectId as dataset_project, d.public_ds, p.projectname as project_name
from admin_log a
left join datasets d on a.op_on = 0 and d.id = a.op_id
left join projects p on a.op_on = 1 and p.id = a.op_id
""",
)
block(
    "assembled",
    ["xattrs"],
    """
select inode_id, name, string_agg(value, '' order by part_no) filter (where part_no < np) as value,
  string_agg(value, '' order by part_no) as whole, np as num_parts,
  count(*) filter (where part_no < np) = np as complete
from (select *, first_value(num_parts) over (partition by inode_id, name order by part_no) as np
      from xattrs) x
group by inode_id, name, np
""",
)
oracle(
    "xattr_lookup",
    ["mutations", "assembled"],
    """
select m.logical_time, m.pk3 as xattr_name, a.value as xattr_value, a.inode_id is not null as
  xattr_found, a.complete as xattr_complete
from mutations m left join assembled a on a.inode_id = m.inode_id and a.name = m.pk3
where m.operation in (10, 12)
""",
)
oracle(
    "xattr_lookup_all",
    ["mutations", "assembled"],
    """
select m.logical_time, a.name as xattr_name, a.whole as xattr_value
from mutations m left join assembled a on a.inode_id = m.inode_id where m.operation = 11
""",
)
block(
    "buffered",
    ["xattr_buffer"],
    """
select inode_id, name, inode_logical_time, max(num_parts) as num_parts,
  case when count(*) = max(num_parts) then string_agg(value, '' order by part_no) end as value,
  string_agg(value, '' order by part_no) as stored
from xattr_buffer group by inode_id, name, inode_logical_time
""",
)
block(
    "cores",
    ["buffered"],
    """
select inode_id as ds, inode_logical_time as core_time, num_parts as core_parts, mode as core_mode,
  case when mode is not null then cast(json_extract_string(try_cast(value as json), '$.project_iid') as bigint) end
    as core_project
from (select *, case when upper(json_extract_string(try_cast(value as json), '$.prov_type.prov_status'))
    in ('NONE', 'STATE', 'ALL') then upper(json_extract_string(try_cast(value as json), '$.prov_type.prov_status'))
    end as mode
  from buffered where name = 'core') b
""",
)
oracle(
    "asof_mode",
    ["provenance", "cores"],
    """
select io_logical_time, core_time, core_mode, core_project
from provenance p asof left join cores c
  on p.dataset_i_id = c.ds and p.ds_logical_time >= c.core_time
""",
)
oracle(
    "buffered_value",
    ["provenance", "buffered"],
    """
select p.io_logical_time, p.i_xattr_name, b.value as buffer_value
from provenance p left join buffered b on b.inode_id = p.inode_id and b.name = p.i_xattr_name
  and b.inode_logical_time = p.io_logical_time
where p.inode_operation in ('XATTR_ADD', 'XATTR_UPDATE')
""",
)
SPLIT_4 = "len(string_split({0}, '_')) = 4 and starts_with({0}, 'application_')"
block(
    "classified",
    ["provenance"],
    f"""
select *,
  case ml_type when 'FEATURE' then i_name when 'TRAINING_DATASET' then i_name
    when 'EXPERIMENT' then i_name when 'MODEL' then i_parent_name || '_' || i_name
    when 'MODEL_PART' then i_p1_name || '_' || case when i_p2_name = '' then i_parent_name
      else i_p2_name end
    when 'FEATURE_PART' then case when i_p1_name = '' then i_parent_name else i_p1_name end
    when 'TRAINING_DATASET_PART' then case when i_p1_name = '' then i_parent_name
      else i_p1_name end
    when 'EXPERIMENT_PART' then case when i_p1_name = '' then i_parent_name else i_p1_name end
    else '' end as ml_id
from (
  select *, case
    when i_name = 'README.md' then 'NONE'
    when fs and top then 'FEATURE'
    when td and top then 'TRAINING_DATASET'
    when dataset_name = 'Experiments' and top and {SPLIT_4.format("i_name")} then 'EXPERIMENT'
    when dataset_name = 'Models' and below and i_p1_name <> '' and i_p2_name = '' then 'MODEL'
    when hive and dataset_i_id = parent_i_id then 'HIVE'
    when dataset_i_id = inode_id then 'DATASET'
    when fs and below then 'FEATURE_PART'
    when td and below then 'TRAINING_DATASET_PART'
    when dataset_name = 'Experiments' and below and {SPLIT_4.format("i_parent_name")}
      then 'EXPERIMENT_PART'
    when dataset_name = 'Models' and below and i_p1_name <> '' and i_p2_name <> ''
      then 'MODEL_PART'
    when hive and dataset_i_id <> parent_i_id then 'HIVE_PART'
    else 'NONE' end as ml_type
  from (
    select *, dataset_i_id <> inode_id and dataset_i_id = parent_i_id as top,
      dataset_i_id <> inode_id and dataset_i_id <> parent_i_id as below,
      project_i_id = -1 and dataset_name = lower(project_name) || '_featurestore.db'
        and i_p1_name not in ('code', 'storage_connector_resources') as fs,
      dataset_name = project_name || '_Training_Datasets'
        and i_p1_name not in ('code', 'transformation_functions', '.featureviews') as td,
      project_i_id = -1 and dataset_name = project_name || '.db' as hive
    from provenance) p) q
""",
)
block(
    "existing",
    ["provenance_inodes"],
    "select id, max(name) as name from provenance_inodes group by id having count(*) = 1",
)
block(
    "views",
    ["classified", "provenance_inodes"],
    """
select distinct i.id from provenance_inodes i join classified c on c.parent_i_id = i.parent_id
  and c.i_name = i.name and c.i_partition_id = i.partition_id
where c.ml_type <> 'NONE'
""",
)
oracle(
    "exists_filter",
    ["provenance", "existing", "views"],
    """
select io_logical_time, project_i_id in (select id from existing) as project_exists,
  inode_operation = 'DELETE' or inode_id in (select id from views) as kept
from provenance
""",
)

# --- values and scalars ----------------------------------------------------

oracle(
    "assemble_parts",
    ["assembled"],
    "select inode_id, name, value, cast(num_parts as int) as num_parts, complete from assembled",
)
oracle(
    "assemble_strict",
    ["buffered"],
    "select inode_id, name, inode_logical_time, value from buffered",
)
oracle("classify_asset", ["classified"], "select io_logical_time, ml_type, ml_id from classified")
oracle(
    "depth_tests",
    ["provenance"],
    """
select io_logical_time, d = i as is_dataset, i_name = 'README.md' as is_readme,
  d <> i and d = p as one_level, d <> i and d <> p as one_plus,
  d <> i and d <> p and i_p1_name <> '' and i_p2_name = '' as two_levels,
  d <> i and d <> p and i_p1_name <> '' and i_p2_name <> '' as two_plus
from (select *, dataset_i_id as d, inode_id as i, parent_i_id as p from provenance) x
""",
)
oracle(
    "mutation_codes",
    ["mutations"],
    f"""
select {LOG_PK} as log_pk,
  case operation when 0 then 'Add' when 1 then 'Delete' when 2 then 'Update' when 3 then 'Rename'
    when 4 then 'ChangeDataset' when 10 then 'XAttrAdd' when 11 then 'XAttrAddAll'
    when 12 then 'XAttrUpdate' when 13 then 'XAttrDelete' else 'Unkown' end as op_name,
  operation < 10 as is_inode_op, operation in (0, 2, 3) as needs_inode,
  operation >= 10 as is_xattr_op, operation in (10, 11, 12) as needs_xattr,
  cast((logical_time * 7) % 65536 - case when (logical_time * 7) % 65536 >= 32768 then 65536
    else 0 end as int) as wrapped_parts,
  cast(logical_time % 256 - case when logical_time % 256 >= 128 then 256 else 0 end as int)
    as wrapped_namespace,
  inode_id || '-5-' || pk3 as xattr_id
from mutations
""",
)
oracle(
    "admin_codes",
    ["admin_log"],
    """
select id, case op_on when 0 then 'Dataset' else 'Project' end as target,
  case op_type when 0 then 'Add' when 1 then 'Delete' when 2 then 'Update' else 'Unkown' end
    as op_name,
  case op_id when 0 then 'Add' when 1 then 'Delete' when 2 then 'Update' else 'Unkown' end
    as unknown_name
from admin_log
""",
)
oracle(
    "json_or_text",
    ["xattr_buffer"],
    """
select inode_id, name, inode_logical_time, json_valid(v) as is_json,
  case when json_valid(v) then try_cast(json_extract_string(v, '$.a') as bigint) end as a,
  case when not json_valid(v) then v end as text
from (
  select inode_id, name, inode_logical_time,
    coalesce(string_agg(value, '' order by part_no), '') as v
  from xattr_buffer group by inode_id, name, inode_logical_time) b
""",
)
READABLE = "strftime(make_timestamp({0} * 1000), '%Y.%b.%-d %-H:%-M:%-S')"
oracle(
    "readable_time",
    ["feed"],
    f"select event_id, {READABLE.format('ts_ms')} as readable from feed",
)
oracle(
    "document_ids",
    ["provenance"],
    f"""
select io_logical_time, {PROV_PK} as operation_id, cast(inode_id as varchar) as state_id,
  case when inode_id = dataset_i_id then 'ds' else 'inode' end as doc_type,
  project_i_id || '__file_prov' as index_name
from provenance
""",
)

# --- document operations ---------------------------------------------------

FIELDS = [
    ("doc_type", "varchar"),
    ("parent_id", "bigint"),
    ("partition_id", "bigint"),
    ("dataset_id", "bigint"),
    ("project_id", "int"),
    ("doc_name", "varchar"),
    ("doc_operation", "int"),
    ("doc_time", "bigint"),
    ("doc_size", "bigint"),
    ("owner", "varchar"),
    ("owner_group", "varchar"),
    ("description", "varchar"),
    ("public_ds", "boolean"),
]


def doc(**set_fields: str) -> str:
    """The document columns, null where not given."""
    return ", ".join(f"cast({set_fields.get(n, 'null')} as {t}) as {n}" for n, t in FIELDS)


FIELD_LIST = ", ".join(n for n, _ in FIELDS)
MUT_HEAD = f"""{LOG_PK} as log_pk, cast(inode_id as varchar) as doc_id, commit_epoch,
  inode_id as major, logical_time as minor, m.dataset_id as tie"""
MUT_HEAD = MUT_HEAD.replace("dataset_id || '-'", "m.dataset_id || '-'", 1).replace(
    "'-' || inode_id", "'-' || m.inode_id", 1
).replace("cast(inode_id", "cast(m.inode_id").replace("inode_id as major", "m.inode_id as major")
block(
    "mutation_ops",
    ["mutations", "owned", "resolved", "assembled"],
    f"""
select {MUT_HEAD}, 0 as op_no, 'DELETE' as kind, 'delete' as event_type,
  cast(null as varchar) as xattr_key, cast(null as varchar) as xattr_raw, {doc()}
from mutations m where operation = 1
union all
select {MUT_HEAD}, 0, 'UPSERT', 'update', null, null,
  {doc(dataset_id="m.dataset_id", doc_time="logical_time")}
from mutations m where operation = 4
union all
select {MUT_HEAD}, 0, 'MAP_REMOVE', 'delete', pk3, null, {doc()} from mutations m
where operation = 13
union all
select {MUT_HEAD}, 0, 'UPSERT', case when operation = 0 then 'add' else 'update' end, null, null,
  {doc(
      doc_type="case when inode_id = m.dataset_id then 'ds' else 'inode' end",
      parent_id="inode_parent_id", partition_id="inode_partition_id", dataset_id="m.dataset_id",
      project_id="r.project_id", doc_name="inode_name", doc_operation="operation",
      doc_time="logical_time", doc_size="size", owner="owner", owner_group="owner_group")}
from owned m join resolved r on r.dataset_id = m.dataset_id where inode_found
union all
select {MUT_HEAD}, 0, 'DELETE', 'delete', null, null, {doc()} from owned m where not inode_found
union all
select {MUT_HEAD}, case when operation = 12 then 1 else 0 end, 'UPSERT', 'update', m.pk3, a.value,
  {doc()}
from mutations m join assembled a on a.inode_id = m.inode_id and a.name = m.pk3 and a.complete
where operation in (10, 12)
union all
select {MUT_HEAD}, 0, 'MAP_REMOVE', 'update', m.pk3, null, {doc()}
from mutations m left join assembled a on a.inode_id = m.inode_id and a.name = m.pk3
where operation in (10, 12) and (a.name is null or (a.complete and operation = 12))
union all
select {MUT_HEAD}, cast(row_number() over (partition by m.dataset_id, m.inode_id, m.logical_time
    order by a.name) - 1 as int), case when a.name is null then 'MAP_CLEAR' else 'UPSERT' end, 'update',
  a.name, a.whole, {doc()}
from mutations m left join assembled a on a.inode_id = m.inode_id where operation = 11
""",
)
oracle(
    "dispatch_mutations",
    ["mutation_ops"],
    f"""
select log_pk, doc_id, op_no, kind, event_type, xattr_key, xattr_raw, {FIELD_LIST}
from mutation_ops
""",
)
block(
    "admin_ops",
    ["admin_log", "datasets", "projects"],
    f"""
select cast(a.id as varchar) as log_pk, cast(a.inode_id as varchar) as doc_id, a.commit_epoch,
  cast(-1 as bigint) as major, a.id as minor, cast(0 as bigint) as tie, 0 as op_no,
  'DELETE' as kind, 'delete' as event_type,
  case when op_on = 0 then 'datasets' else 'projects' end as asset_type, {doc()}
from admin_log a where op_type = 1
union all
select cast(a.id as varchar), cast(a.dataset_id as varchar), a.commit_epoch, -1, a.id, 0, 0,
  'UPSERT', case when op_type = 0 then 'add' else 'update' end, 'datasets',
  {doc(doc_type="'ds'", dataset_id="op_id", project_id="d.projectId",
       description="d.description", public_ds="d.public_ds")}
from admin_log a join datasets d on d.id = a.op_id where op_on = 0 and op_type <> 1
union all
select cast(a.id as varchar), cast(a.inode_id as varchar), a.commit_epoch, -1, a.id, 0, 0,
  'UPSERT', case when op_type = 0 then 'add' else 'update' end, 'projects',
  {doc(doc_type="'proj'", project_id="op_id", owner="p.username", doc_name="p.projectname",
       description="p.description")}
from admin_log a join projects p on p.id = a.op_id where op_on = 1 and op_type <> 1
""",
)
oracle(
    "dispatch_admin",
    ["admin_ops"],
    f"select log_pk, doc_id, kind, event_type, asset_type, {FIELD_LIST} from admin_ops",
)
block(
    "app_states",
    ["app_log"],
    """
select id, state as app_state, finish_time as state_time, name, user_name, commit_epoch, state,
  timestamp
from app_log where finish_time <> 0
union all
select id, 'RUNNING', start_time, name, user_name, commit_epoch, state, timestamp from app_log
union all
select id, 'SUBMITTED', submit_time, name, user_name, commit_epoch, state, timestamp from app_log
""",
)
oracle(
    "state_fanout",
    ["app_states"],
    f"""
select id || '-' || app_state || '-' || state_time as doc_id, 'UPSERT' as kind, id as app_id,
  app_state, state_time, {READABLE.format('state_time')} as readable, name as app_name,
  user_name as app_user
from app_states
""",
)
OWN_PHASE = PHASE.replace("inode_id = dataset_i_id", "c.inode_id = dataset_i_id")
block(
    "enriched",
    ["classified", "cores", "buffered", "existing", "views"],
    f"""
select y.*, coalesce(pid in (select id from existing), false) as project_exists,
  inode_operation = 'DELETE' or inode_id in (select id from views) as viewable,
  case when inode_operation not in ('CREATE', 'DELETE', 'ACCESS_DATA', 'MODIFY_DATA', 'XATTR_ADD',
      'XATTR_UPDATE', 'XATTR_DELETE', 'METADATA', 'OTHER') then 'unknown operation'
    when core_time is not null and core_mode is null then 'bad store mode'
    when sets and i_xattr_name = 'core' and own_value is not null and own_mode is null
      then 'bad store mode change' end as problem
from (
  select x.*, coalesce(own_mode, case when core_time is null then 'ALL' else core_mode end) as mode,
    case when own_mode is not null and pid1 = -1 then own_project else pid1 end as pid
  from (
    select c.*, {OWN_PHASE} as phase, k.core_time, k.core_parts, k.core_mode, k.core_project,
      inode_operation in ('XATTR_ADD', 'XATTR_UPDATE') as sets, b.value as own_value,
      case when i_xattr_name = 'core' and b.value is not null
        and upper(json_extract_string(try_cast(b.value as json), '$.prov_type.prov_status'))
          in ('NONE', 'STATE', 'ALL')
        then upper(json_extract_string(try_cast(b.value as json), '$.prov_type.prov_status')) end as own_mode,
      case when i_xattr_name = 'core' and b.value is not null
        and upper(json_extract_string(try_cast(b.value as json), '$.prov_type.prov_status'))
          in ('NONE', 'STATE', 'ALL')
        then cast(json_extract_string(try_cast(b.value as json), '$.project_iid') as bigint) end as own_project,
      case when k.core_time is not null then k.core_project else project_i_id end as pid1,
      case when k.core_time is not null and project_i_id = -1 and e.id is not null then e.name
        else project_name end as pname
    from classified c
    asof left join cores k on c.dataset_i_id = k.ds and c.ds_logical_time >= k.core_time
    left join buffered b on c.inode_operation in ('XATTR_ADD', 'XATTR_UPDATE')
      and b.inode_id = c.inode_id and b.name = c.i_xattr_name
      and b.inode_logical_time = c.io_logical_time
    left join existing e on e.id = k.core_project) x) y
""",
)
oracle(
    "enrich_provenance",
    ["enriched"],
    """
select io_logical_time, mode, pid as project_i_id, pname as project_name, project_exists, viewable
from enriched
""",
)
block(
    "rules",
    [],
    """
select * from (values
  ('CREATE', 'asset', 'STATE', 0, 'alive'), ('CREATE', 'asset', 'ALL', 0, 'alive'),
  ('CREATE', 'asset', 'ALL', 1, 'record'), ('CREATE', 'part', 'ALL', 0, 'record'),
  ('DELETE', 'asset', 'STATE', 0, 'dead'), ('DELETE', 'asset', 'ALL', 0, 'dead'),
  ('DELETE', 'asset', 'ALL', 1, 'record'), ('DELETE', 'part', 'ALL', 0, 'record'),
  ('ACCESS_DATA', 'asset', 'ALL', 0, 'record'), ('ACCESS_DATA', 'part', 'ALL', 0, 'record'),
  ('MODIFY_DATA', 'asset', 'ALL', 0, 'record'), ('MODIFY_DATA', 'part', 'ALL', 0, 'record'),
  ('XATTR_SET', 'asset', 'STATE', 0, 'project_id'), ('XATTR_SET', 'asset', 'ALL', 0, 'project_id'),
  ('XATTR_SET', 'asset', 'STATE', 1, 'xattr_reset'),
  ('XATTR_SET', 'asset', 'ALL', 1, 'xattr_reset'),
  ('XATTR_SET', 'asset', 'STATE', 2, 'xattr_set'), ('XATTR_SET', 'asset', 'ALL', 2, 'xattr_set'),
  ('XATTR_SET', 'asset', 'ALL', 3, 'xattr_record'), ('XATTR_SET', 'part', 'ALL', 0, 'record'),
  ('XATTR_DELETE', 'asset', 'STATE', 0, 'xattr_drop'),
  ('XATTR_DELETE', 'asset', 'ALL', 0, 'xattr_drop'),
  ('XATTR_DELETE', 'asset', 'ALL', 1, 'xattr_drop_record'),
  ('XATTR_DELETE', 'part', 'ALL', 0, 'record')
) r(op_class, asset_class, store_mode, step_no, step)
""",
)
block(
    "steps",
    ["enriched", "rules"],
    """
select e.*, r.step,
  r.step_no + case when sets and i_xattr_name = 'core' then 1 else 0 end as op_no
from enriched e join rules r
  on r.op_class = case when sets then 'XATTR_SET' else inode_operation end
  and r.store_mode = e.mode
  and r.asset_class = case when ml_type in ('DATASET', 'HIVE', 'FEATURE', 'TRAINING_DATASET',
    'EXPERIMENT', 'MODEL') then 'asset' when ml_type like '%PART' then 'part' end
where problem is null and viewable and project_exists and not (sets and own_value is null)
  and (r.step <> 'project_id' or i_xattr_name = 'project_iid')
union all
select e.*, case when mode = 'NONE' then 'dead' else 'alive' end, 0
from enriched e
where problem is null and viewable and project_exists and sets and own_value is not null
  and i_xattr_name = 'core'
""",
)
block(
    "provenance_ops",
    ["steps"],
    f"""
select {PROV_PK} || '-' || tb as log_pk, pid || '__file_prov' as index_name,
  case when step in ('record', 'xattr_record', 'xattr_drop_record') then {PROV_PK}
    else cast(inode_id as varchar) end as doc_id,
  op_no,
  case step when 'dead' then 'DELETE' when 'xattr_reset' then 'MAP_REMOVE'
    when 'xattr_drop' then 'MAP_REMOVE' else 'UPSERT' end as kind,
  case when step in ('xattr_reset', 'xattr_set', 'xattr_drop', 'xattr_record') then i_xattr_name
    end as xattr_key,
  case when step in ('xattr_set', 'xattr_record') then own_value end as xattr_raw,
  step <> 'xattr_drop' as create_if_absent,
  case when step = 'alive' then 'state' when step like '%record' then 'operation' end
    as entry_type,
  case when step = 'alive' or step like '%record' then ml_type end as ml_type,
  case when step = 'alive' or step like '%record' then ml_id end as ml_id,
  case when step = 'alive' or step like '%record' or step = 'project_id' then pid end
    as project_i_id,
  case when step = 'alive' or step like '%record' then pname end as project_name,
  case when step = 'xattr_drop_record' then i_xattr_name end as xattr_prov_key,
  case when step like '%record' then {READABLE.format('io_timestamp')} end as r_timestamp,
  case when step = 'alive' then {READABLE.format('io_timestamp')} end as r_create_timestamp,
  case when step = 'alive' or step like '%record' then inode_id end as f_inode_id,
  case when step like '%record' then inode_operation end as f_operation,
  case when step like '%record' then io_timestamp end as op_time,
  case when step = 'alive' then io_timestamp end as create_time,
  row_number() over (order by commit_epoch, dataset_i_id, ds_logical_time, phase, inode_id,
    io_logical_time, tb, op_no) as sq
from steps
""",
)
oracle(
    "route_ops",
    ["provenance_ops"],
    """
select log_pk, index_name, doc_id, op_no, kind, xattr_key, xattr_raw, create_if_absent, entry_type,
  ml_type, ml_id, project_i_id, project_name, xattr_prov_key, r_timestamp, r_create_timestamp
from provenance_ops
""",
)
oracle(
    "quarantine",
    ["enriched"],
    "select io_logical_time, inode_operation, problem from enriched where problem is not null",
)

# --- materialisation -------------------------------------------------------


def folded(ops: str, key: str, columns: list[str]) -> str:
    """Latest value per field after the last DELETE, for documents still alive."""
    picked = ", ".join(
        f"arg_max({c}, sq) filter (where kind = 'UPSERT' and {c} is not null) as {c}"
        for c in columns
    )
    return f"""
select {key}, {picked}
from (select *, max(case when kind = 'DELETE' then sq end) over (partition by {key}) as dead_at
      from {ops}) o
where dead_at is null or sq > dead_at
group by {key}
having count(*) filter (where kind = 'UPSERT' or create_if_absent) > 0
"""


def folded_map(ops: str, key: str) -> str:
    """Latest set per map key that no removal, clear or DELETE follows."""
    return f"""
select {key}, xattr_key, xattr_raw
from (
  select *, max(case when kind in ('DELETE', 'MAP_CLEAR') then sq end) over (partition by {key})
      as reset_at,
    row_number() over (partition by {key}, xattr_key order by sq desc, xattr_raw desc) as newest
  from {ops}) o
where xattr_key is not null and newest = 1 and kind = 'UPSERT'
  and (reset_at is null or sq > reset_at)
"""


block(
    "search_ops",
    ["mutation_ops", "admin_ops"],
    f"""
select *, true as create_if_absent,
  dense_rank() over (order by commit_epoch, major, minor, tie, op_no) as sq
from (
  select doc_id, commit_epoch, major, minor, tie, op_no, kind, xattr_key, xattr_raw, {FIELD_LIST}
  from mutation_ops
  union all
  select doc_id, commit_epoch, major, minor, tie, op_no, kind, null, null, {FIELD_LIST}
  from admin_ops) o
""",
)
oracle("fold_documents", ["search_ops"], folded("search_ops", "doc_id", [n for n, _ in FIELDS]))
oracle("fold_map", ["search_ops"], folded_map("search_ops", "doc_id"))
block(
    "provenance_docs",
    ["provenance_ops"],
    folded(
        "provenance_ops",
        "index_name, doc_id",
        [
            "entry_type",
            "f_inode_id",
            "f_operation",
            "op_time",
            "create_time",
            "project_i_id",
            "project_name",
            "ml_type",
            "ml_id",
            "xattr_prov_key",
        ],
    ),
)
oracle(
    "fold_provenance",
    ["provenance_docs"],
    """
select index_name, doc_id, entry_type, f_inode_id as inode_id, f_operation as inode_operation,
  op_time, create_time, project_i_id, project_name, ml_type, ml_id, xattr_prov_key
from provenance_docs
""",
)
oracle(
    "fold_provenance_map",
    ["provenance_ops"],
    "select *, json_valid(xattr_raw) as is_json from ("
    + folded_map("provenance_ops", "index_name, doc_id")
    + ") m",
)


def leaves(values: str, key: str) -> str:
    """One row per leaf, and per empty object, of the JSON values `v`."""
    return f"""
select {key}, xattr_key, t.fullkey as path, cast(t.value as varchar) as leaf
from ({values}) f, json_tree(f.v) t
where t.type <> 'OBJECT' or cast(t.value as varchar) = '{{}}'
"""


MERGED = """
select doc_id, xattr_key, list_reduce(list(v order by io_logical_time), lambda x, y: json_merge_patch(x, y)) as v
from (
  select *, max(case when what = 'reset' then io_logical_time end) over (partition by doc_id) as reset_at,
    max(case when what = 'remove' then io_logical_time end) over (partition by doc_id, xattr_key) as removed_at
  from (
    select cast(dataset_i_id as varchar) as doc_id, 'x' || cast(k % 2 as varchar) as xattr_key, io_logical_time,
      case when event_type in ('purchase', 'view', 'click') then 'set'
        when event_type = 'signup' and k % 4 in (0, 1) then 'reset' else 'remove' end as what,
      case k % 6
        when 0 then '{"a": {"b": ' || k || ', "c": "x' || k || '"}, "d": true}'
        when 1 then '{"a": {"e": ' || k || '}, "n": {}}'
        when 2 then '{"a": ' || k || '}'
        when 3 then '"text-' || k || '"'
        when 4 then '{"a": {"b": {"f": ' || k || '}}, "n": {"m": 1.5}}'
        else '"' || k || '"' end::json as v
    from provenance) o) r
where what = 'set' and (reset_at is null or io_logical_time > reset_at)
  and (removed_at is null or io_logical_time > removed_at)
group by doc_id, xattr_key
"""
oracle("fold_map_nested", ["provenance"], leaves(MERGED, "doc_id"))
oracle(
    "fold_provenance_nested",
    ["provenance_ops"],
    leaves(
        "select m.*, case when json_valid(xattr_raw) then xattr_raw::json else to_json(xattr_raw) end as v from ("
        + folded_map("provenance_ops", "index_name, doc_id")
        + """) m where json_valid(xattr_raw) or (index_name, doc_id) not in
          (select (index_name, doc_id) from provenance_ops where entry_type = 'operation')""",
        "index_name, doc_id",
    ),
)
oracle(
    "fold_apps",
    ["app_states"],
    f"""
select id || '-' || app_state || '-' || state_time as doc_id, id as app_id, app_state, state_time,
  arg_max(name, struct_pack(a := commit_epoch, b := state, c := timestamp)) as app_name,
  arg_max(user_name, struct_pack(a := commit_epoch, b := state, c := timestamp)) as app_owner,
  {READABLE.format('state_time')} as readable
from app_states group by id, app_state, state_time
""",
)
oracle(
    "index_routing",
    ["provenance_docs"],
    "select index_name, entry_type, count(*) as documents from provenance_docs group by all",
)
oracle(
    "response_outcomes",
    ["feed"],
    """
select event_id, event_type <> 'error' as success, event_type = 'error' and k % 10 = 0 as retryable,
  cast(case when event_type <> 'error' or k % 10 in (0, 1) then 0
    when k % 10 in (2, 3) then 1 else 2 end as int) as failed_items
from feed
""",
)
oracle(
    "response_errors",
    ["feed"],
    """
select error, count(*) as n from (
  select 'overloaded' as error from feed where event_type = 'error' and k % 10 = 2
  union all
  select 'parse_exception:line ' || k from feed where event_type = 'error' and k % 10 = 3
  union all
  select 'document_missing_exception:missing ' || k % 5 from feed
  where event_type = 'error' and k % 10 > 3
  union all
  select 'timeout' from feed where event_type = 'error' and k % 10 > 3) e
group by error
""",
)

# --- rebuild ---------------------------------------------------------------

block(
    "roots",
    ["projects", "datasets", "inodes"],
    """
select d.id, d.inode_name, d.projectId, d.description, d.public_ds, di.id as dataset_inode
from datasets d
left join projects p on p.id = d.projectId
left join inodes pi on pi.parent_id = 2 and pi.partition_id = 2 and pi.name = p.projectname
left join inodes di on di.parent_id = pi.id and di.partition_id = pi.id and di.name = d.inode_name
""",
)
TREE = """
tree as (
  select i.*, r.dataset_inode as dataset_id, r.projectId as project_id
  from inodes i join roots r on i.parent_id = r.dataset_inode and i.partition_id = i.parent_id
  union all
  select i.*, t.dataset_id, t.project_id from inodes i join tree t on i.parent_id = t.id
  where t.is_dir and i.partition_id = i.parent_id
)
"""
oracle(
    "rebuild_tree",
    ["inodes", "roots"],
    "select id as inode_id, dataset_id, project_id from tree",
    TREE,
)
oracle(
    "rebuild_documents",
    ["inodes", "roots", "projects", "users", "owner_groups"],
    f"""
select cast(i.id as varchar) as doc_id, {doc(doc_type="'proj'", project_id="p.id",
  doc_name="p.projectname", owner="p.username", description="p.description")}
from projects p join inodes i on i.parent_id = 2 and i.name = p.projectname
union all
select cast(dataset_inode as varchar), {doc(doc_type="'ds'", dataset_id="id",
  project_id="projectId", description="description", public_ds="public_ds")}
from roots where dataset_inode is not null
union all
select cast(t.id as varchar), {doc(doc_type="'inode'", parent_id="t.parent_id",
  partition_id="t.partition_id", dataset_id="t.dataset_id", project_id="t.project_id",
  doc_name="t.name", doc_time="t.logical_time", doc_size="t.size",
  owner="coalesce(u.name, '-1')", owner_group="coalesce(g.name, '-1')")}
from tree t left join users u on u.id = t.user_id left join owner_groups g on g.id = t.group_id
""",
    TREE,
)
oracle(
    "rebuild_xattrs",
    ["inodes", "roots", "assembled"],
    """
select a.inode_id, a.name, a.whole as value from assembled a
join tree t on t.id = a.inode_id and (t.num_user_xattrs > 0 or t.num_sys_xattrs > 0)
""",
    TREE,
)
oracle(
    "rebuild_counts",
    ["inodes", "roots"],
    """
select r.dataset_inode as dataset_id, r.inode_name as dataset_name, count(t.id) as inodes
from roots r left join tree t on t.dataset_id = r.dataset_inode
where r.dataset_inode is not null group by r.dataset_inode, r.inode_name
""",
    TREE,
)
oracle(
    "rebuild_stats",
    ["inodes", "roots", "projects", "assembled"],
    """
select *, projects - missing_projects + datasets + inodes as documents from (
  select (select count(*) from projects) as projects,
    (select count(*) from projects p where not exists (select 1 from inodes i
       where i.parent_id = 2 and i.name = p.projectname)) as missing_projects,
    (select count(distinct dataset_inode) from roots) as datasets,
    (select count(*) from roots where dataset_inode is null) as missing_datasets,
    (select count(*) from tree) as inodes,
    (select count(*) from assembled a join tree t on t.id = a.inode_id and t.num_user_xattrs > 0)
      as xattrs,
    (select count(*) from tree t where t.num_user_xattrs > 0
       and not exists (select 1 from assembled a where a.inode_id = t.id)) as missing_xattrs,
    (select count(*) from inodes i where is_dir and partition_id = parent_id
       and id not in (select dataset_inode from roots where dataset_inode is not null)
       and id not in (select id from reached)) as cyclic_directories) s
""",
    TREE
    + """,
reached as (
  select id from inodes where is_dir and partition_id = parent_id
    and (parent_id not in (select id from inodes where is_dir and partition_id = parent_id)
      or parent_id in (select dataset_inode from roots where dataset_inode is not null))
  union
  select i.id from inodes i join reached r on i.parent_id = r.id
  where is_dir and partition_id = parent_id
)""",
)

# --- cascade ---------------------------------------------------------------

block("gone_nation", [], "select * from nation where n_regionkey in "
      "(select r_regionkey from region where r_name = 'AFRICA')")
block("gone_customer", ["gone_nation"],
      "select * from customer where c_nationkey in (select n_nationkey from gone_nation)")
block("gone_orders", ["gone_customer"],
      "select * from orders where o_custkey in (select c_custkey from gone_customer)")
oracle(
    "cascade_simple",
    ["gone_nation", "gone_customer", "gone_orders"],
    """
select 'nation' as table_name, cast(n_nationkey as varchar) as deleted_key from gone_nation
union all
select 'customer', cast(c_custkey as varchar) from gone_customer
union all
select 'supplier', cast(s_suppkey as varchar) from supplier
where s_nationkey in (select n_nationkey from gone_nation)
union all
select 'orders', cast(o_orderkey as varchar) from gone_orders
""",
)
oracle(
    "cascade_shared",
    [],
    """
select 'customer' as table_name, cast(c_custkey as varchar) as deleted_key from customer
where exists (select 1 from orders where o_custkey = c_custkey)
  and not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
""",
)
block("fp_supplier", [], "select s_suppkey from supplier join nation on n_nationkey = s_nationkey "
      "where n_regionkey <> 4")
block("fp_lines", ["fp_supplier"],
      "select * from lineitem where l_suppkey in (select s_suppkey from fp_supplier)")
block("fp_lines_left", ["fp_supplier"],
      "select * from lineitem where l_suppkey not in (select s_suppkey from fp_supplier)")
block(
    "fp_orders",
    ["fp_lines", "fp_lines_left"],
    """
select * from orders where o_orderkey in (select l_orderkey from fp_lines)
  and o_orderkey not in (select l_orderkey from fp_lines_left)
""",
)
block(
    "fp_customer",
    ["fp_orders"],
    """
select c_custkey from customer where c_custkey in (select o_custkey from fp_orders)
  and not exists (select 1 from orders o where o_custkey = c_custkey
    and o_orderkey not in (select o_orderkey from fp_orders))
""",
)
oracle(
    "cascade_fixpoint",
    ["fp_supplier", "fp_lines", "fp_lines_left", "fp_orders", "fp_customer"],
    """
select 'supplier' as table_name, cast(s_suppkey as varchar) as deleted_key from fp_supplier
union all
select 'orders', cast(o_orderkey as varchar) from fp_orders
union all
select 'customer', cast(c_custkey as varchar) from fp_customer
union all
select 'part', cast(p_partkey as varchar) from part
where p_partkey in (select l_partkey from fp_lines)
  and p_partkey not in (select l_partkey from fp_lines_left)
""",
)
oracle(
    "cascade_survivors",
    ["gone_nation", "gone_customer", "gone_orders"],
    """
select (select count(*) from region where r_name <> 'AFRICA') as n, 'region' as table_name
union all
select (select count(*) from nation) - (select count(*) from gone_nation), 'nation'
union all
select (select count(*) from customer) - (select count(*) from gone_customer), 'customer'
union all
select (select count(*) from orders) - (select count(*) from gone_orders), 'orders'
union all
select (select count(*) from lineitem where l_orderkey not in
  (select o_orderkey from gone_orders)), 'lineitem'
""",
)



def catalog_sql(rounds: int) -> str:
    """The catalog cascade, all tables round by round: what goes grows to a fixpoint."""
    parts = [f"{n} as (" + " union all ".join(f"select {c} from {s}" for s, c in CATALOG[n]) + ")" for n in CATALOG]
    for name, (source, columns, which) in DELETED.items():
        parts.append(f"{name}_0 as materialized (select {columns} from {source} where {which})")
    have = {name: f"{name}_0" for name in DELETED}
    for i in range(1, rounds + 1):
        now = {}
        for name in CATALOG:
            tests = []
            for r in CATALOG_RULES:
                if r.target != name or r.table not in have:
                    continue
                target = " and ".join(f"g.{a} = t.{b}" for a, b in zip(r.columns, r.target_columns))
                test = f"exists (select 1 from {have[r.table]} g where {target})"
                if r.shared:
                    key = " and ".join(f"u.{k} = x.{k}" for k in CATALOG_KEYS[r.table])
                    used = " and ".join(f"u.{a} = t.{b}" for a, b in zip(r.columns, r.target_columns))
                    test += f" and not exists (select 1 from (select * from {r.table} u where not exists "
                    test += f"(select 1 from {have[r.table]} x where {key})) u where {used})"
                tests.append(f"({test})")
            before = f"select * from {have[name]}" if name in have else None
            found = f"select * from {name} t where {' or '.join(tests)}" if tests else None
            if before or found:
                both = " union ".join(q for q in (before, found) if q)
                parts.append(f"{name}_{i} as materialized ({both})")
                now[name] = f"{name}_{i}"
        have |= now
    out = " union all ".join(
        f"select distinct '{n}' as table_name, concat_ws('-', {', '.join(f'cast({k} as varchar)' for k in CATALOG_KEYS[n])}) "
        f"as deleted_key from {have[n]}"
        for n in CATALOG
        if n in have
    )
    return f"with {', '.join(parts)} {out}"


ORACLES["cascade_catalog"] = catalog_sql(9)

# --- retention -------------------------------------------------------------

block(
    "acked",
    ["enriched"],
    """
select io_logical_time,
  case when inode_operation = 'DELETE' and inode_id = dataset_i_id then
      case when core_time is not null then dataset_i_id end
    when sets and i_xattr_name = 'core' then
      case when core_time < io_logical_time then dataset_i_id end
    when sets or inode_operation = 'XATTR_DELETE' then inode_id end as companion_inode,
  case when inode_operation = 'DELETE' and inode_id = dataset_i_id then
      case when core_time is not null then 'core' end
    when sets and i_xattr_name = 'core' then
      case when core_time < io_logical_time then 'core' end
    when sets or inode_operation = 'XATTR_DELETE' then i_xattr_name end as companion_name,
  case when inode_operation = 'DELETE' and inode_id = dataset_i_id then core_time
    when sets and i_xattr_name = 'core' then
      case when core_time < io_logical_time then core_time end
    when sets or inode_operation = 'XATTR_DELETE' then io_logical_time end as companion_time,
  cast(case when inode_operation = 'DELETE' and inode_id = dataset_i_id then core_parts
    when sets and i_xattr_name = 'core' then
      case when core_time < io_logical_time then core_parts end
    when sets or inode_operation = 'XATTR_DELETE' then i_xattr_num_parts end as smallint)
    as companion_parts
from enriched where problem is null
""",
)
oracle("retention_keys", ["acked"], "select * from acked")
oracle(
    "retention_log",
    ["enriched"],
    "select io_logical_time, inode_operation from enriched where problem is not null",
)
oracle(
    "retention_buffer",
    ["xattr_buffer", "acked"],
    """
select inode_id, name, inode_logical_time, part_no, value from xattr_buffer b
where not exists (select 1 from acked a where a.companion_inode = b.inode_id
  and a.companion_name = b.name and a.companion_time = b.inode_logical_time
  and b.part_no < a.companion_parts)
""",
)

# --- metrics ---------------------------------------------------------------

block(
    "bulks",
    ["changes"],
    """
select bulk_id, max(flush_id) as flush_id, count(*) as events, min(arrival_ms) as first_ms,
  max(arrival_ms) as last_ms, max(start_ms) as start_ms, max(end_ms) as end_ms,
  max(request_ms) as request_ms, max(done_ms) as done_ms, sum(done_ms - arrival_ms) as event_ms,
  count(*) filter (where event_type in ('add', 'update') and asset_type = 'inodes') as a1,
  count(*) filter (where event_type in ('add', 'update') and asset_type = 'datasets') as a2,
  count(*) filter (where event_type in ('add', 'update') and asset_type = 'projects') as a3,
  count(*) filter (where event_type = 'delete' and asset_type = 'inodes') as d1,
  count(*) filter (where event_type = 'delete' and asset_type = 'datasets') as d2,
  count(*) filter (where event_type = 'delete' and asset_type = 'projects') as d3
from changes group by bulk_id
""",
)
oracle(
    "metrics_bulks",
    ["bulks"],
    """
select bulk_id, events, last_ms - first_ms as batching_ms, start_ms - last_ms as waiting_ms,
  end_ms - start_ms as processing_ms, done_ms - end_ms as sink_wait_ms,
  done_ms - first_ms as total_ms
from bulks
""",
)
oracle(
    "metrics_log_types",
    ["changes"],
    "select bulk_id, log_type, count(*) as n from changes group by bulk_id, log_type",
)


def scope(name: str, start: str) -> str:
    return f"""
select '{name}' as scope, w.window_start_ms, num_processed_batches, num_processed_events,
  num_added_inodes, num_added_datasets, num_added_projects, num_deleted_inodes,
  num_deleted_datasets, num_deleted_projects, avg_batching_time_milliseconds,
  avg_waiting_time_before_processing_milliseconds, avg_ndb_processing_time_milliseconds,
  avg_elastic_bulk_req_time_milliseconds, avg_elastic_batching_time_milliseconds,
  avg_total_time_per_batch_milliseconds, avg_total_time_per_event_milliseconds
from (
  select {start} as window_start_ms, count(*) as num_processed_batches,
    cast(sum(events) as bigint) as num_processed_events,
    cast(sum(a1) as bigint) as num_added_inodes, cast(sum(a2) as bigint) as num_added_datasets,
    cast(sum(a3) as bigint) as num_added_projects, cast(sum(d1) as bigint) as num_deleted_inodes,
    cast(sum(d2) as bigint) as num_deleted_datasets,
    cast(sum(d3) as bigint) as num_deleted_projects,
    avg(last_ms - first_ms) as avg_batching_time_milliseconds,
    avg(start_ms - last_ms) as avg_waiting_time_before_processing_milliseconds,
    avg(end_ms - start_ms) as avg_ndb_processing_time_milliseconds,
    avg(done_ms - end_ms) as avg_elastic_batching_time_milliseconds,
    avg(done_ms - first_ms) as avg_total_time_per_batch_milliseconds,
    sum(event_ms) / sum(events) as avg_total_time_per_event_milliseconds
  from bulks group by 1) w
join (
  select window_start_ms, avg(took) as avg_elastic_bulk_req_time_milliseconds
  from (select {start} as window_start_ms, flush_id, max(done_ms) - min(request_ms) as took
        from bulks group by 1, 2) f
  group by 1) r on r.window_start_ms = w.window_start_ms
"""


MEAN_COLUMNS = [
    "avg_batching_time_milliseconds",
    "avg_waiting_time_before_processing_milliseconds",
    "avg_ndb_processing_time_milliseconds",
    "avg_elastic_bulk_req_time_milliseconds",
    "avg_elastic_batching_time_milliseconds",
    "avg_total_time_per_batch_milliseconds",
    "avg_total_time_per_event_milliseconds",
]
COUNT_COLUMNS = [
    "num_processed_batches",
    "num_processed_events",
    "num_added_inodes",
    "num_added_datasets",
    "num_added_projects",
    "num_deleted_inodes",
    "num_deleted_datasets",
    "num_deleted_projects",
]
SCOPE_STARTS = {
    "metrics_minute": ("last_minute", "done_ms // 60000 * 60000"),
    "metrics_hour": ("last_hour", "done_ms // 3600000 * 3600000"),
    "metrics_all": ("all_time", "cast(0 as bigint)"),
}
for query_name, (scope_name, start_text) in SCOPE_STARTS.items():
    rounded = ", ".join(f"round({c}, 4) as {c}" for c in MEAN_COLUMNS)
    oracle(query_name, ["bulks"], f"select * replace ({rounded}) from ({scope(scope_name, start_text)}) s")
oracle(
    "metrics_throughput",
    ["bulks"],
    """
select flush_id, cast(sum(events) as bigint) as events, count(*) as bulks,
  max(done_ms) - min(first_ms) as total_ms,
  round(sum(events) * 1000.0 / (max(done_ms) - min(first_ms)), 6) as events_per_second
from bulks group by flush_id
""",
)
TEXT_ROWS = " union all ".join(
    [
        f"""select window_start_ms, 'feed_{c}{{scope="last_hour"}} ' || {c} as line from s
where {c} > 0"""
        for c in COUNT_COLUMNS
    ]
    + [
        f"""select window_start_ms, 'feed_{c}{{scope="last_hour"}} ' ||
  printf('%g', cast({c} as double)) from s"""
        for c in MEAN_COLUMNS
    ]
)
oracle(
    "metrics_text",
    ["bulks"],
    f"select * from (with s as ({scope(*SCOPE_STARTS['metrics_hour'])}) {TEXT_ROWS}) lines",
)

# --- streaming -------------------------------------------------------------

block(
    "stream_ops",
    ["mutation_ops"],
    """
select *, true as create_if_absent,
  dense_rank() over (order by commit_epoch, major, minor, tie, op_no) as sq
from mutation_ops
""",
)
oracle("stream_replay", ["stream_ops"], folded("stream_ops", "doc_id", [n for n, _ in FIELDS]))
block(
    "admin_only",
    ["admin_ops"],
    f"""
select *, true as create_if_absent,
  dense_rank() over (order by commit_epoch, major, minor, tie, op_no) as sq
from (select doc_id, commit_epoch, major, minor, tie, op_no, kind, null as xattr_key,
    null as xattr_raw, {FIELD_LIST} from admin_ops) o
""",
)
oracle("stream_admin", ["admin_only"], folded("admin_only", "doc_id", [n for n, _ in FIELDS]))
for streamed, whole in (
    ("stream_apps", "fold_apps"),
    ("stream_provenance", "fold_provenance"),
    ("stream_quarantine", "quarantine"),
    ("stream_retention", "retention_buffer"),
    ("stream_retention_log", "retention_log"),
    ("stream_bootstrap", "bootstrap_dedup"),
    ("stream_metrics", "metrics_minute"),
    ("stream_metrics_hour", "metrics_hour"),
):
    ORACLES[streamed] = ORACLES[whole]
oracle(
    "xattr_incomplete",
    ["mutations", "assembled"],
    f"""
select {LOG_PK.replace("dataset_id", "m.dataset_id").replace("inode_id", "m.inode_id")} as log_pk,
  logical_time, pk3 as xattr_name
from mutations m join assembled a on a.inode_id = m.inode_id and a.name = m.pk3
where operation in (10, 12) and not a.complete
""",
)
oracle(
    "lookup_skewed",
    [],
    """
select l_orderkey, l_linenumber, k as s_suppkey, s_name, s_nationkey
from (select *, case when l_linenumber <= 2 then 1 else l_suppkey end as k from lineitem) l
left join supplier on s_suppkey = k
""",
)
for rows, uses, names in (
    (
        "mutations",
        "mutations",
        "dataset_id, inode_id, logical_time, pk1, pk2, pk3, operation, inode_partition_id, inode_parent_id, inode_name",
    ),
    ("admin", "admin_log", "id, op_id, op_on, op_type, op_id as project_id, dataset_id, inode_id"),
    (
        "provenance",
        "provenance",
        "inode_id, inode_operation, io_logical_time, io_timestamp, io_app_id, io_user_id, tb, i_partition_id, "
        "project_i_id, dataset_i_id, parent_i_id, i_name, project_name, dataset_name, i_p1_name, i_p2_name, "
        "i_parent_name, i_user_name, i_xattr_name, io_logical_time_batch, io_timestamp_batch, ds_logical_time, "
        "i_xattr_num_parts",
    ),
    (
        "apps",
        "app_log",
        "id, state, timestamp as changed_ms, name as app_name, user_name, submit_time, start_time, finish_time",
    ),
):
    oracle(f"feed_rows_{rows}", [uses], f"select commit_epoch, {names} from {uses}")
oracle(
    "feed_deleted_rows",
    [],
    """
select p_partkey as commit_epoch, p_partkey as PART_ID, p_partkey * 2 as SD_ID,
  cast(p_size as bigint) as TBL_ID, p_name as PART_NAME
from part where p_size > 25
""",
)
