"""The operators' input tables, derived from the benchmark's star schema.

Each table is one SELECT over the given tables, written so that Spark and a
plain SQL engine read it alike; the few differences are the dialect tokens.
Every derivation covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure, materialize

SOURCES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

SPARK = {
    "$K": "cast(get_json_object(props, '$.k') as bigint)",
    "$DIV": "div",
    "$TS_MS": "unix_millis(cast(ts as timestamp))",
    "$ORDER_MS": "unix_millis(cast(o_orderdate as timestamp))",
    "$PARTS": "lateral view explode(sequence(0, greatest(cast(num_parts as int), 1) - 1)) t as i",
}
PLAIN = {
    "$K": "cast(json_extract_string(props, '$.k') as bigint)",
    "$DIV": "//",
    "$TS_MS": "epoch_us(ts) // 1000",
    "$ORDER_MS": "epoch_us(o_orderdate) // 1000",
    "$PARTS": "cross join lateral (select unnest(range(0, greatest(cast(num_parts as integer), 1))) as i) t",
}

# Directory a customer stands for: the first ones lie in a nation's directory,
# the others below the customer with half their number.
CUSTOMER_PARENT = (
    "case when c_custkey < 25 then cast(1000 + c_nationkey as bigint) "
    "else 1000000 + c_custkey $DIV 2 end"
)

FEED = """
select event_id, cast(user_id as bigint) as user_id, event_type, $TS_MS as ts_ms, $K as k,
  event_id $DIV 100 as commit_epoch,
  (event_id $DIV 1000) * 4294967296 + event_id as wide_epoch
from @events
"""

MUTATIONS = """
select cast(case user_id % 3 when 0 then 1000 + user_id % 25 when 1 then 2000 + user_id % 25
    else 9999 end as bigint) as dataset_id,
  1000000 + user_id as inode_id, event_id as logical_time,
  cast(1 as bigint) as pk1, cast(5 as bigint) as pk2, 'k' || cast(k % 7 as varchar(10)) as pk3,
  cast(case event_type
    when 'signup' then 0
    when 'view' then 2
    when 'click' then case when k % 2 = 0 then 3 else 4 end
    when 'purchase' then case k % 4 when 0 then 10 when 1 then 12 when 2 then 13 else 11 end
    else 1 end as tinyint) as operation,
  parent as inode_partition_id, parent as inode_parent_id,
  c_name || case when k % 10 = 3 then '.old' else '' end as inode_name,
  commit_epoch, ts_ms
from (@feed) f
join (select c_custkey, c_name, """ + CUSTOMER_PARENT + """ as parent from @customer) c
  on f.user_id = c.c_custkey
"""

INODES = """
select cast(1 as bigint) as parent_id, 'Projects' as name, cast(1 as bigint) as partition_id,
  cast(2 as bigint) as id, cast(0 as bigint) as size, 0 as user_id, 0 as group_id,
  cast(0 as bigint) as logical_time, true as is_dir,
  cast(0 as tinyint) as num_user_xattrs, cast(0 as tinyint) as num_sys_xattrs
from @region where r_regionkey = 0
union all
select 2, r_name, 2, 100 + r_regionkey, 0, 0, 0, 0, true, 0, 0 from @region
union all
select 100 + n_regionkey, n_name, 100 + n_regionkey, 1000 + n_nationkey, 0, n_nationkey, 0, 0,
  true, 0, 0 from @nation
union all
select 500, lower(n_name) || '_featurestore.db', 500, 2000 + n_nationkey, 0, n_nationkey, 0, 0,
  true, 0, 0 from @nation
union all
select """ + CUSTOMER_PARENT + """, c_name, """ + CUSTOMER_PARENT + """, 1000000 + c_custkey,
  cast(floor(abs(c_acctbal)) as bigint), c_nationkey, cast(c_custkey % 7 as int),
  c_custkey % 1000, true, case when c_custkey % 3 = 0 then 1 else 0 end, 0 from @customer
union all
select 1000000 + o_custkey, 'order-' || cast(o_orderkey as varchar(20)), 1000000 + o_custkey,
  1000000000 + o_orderkey, cast(floor(o_totalprice) as bigint), cast(o_orderkey % 30 as int),
  cast(o_orderkey % 7 as int), o_orderkey % 1000, false, 0, 0 from @orders
"""

USERS = "select n_nationkey as id, n_name as name from @nation where n_regionkey <> 4"
GROUPS = "select r_regionkey as id, r_name as name from @region"

PROJECTS = """
select r_regionkey as id, r_name as projectname,
  'owner-' || cast(r_regionkey as varchar(10)) as username, 'about ' || r_name as description
from @region
union all
select 100 + n_nationkey, n_name, 'owner-' || cast(n_regionkey as varchar(10)), 'about ' || n_name
from @nation
"""

DATASETS = """
select n_nationkey as id, n_name as inode_name, n_regionkey as projectId,
  'data of ' || n_name as description, n_nationkey % 2 = 0 as public_ds,
  cast(n_nationkey % 2 as tinyint) as searchable
from @nation
union all
select 200 + n_nationkey, lower(n_name) || '_featurestore.db', n_regionkey, 'features', false, 0
from @nation
union all
select 300 + n_nationkey, lower(n_name) || '_featurestore.db', n_regionkey, 'features', false, 0
from @nation where n_regionkey = 3
union all
select cast(1000 + s_suppkey as int), s_name, s_nationkey % 5, 'data of ' || s_name, true, 1
from @supplier
"""

XATTRS = """
select 1000000 + conv_id $DIV 4 as inode_id, cast(5 as tinyint) as namespace,
  'k' || cast(conv_id % 7 as varchar(10)) as name, cast(turn as smallint) as part_no,
  text as value, cast(4 + conv_id % 5 as smallint) as num_parts
from @conversations
"""

ADMIN_LOG = """
select o_orderkey as id, o_orderkey $DIV 50 as commit_epoch, op_on, op_type, op_id,
  cast(1000 + op_id as bigint) as dataset_id,
  cast(case when op_on = 0 then 1000 + op_id else 100 + op_id end as bigint) as inode_id
from (
  select o_orderkey, cast(o_orderkey % 2 as tinyint) as op_on,
    cast(o_orderkey % 3 as tinyint) as op_type,
    cast(case when o_orderkey % 2 = 0 then o_custkey % 40 else o_custkey % 8 end as int) as op_id
  from @orders) o
"""

APP_LOG = """
select 'application-' || cast(o_custkey as varchar(20)) as id,
  case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'ACCEPTED' else 'KILLED' end as state,
  submit_ms + cast(o_orderkey as bigint) as timestamp,
  'job-' || cast(o_orderkey as varchar(20)) as name,
  'user-' || cast(o_custkey % 20 as varchar(10)) as user_name,
  submit_ms as submit_time, submit_ms + 1000 * (o_orderkey % 90) as start_time,
  case when o_orderstatus = 'O' then cast(0 as bigint)
    else submit_ms + 3600000 + 1000 * (o_orderkey % 5000) end as finish_time,
  o_orderkey $DIV 50 as commit_epoch
from (select o_orderkey, o_custkey, o_orderstatus, $ORDER_MS as submit_ms from @orders) o
"""

# One row per event: who and where first, then the names that follow from it.
PROVENANCE = """
select case when s = 0 then dataset_i_id else 60000000 + user_id * 1000 + s end as inode_id,
  case event_type
    when 'signup' then 'CREATE'
    when 'view' then case k % 9 when 0 then 'METADATA' when 1 then 'OTHER' else 'ACCESS_DATA' end
    when 'click' then case when k = 97 then 'TRUNCATE' else 'MODIFY_DATA' end
    when 'purchase' then case k % 3 when 0 then 'XATTR_ADD' when 1 then 'XATTR_UPDATE'
      else 'XATTR_DELETE' end
    else 'DELETE' end as inode_operation,
  event_id as io_logical_time, ts_ms as io_timestamp,
  'app' || cast(user_id % 9 as varchar(10)) as io_app_id, cast(user_id % 50 as int) as io_user_id,
  'tb' || cast(event_id % 2 as varchar(10)) as tb,
  case when s = 0 then 100 + user_id % 6
    when s in (1, 2, 3, 5, 12) then dataset_i_id else 70000000 + user_id * 10 + k % 3
    end as i_partition_id,
  case when s in (1, 5, 6, 7) then cast(-1 as bigint) else 100 + user_id % 6 end as project_i_id,
  dataset_i_id,
  case when s = 0 then 100 + user_id % 6
    when s in (1, 2, 3, 5, 12) then dataset_i_id else 70000000 + user_id * 10 + k % 3
    end as parent_i_id,
  case when s = 11 then 'README.md'
    when s = 3 then 'application_1_2_' || cast(user_id % 3 as varchar(10))
    when s = 12 then 'application_1_2'
    else 'f' || cast(s as varchar(10)) || '-' || cast(user_id as varchar(20)) end as i_name,
  project_name,
  case when s in (1, 7) then lower(project_name) || '_featurestore.db'
    when s in (2, 8) then project_name || '_Training_Datasets'
    when s in (3, 9) then 'Experiments'
    when s in (4, 10, 11) then 'Models'
    when s in (5, 6) then project_name || '.db'
    when s = 12 and user_id % 2 = 0 then 'Experiments'
    else 'Logs' end as dataset_name,
  case when s in (4, 10) then 'm' || cast(user_id % 4 as varchar(10))
    when s = 7 then case when k % 2 = 0 then 'fg' else 'code' end
    when s = 8 then case k % 4 when 0 then 'td' when 1 then '' when 2 then '.featureviews'
      else 'code' end
    when s = 9 then 'exp' else '' end as i_p1_name,
  case when s = 10 then 'v' || cast(k % 3 as varchar(10)) else '' end as i_p2_name,
  case when s = 9 then case when k % 2 = 0 then 'application_1_2_0' else 'application_1_2' end
    when s = 4 then 'm' || cast(user_id % 4 as varchar(10))
    else 'dir' || cast(user_id % 4 as varchar(10)) end as i_parent_name,
  'user-' || cast(user_id % 50 as varchar(10)) as i_user_name,
  case when event_type <> 'purchase' then ''
    when k % 5 = 0 then 'core' when k % 5 = 1 then 'project_iid'
    else 'x' || cast(k % 4 as varchar(10)) end as i_xattr_name,
  event_id as io_logical_time_batch, ts_ms as io_timestamp_batch, event_id as ds_logical_time,
  cast(case when event_type = 'purchase' then 1 + k % 3 else 0 end as smallint)
    as i_xattr_num_parts,
  commit_epoch, event_type, k
from (
  select event_id, user_id, event_type, ts_ms, k, commit_epoch, k % 13 as s,
    50000 + user_id as dataset_i_id, 'Proj' || cast(user_id % 5 as varchar(10)) as project_name
  from (@feed) g) f
"""

# Store modes come from signups, other values from purchases. Some are broken:
# an unknown mode (k = 95), a missing last part (k = 94, or every 11th).
XATTR_BUFFER = """
select inode_id, cast(5 as tinyint) as namespace, name, inode_logical_time,
  cast(i as smallint) as part_no,
  substring(full_value, cast(i * 6 + 1 as int),
    case when i = num_parts - 1 then length(full_value) else 6 end) as value,
  num_parts
from (
  select 50000 + user_id as inode_id, 'core' as name, event_id as inode_logical_time,
    '{"project_iid": ' || cast(100 + user_id % 6 as varchar(10)) ||
      ', "prov_type": {"prov_status": "' ||
      case when k = 95 then 'some' else
        case k % 3 when 0 then 'none' when 1 then 'State' else 'ALL' end end || '"}}' as full_value,
    cast(2 as smallint) as num_parts, case when k = 94 then 1 else 2 end as stored
  from (@feed) f where event_type = 'signup'
  union all
  select inode_id, i_xattr_name, io_logical_time,
    case when i_xattr_name = 'core' then
      '{"project_iid": ' || cast(100 + k % 6 as varchar(10)) ||
      ', "prov_type": {"prov_status": "' ||
      case k % 4 when 0 then 'all' when 1 then 'NONE' when 2 then 'state' else 'odd' end || '"}}'
    when k % 2 = 0 then '{"a": ' || cast(k as varchar(10)) || '}'
    else 'text-' || cast(k as varchar(10)) end,
    i_xattr_num_parts,
    case when k % 11 = 0 then i_xattr_num_parts - 1 else i_xattr_num_parts end
  from (@provenance) p where inode_operation in ('XATTR_ADD', 'XATTR_UPDATE')
) v $PARTS
where i < stored
"""

# An inode has a row if the feed says that it was created.
PROVENANCE_INODES = """
select cast(2 as bigint) as parent_id, r_name as name, cast(2 as bigint) as partition_id,
  cast(100 + r_regionkey as bigint) as id
from @region
union all
select distinct parent_i_id, i_name, i_partition_id, inode_id from (@provenance) p
where inode_operation = 'CREATE'
"""

# Batches of 100 changes, flushes of 10 batches; times follow the arrivals.
CHANGES = """
select b.commit_epoch as bulk_id, b.commit_epoch $DIV 10 as flush_id, ts_ms as arrival_ms,
  last_ms + 5 + b.commit_epoch % 7 as start_ms,
  last_ms + 5 + b.commit_epoch % 7 + n * 2 as end_ms,
  last_ms + 300 as request_ms, last_ms + 350 + b.commit_epoch % 11 as done_ms,
  case event_type when 'signup' then 'add' when 'view' then 'update' when 'error' then 'delete'
    end as event_type,
  case k % 4 when 0 then 'inodes' when 1 then 'datasets' when 2 then 'projects' end as asset_type,
  case when k % 2 = 0 then 'mutation' else 'admin' end as log_type
from (@feed) f
join (
  select commit_epoch, max(ts_ms) as last_ms, count(*) as n from (@feed) g group by commit_epoch
) b on f.commit_epoch = b.commit_epoch
"""

# One stored sink response per event.
RESPONSES = """
select event_id,
  case
    when event_type = 'error' and k % 10 = 0 then 'Open Distro Security not initialized.'
    when event_type = 'error' and k % 10 = 1 then '{"errors": tru'
    when event_type = 'error' and k % 10 = 2 then '{"error": "overloaded", "status": 429}'
    when event_type = 'error' and k % 10 = 3 then
      '{"error": {"type": "parse_exception", "reason": "line ' || cast(k as varchar(10)) ||
      '"}, "status": 400}'
    when event_type = 'error' then
      '{"took": 3, "errors": true, "items": [{"update": {"_id": "' ||
      cast(user_id as varchar(20)) || '", "status": 404, "error": {"type": ' ||
      '"document_missing_exception", "reason": "missing ' || cast(k % 5 as varchar(10)) ||
      '"}}}, {"delete": {"_id": "1", "status": 200}}, {"update": {"_id": "2", "status": 500, ' ||
      '"error": "timeout"}}]}'
    else '{"took": 1, "errors": false, "items": [{"update": {"_id": "1", "status": 200}}]}'
    end as response
from (@feed) f
"""

DERIVED = {
    "feed": FEED,
    "mutations": MUTATIONS,
    "inodes": INODES,
    "users": USERS,
    "groups": GROUPS,
    "projects": PROJECTS,
    "datasets": DATASETS,
    "xattrs": XATTRS,
    "admin_log": ADMIN_LOG,
    "app_log": APP_LOG,
    "provenance": PROVENANCE,
    "xattr_buffer": XATTR_BUFFER,
    "provenance_inodes": PROVENANCE_INODES,
    "changes": CHANGES,
    "responses": RESPONSES,
}
# Column names that are reserved words somewhere get their real name here.
RENAMES = {
    "xattrs": {"part_no": "index"},
    "xattr_buffer": {"part_no": "index"},
    "app_log": {"user_name": "user"},
}


# Tables that are read several times and long to derive are stored first.
WRITTEN = {"provenance", "provenance_inodes", "xattr_buffer"}


def select_text(
    name: str, dialect: dict[str, str], source_prefix: str = "", views: tuple[str, ...] = ()
) -> str:
    """The SELECT of a derived table with everything it builds on in place.

    Inner tables named in `views` are read from a view of that name instead.
    """
    text = DERIVED[name].strip()
    for inner in ("provenance", "feed"):
        if inner in views:
            text = text.replace(f"(@{inner})", f"{source_prefix}{inner}")
        elif f"(@{inner})" in text:
            text = text.replace(f"(@{inner})", f"({select_text(inner, dialect, source_prefix)})")
    for token, value in dialect.items():
        text = text.replace(token, value)
    for source in SOURCES:
        text = text.replace(f"@{source}", f"{source_prefix}{source}")
    return text


class Tables:
    """The given and derived tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = str(sf_dir).rstrip("/")
        self._views: set[str] = set()

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCES:
            return self.source(name)
        if name not in DERIVED:
            raise AttributeError(name)
        text = select_text(name, SPARK, "src_", ("provenance",))
        if "src_provenance" in text:
            self.provenance.createOrReplaceTempView("src_provenance")
        for source in SOURCES:
            if f"src_{source}" in text and source not in self._views:
                self.source(source).createOrReplaceTempView(f"src_{source}")
                self._views.add(source)
        df = self.spark.sql(text).withColumnsRenamed(RENAMES.get(name, {}))
        if name in WRITTEN:
            df = materialize(df, name)
        self.__dict__[name] = df
        return df
