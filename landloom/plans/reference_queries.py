"""The engine's operators over the test tables, with SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landloom.functions import numbers as N
from landloom.functions import text as X
from landloom.functions.arrays import distinct_any_case, json_text, list_cell, ordered_union, overlap, pad_trim, pipe_text, recomputed_acres
from landloom.functions.schema import mapping
from landloom.missing import M9, is_missing
from landloom.operators import acreage, dedupe, enrich, exclude, landpage, load, match, owners, remap, report, rollup, subtract
from landloom.plans.tables import table
from landloom.sources.database import row_counts, with_county
from landloom.sources.sinks import tracker_update

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


MISS = "({0} is null or lower(trim({0})) in ('','nan','none','null','n/a','na','--','unknown','not available'))"
SPACES = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
CELL = "(case when " + MISS + " then '' else regexp_replace(" + SPACES + ", '^(-?\\d+)\\.0$', '\\1') end)"
#: A total order of line items: their keys alone are not unique.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
LINE_SQL = ", ".join(LINE_ORDER)


# --- Duplicates -------------------------------------------------------------------------------

@query(f"select * exclude rn from (select *, row_number() over (partition by l_orderkey order by {LINE_SQL}) rn from lineitem) where rn = 1")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.keep_first(table(spark, d, "lineitem"), ["l_orderkey"], LINE_ORDER)


@query(f"select * exclude rn from (select *, row_number() over (partition by l_orderkey order by {', '.join(c + ' desc' for c in LINE_ORDER)}) rn from lineitem) where rn = 1")
def dedupe_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.keep_first(table(spark, d, "lineitem"), ["l_orderkey"], LINE_ORDER, last=True)


@query("select count(*) filter (n > 1) duplicate_keys, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) duplicate_rows, max(n) most_rows from (select l_orderkey, count(*) n from lineitem group by 1)")
def dup_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.duplicate_statistics(table(spark, d, "lineitem"), ["l_orderkey"])


@query("select l_orderkey, bool_or(l_returnflag = 'R') returned from lineitem group by 1")
def bool_or_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") == "R", "yes").otherwise("no"))
    merged = dedupe.dedupe_by_id(rows.select("l_orderkey", *LINE_ORDER, "flag"), ["l_orderkey"], LINE_ORDER, flags=["flag"])
    return merged.select("l_orderkey", N.is_true(F.col("flag")).alias("returned"))


@query(f"""with f as (select l_orderkey, l_returnflag v, row_number() over (partition by l_orderkey order by {LINE_SQL}) p from lineitem),
    g as (select l_orderkey, v, min(p) p from f group by all) select l_orderkey, string_agg(v, ' | ' order by p) flags from g group by 1""")
def merge_distinct_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("flags", F.col("l_returnflag")).select("l_orderkey", *LINE_ORDER, "flags")
    return dedupe.dedupe_by_id(rows, ["l_orderkey"], LINE_ORDER, lists=["flags"]).select("l_orderkey", "flags")


@query(f"""with k as (select *, {CELL.format('land_id')} i, count(*) over (partition by county_id, {CELL.format('land_id')}) n, row_number() over (partition by county_id, {CELL.format('land_id')} order by row_no) r from load_rows)
    select county_id, row_no, case when n > 1 and i <> '' then 'merged' else 'single' end kind from k where i = '' or r = 1""")
def load_rows_by_id(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "load_rows").select("county_id", "row_no", F.col("land_id").alias("id"), F.lit("x").alias("mark"))
    merged = dedupe.dedupe_by_id(rows.withColumn("mark", F.concat(F.lit("v"), F.col("row_no").cast("string"))), ["county_id", "id"], ["row_no"], lists=["mark"])
    return merged.select("county_id", "row_no", F.when(F.col("mark").contains(" | "), "merged").otherwise("single").alias("kind"))


# --- Owners -----------------------------------------------------------------------------------

def _orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.lit("1").alias("area"), F.col("o_orderkey"), F.col("o_custkey").cast("string").alias("full_name"), F.lit("x").alias("mailing_address"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("legal_address"), F.col("o_totalprice").alias("acres"), F.col("o_orderkey").cast("string").alias("id"))


@query("""select cast(o_custkey as varchar) as full_name, cast(count(*) as int) lands_count, '["' || string_agg(cast(o_orderkey as varchar), '", "' order by o_orderkey) || '"]' id_list from orders group by 1""")
def owner_group_lists(spark: SparkSession, d: str) -> DataFrame:
    return owners.group_owners(_orders(spark, d), ["area"], ["o_orderkey"]).select("full_name", "lands_count", "id_list")


@query("""select cast(o_custkey as varchar) full_name, arg_max(o_orderkey, (case when o_orderstatus <> 'F' then 1 else 0 end, o_totalprice, -o_orderkey)) o_orderkey from orders group by 1""")
def owner_rep_nonblank_first(spark: SparkSession, d: str) -> DataFrame:
    return owners.group_owners(_orders(spark, d), ["area"], ["o_orderkey"]).select("full_name", "o_orderkey")


@query("""select coalesce(a, 'row ' || k) grp, count(*) n_rows from (select case when o_orderpriority = '5-LOW' then null else o_orderpriority end a, o_orderkey k from orders) group by 1""")
def owner_blank_key_separate(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    rows = o.select(F.lit("1").alias("area"), "o_orderkey", F.lit("n").alias("full_name"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("mailing_address"), F.lit("").alias("legal_address"), F.lit(1.0).alias("acres"), F.lit("1").alias("id"))
    grouped = owners.group_owners(rows, ["area"], ["o_orderkey"])
    return grouped.select(F.coalesce("mailing_address", F.concat(F.lit("row "), F.col("o_orderkey").cast("string"))).alias("grp"), F.col("lands_count").cast("bigint").alias("n_rows"))


@query(f"""with r as (select county_id, {CELL.format('full_name')} n, case when {MISS.format('mailing_address')} then 'row ' || row_no else {CELL.format('mailing_address')} end a, row_no, not {MISS.format('legal_address')} l from load_rows),
    g as (select county_id, n, a, count(*) c, bool_or(l) l from r group by all)
    select county_id, cast(sum(c) as bigint) rows_before, count(*) as "groups", count(*) filter (c > 1) groups_of_several, count(*) filter (not l) groups_without_legal, max(c) most_parcels from g group by 1""")
def owner_selection_counts(spark: SparkSession, d: str) -> DataFrame:
    return owners.selection_counts(table(spark, d, "load_rows"), ["county_id"], ["row_no"])


@query(f"""with r as (select county_id, {CELL.format('full_name')} n, case when {MISS.format('mailing_address')} then 'row ' || row_no else {CELL.format('mailing_address')} end a, row_no,
      case when {MISS.format('legal_address')} then 0 else 1 end l, coalesce(try_cast(regexp_replace(case when {MISS.format('acres')} then null else acres end, '[^0-9.\\-]', '', 'g') as double), 0) v from load_rows)
    select county_id, arg_max(row_no, (l, v, -row_no)) row_no, cast(count(*) as int) lands_count from r group by county_id, n, a""")
def owner_load_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "load_rows").select("county_id", "row_no", "full_name", "mailing_address", "legal_address", "acres", F.col("land_id").alias("id"))
    return owners.group_owners(rows, ["county_id"], ["row_no"]).select("county_id", "row_no", "lands_count")


# --- Mailing rollup ---------------------------------------------------------------------------

def _customers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    address = F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"), F.pmod("c_custkey", F.lit(40)).cast("string"))
    return c.select(
        F.lit("1").alias("area"), "c_custkey", F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("full_name"), F.lit("").alias("legal_address"), address.alias("mailing_address"),
        F.abs(F.round("c_acctbal")).cast("bigint").cast("string").alias("acres"), F.lit("").alias("city"), F.lit("").alias("zip"), F.lit("").alias("state"), F.lit(1).alias("lands_count"), F.lit("").alias("id_list"), F.lit("").alias("acres_list"))


_CUSTOMERS = "c as (select c_custkey k, c_name, concat_ws(' ', c_mktsegment, c_nationkey, c_custkey % 40) a, abs(round(c_acctbal)) v, count(*) over (partition by concat_ws(' ', c_mktsegment, c_nationkey, c_custkey % 40)) n from customer)"


@query(f"""with {_CUSTOMERS} select false is_group, case when n > 1 then '' else a end mailing_address, cast(cast(v as bigint) as varchar) acres, 1 lands_count from c
    union all select true, a, cast(cast(sum(v) as bigint) as varchar), cast(count(*) as int) from c where n > 1 group by a""")
def mailing_rollup_union(spark: SparkSession, d: str) -> DataFrame:
    return rollup.rollup_mailing(_customers(spark, d), ["area"], ["c_custkey"]).select("is_group", "mailing_address", "acres", "lands_count")


@query(f"with {_CUSTOMERS} select k c_custkey, case when n > 1 then '' else a end mailing_address from c")
def mailing_clear_source_key(spark: SparkSession, d: str) -> DataFrame:
    return rollup.rollup_mailing(_customers(spark, d), ["area"], ["c_custkey"]).filter("not is_group").select("c_custkey", "mailing_address")


@query(f"""with {_CUSTOMERS} select a mailing_address, cast(arg_max(k, (v, -k)) as varchar) id from c where n > 1 group by a""")
def primary_owner_select(spark: SparkSession, d: str) -> DataFrame:
    return rollup.rollup_mailing(_customers(spark, d), ["area"], ["c_custkey"]).filter("is_group").select("mailing_address", "id")


@query("""select c_custkey, upper(substr(sha1(trim(regexp_replace(regexp_replace(upper(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))), '[^A-Z0-9 ]+', '', 'g'), ' +', ' ', 'g'))), 1, 6)) code from customer""")
def ma_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", X.mailing_code(F.col("c_name")).alias("code"))


@query("""with p as (select p_partkey, repeat(p_name || ' ', 8) n, p_size o from part),
    q as (select p_partkey, trim(regexp_replace(n, '\\s+', ' ', 'g')) n, o, 'MA#ABC123 | ' h, case when o = 0 then '' when o = 1 then ' (+1 other)' else ' (+' || o || ' others)' end t from p),
    r as (select *, 150 - length(h) - length(t) room from q)
    select p_partkey, h || (case when length(n) > room then rtrim(substr(n, 1, room - 3)) || '...' else n end) || t as label from r""")
def group_label_ellipsis(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", X.group_label(F.lit("ABC123"), F.repeat(F.concat("p_name", F.lit(" ")), F.lit(8)), F.col("p_size")).alias("label"))


# --- Exclusion --------------------------------------------------------------------------------

_PHRASES = ("market value", "deed", "oak", "county", "fence line")
_HIT = "regexp_matches(text, '(?i)(^|[^A-Za-z0-9]){0}($|[^A-Za-z0-9])')"
_HITS = " union all ".join(f"select doc_id, {i} i, '{p}' p from documents where {_HIT.format(p.replace(' ', chr(92) + 's+'))}" for i, p in enumerate(_PHRASES))


@query(f"select doc_id, source from documents where doc_id not in (select doc_id from ({_HITS}))")
def keyword_exclude(spark: SparkSession, d: str) -> DataFrame:
    return exclude.split_excluded(table(spark, d, "documents"), "text", _PHRASES)[0].select("doc_id", "source")


@query(f"select doc_id, string_agg(p, ' | ' order by i) removed_by from ({_HITS}) group by 1")
def keyword_audit(spark: SparkSession, d: str) -> DataFrame:
    return exclude.split_excluded(table(spark, d, "documents"), "text", _PHRASES)[1].select("doc_id", "removed_by")


@query(f"select p phrase, count(*) n_rows from ({_HITS}) group by 1")
def keyword_counts(spark: SparkSession, d: str) -> DataFrame:
    return exclude.phrase_counts(table(spark, d, "documents"), "text", _PHRASES)


@query(f"with c as (select p, count(*) n from ({_HITS}) group by 1) select string_agg(p || '=' || n, ' | ' order by n desc, lower(p)) summary from c")
def keyword_summary(spark: SparkSession, d: str) -> DataFrame:
    return exclude.phrase_summary(table(spark, d, "documents"), "text", _PHRASES)


@query("with g as (select lower(p_name) k, min(p_partkey) o, arg_min(p_name, p_partkey) as name from part group by 1) select name from g order by o limit 10")
def first_distinct_names(spark: SparkSession, d: str) -> DataFrame:
    return exclude.first_names(table(spark, d, "part"), "p_name", ["p_partkey"])


# --- Subtraction ------------------------------------------------------------------------------

@query("select l.l_orderkey, l.l_partkey from lineitem l where not exists (select 1 from part p where p.p_partkey = l.l_partkey and p.p_size < 25)")
def subtract_existing_rows(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(keys, "l_partkey", "left_anti").select("l_orderkey", "l_partkey")


def _baskets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))).alias("ids"))
    rows = lines.select(F.lit(1).alias("area"), "l_orderkey", F.col("l_orderkey").cast("string").alias("id"), F.to_json("ids").alias("id_list"))
    part = table(spark, d, "part").filter("p_size < 25").select(F.lit(1).alias("area"), F.col("p_partkey").cast("string").alias("land_id"), F.array().cast("array<bigint>").alias("id_list"))
    return rows, subtract.existing_keys(part, ["area"])


@query("""with b as (select distinct l_orderkey, l_partkey from lineitem), m as (select b.*, p.p_partkey is not null hit from b left join (select p_partkey from part where p_size < 25) p on p.p_partkey = b.l_partkey)
    select l_orderkey, cast(count(*) as int) seen, cast(count(*) filter (hit) as int) removed, cast(count(*) filter (not hit) as int) remaining,
      case when not bool_or(hit) then 'kept' when bool_and(hit) then 'dropped' else 'partial' end outcome from m group by 1""")
def subtract_partial(spark: SparkSession, d: str) -> DataFrame:
    return subtract.subtract_parcels(*_baskets(spark, d), ["area"], "l_orderkey").select("l_orderkey", "seen", "removed", "remaining", "outcome")


@query("""with b as (select distinct l_orderkey, l_partkey from lineitem), m as (select b.*, p.p_partkey is not null hit from b left join (select p_partkey from part where p_size < 25) p on p.p_partkey = b.l_partkey),
    o as (select l_orderkey, case when not bool_or(hit) then 'kept' when bool_and(hit) then 'dropped' else 'partial' end o, count(*) s, count(*) filter (hit) r from m group by 1)
    select count(*) filter (o = 'kept') rows_kept, count(*) filter (o = 'partial') rows_partial, count(*) filter (o = 'dropped') rows_dropped, cast(0 as bigint) rows_skipped_kept,
      cast(sum(s) as bigint) parcels_seen, cast(sum(r) as bigint) parcels_removed, cast(sum(s - r) as bigint) parcels_kept from o""")
def subtract_counts(spark: SparkSession, d: str) -> DataFrame:
    return subtract.outcome_counts(subtract.subtract_parcels(*_baskets(spark, d), ["area"], "l_orderkey"))


@query("""with l as (select distinct p_partkey k from part where p_size < 25), i as (select distinct l_partkey k from lineitem)
    select count(*) filter (l.k is not null) land_keys, count(*) filter (l.k is null) list_keys_added, count(*) all_keys from l full join i on l.k = i.k""")
def existing_key_stats(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").filter("p_size < 25").select(F.lit(1).alias("area"), F.col("p_partkey").cast("string").alias("land_id"), F.array().cast("array<bigint>").alias("id_list"))
    lists = table(spark, d, "lineitem").select(F.lit(1).alias("area"), F.lit("").alias("land_id"), F.array("l_partkey").alias("id_list"))
    return subtract.key_statistics(subtract.existing_keys(part.unionByName(lists), ["area"]), ["area"]).drop("area")


# --- Load -------------------------------------------------------------------------------------

@query("""with s as (select county_id, max(try_cast(split_part(unique_id, '-', 3) as bigint)) m from db_owner where len(string_split(unique_id, '-')) = 4 group by 1)
    select row_no, 'TX-' || l.county_id || '-' || (coalesce(m, 0) + row_number() over (partition by l.county_id order by row_no)) || '-1' unique_id from load_rows l left join s using (county_id)""")
def sequence_unique_id(spark: SparkSession, d: str) -> DataFrame:
    start = load.largest_index(table(spark, d, "db_owner"))
    return load.number_rows(table(spark, d, "load_rows").select("county_id", "row_no"), start, "county_id", ["row_no"]).select("row_no", "unique_id")


@query("select county_id, max(try_cast(split_part(unique_id, '-', 3) as bigint)) largest_index from db_owner where len(string_split(unique_id, '-')) = 4 group by 1")
def max_index(spark: SparkSession, d: str) -> DataFrame:
    return load.largest_index(table(spark, d, "db_owner"))


@query("""with t as (select row_no, case when full_name is null or lower(trim(full_name)) in ('','nan','none','null','nat') then null else substr(trim(regexp_replace(full_name, '\\s+', ' ', 'g')), 1, 150) end full_name,
      case when zip is null or lower(trim(zip)) in ('','nan','none','null','nat') then null else substr(trim(zip), 1, 10) end zip,
      case when acres is null or lower(trim(acres)) in ('','nan','none','null','nat') then null else try_cast(replace(trim(acres), ',', '') as double) end acres, owned_lands from load_rows
      where not (land_id is null or lower(trim(land_id)) in ('','nan','none','null','nat'))
        or len(list_filter(string_split(regexp_replace(coalesce(id_list, ''), '[\\[\\]"'']', '', 'g'), case when contains(id_list, '|') and not starts_with(trim(id_list), '[') then '|' else ',' end), lambda x: regexp_full_match(trim(x), '-?\\d+(\\.\\d+)?'))) > 0)
    select row_no, full_name, zip, acres, cast(case when owned_lands is not null then greatest(owned_lands, 0) end as int) owned_lands from t""")
def typed_payload(spark: SparkSession, d: str) -> DataFrame:
    typed, _ = load.typed_rows(table(spark, d, "load_rows").withColumnRenamed("land_id", "id"))
    cols = [F.col("p")[c].alias(c) for c in ("full_name", "zip", "acres")]
    lands = F.when(F.col("owned_lands").isNotNull(), F.col("p")["owned_lands"]).alias("owned_lands")
    return typed.select("row_no", *cols, lands)


@query("""select c_custkey, case when c_custkey % 3 = 0 then c_acctbal + 1 else c_acctbal end c_acctbal from customer union all select c_custkey + 10000000, 0.0 from customer where c_custkey % 7 = 0""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    new = c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1).unionByName(c.filter("c_custkey % 7 = 0").select((F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.lit(0.0).alias("c_acctbal")))
    return load.upsert(c, new, ["c_custkey"])


@query("select c_custkey, case when c_custkey % 5 = 0 then 'X' else c_mktsegment end c_mktsegment, c_nationkey from customer")
def keyed_update(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    changes = c.filter("c_custkey % 5 = 0").select("c_custkey", F.lit("X").alias("c_mktsegment"), F.lit(None).cast("int").alias("c_nationkey"))
    return load.keyed_update(c, changes, ["c_custkey"], ["c_mktsegment", "c_nationkey"])


# --- Links ------------------------------------------------------------------------------------

def _links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "load_rows").withColumnRenamed("land_id", "id").withColumnRenamed("owned_lands", "lands_count")
    stored = table(spark, d, "db_owner")
    return match.source_records(rows, ["county_id"], "row_no")[0], stored


# The land id is the row's only parcel here, so that SQL need not parse list cells;
# match_list_candidates, match_list_best and match_list_ambiguous link by every listed parcel.
_LAND = "case when regexp_full_match(trim({0}), '\\d+\\.0+') then regexp_replace(regexp_replace(trim({0}), '\\.0+$', ''), '^0+(\\d)', '\\1') else trim({0}) end"
_SRC = f"""s as (select county_id, row_no, {_LAND.format('land_id')} land, try_cast(regexp_replace(trim(land_id), '\\.0+$', '') as bigint) num, full_name n, owned_lands lands from load_rows where regexp_full_match(trim(land_id), '-?\\d+(\\.0+)?')),
    b as (select unique_id, county_id, {_LAND.format('land_id')} land, full_name n, owned_lands lands, coalesce(list_distinct(id_list), []) ids, coalesce(len(id_list), 0) size from db_owner),
    c as (select s.*, b.unique_id, b.land bland, b.n bn, b.lands blands, b.ids, b.size, list_contains(b.ids, s.num) own, try_cast(b.land as bigint) bnum
      from s join b on s.county_id = b.county_id and (s.land = b.land or list_contains(case when b.size > 0 then b.ids else [try_cast(b.land as bigint)] end, s.num))),
    x as (select *, lower(trim(regexp_replace(coalesce(n, ''), '\\s+', ' ', 'g'))) ln, lower(trim(regexp_replace(coalesce(bn, ''), '\\s+', ' ', 'g'))) lb, case when size > 0 then size else coalesce(blands, 0) end theirs from c),
    scored as (select county_id, row_no, unique_id, cast((case when land = bland then 10000 else 0 end) + (case when own then 350 else 0 end) + (case when bnum = num then 150 else 0 end)
      + (case when ln = '' or lb = '' then 0 when ln = lb then 30 when contains(lb, ln) or contains(ln, lb) then 10 else 0 end)
      + (case when theirs > 0 then (case when theirs = 1 then 25 else -least(abs(1 - theirs), 25) end) else 0 end) + (case when lands = blands then 10 else 0 end) as bigint) score, cast(case when own then 1 else 0 end as int) overlap from x)"""


def _simple(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "load_rows").select("county_id", "row_no", F.col("land_id").alias("id"), "full_name", F.col("owned_lands").alias("lands_count"))
    return match.source_records(rows, ["county_id"], "row_no")[0], table(spark, d, "db_owner")


@query(f"with {_SRC} select county_id, row_no, unique_id, score, overlap from scored")
def match_candidates(spark: SparkSession, d: str) -> DataFrame:
    records, stored = _simple(spark, d)
    return match.candidates(records, stored, ["county_id"]).select("county_id", F.col("row").alias("row_no"), F.col("unique").alias("unique_id"), "score", "overlap")


@query(f"with {_SRC} select county_id, row_no, arg_max(unique_id, (score, overlap, unique_id)) unique_id, max(score) score from scored where score >= 1 group by 1, 2")
def match_best(spark: SparkSession, d: str) -> DataFrame:
    records, stored = _simple(spark, d)
    best = match.best_matches(match.candidates(records, stored, ["county_id"]), ["county_id"])
    return best.select("county_id", F.col("row").alias("row_no"), F.col("unique").alias("unique_id"), "score")


@query(f"""with {_SRC}, r as (select *, count(*) over (partition by county_id, row_no, score, overlap) ties, row_number() over (partition by county_id, row_no order by score desc, overlap desc, unique_id desc) k from scored where score >= 1)
    select county_id, count(*) n_rows, count(*) filter (ties > 1) n_ambiguous from r where k = 1 group by 1""")
def match_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    records, stored = _simple(spark, d)
    best = match.best_matches(match.candidates(records, stored, ["county_id"]), ["county_id"])
    return best.groupBy("county_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("ambiguous").alias("n_ambiguous"))


def _list_links(spark: SparkSession, d: str) -> DataFrame:
    """Scored links by every id of the list cell, however the cell packs them."""
    ids = F.regexp_extract_all("id_list", F.lit(r"[A-Za-z]*[0-9]+(?:\.0+)?"), F.lit(0))
    rows = table(spark, d, "load_rows").select("county_id", "row_no", F.col("land_id").alias("id"), "full_name", F.col("owned_lands").alias("lands_count"), F.when(F.size(ids) > 0, F.to_json(ids)).otherwise(F.col("id_list")).alias("id_list"))
    return match.candidates(match.source_records(rows, ["county_id"], "row_no")[0], table(spark, d, "db_owner"), ["county_id"])


@query()
def match_list_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The scored links of all load rows by land id and every parcel of their id lists."""
    return _list_links(spark, d).select("county_id", F.col("row").alias("row_no"), F.col("unique").alias("unique_id"), "score", "overlap")


@query()
def match_list_best(spark: SparkSession, d: str) -> DataFrame:
    """The best link of each load row, by all its parcels."""
    return match.best_matches(_list_links(spark, d), ["county_id"]).select("county_id", F.col("row").alias("row_no"), F.col("unique").alias("unique_id"), "score")


@query()
def match_list_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    """Per county the linked rows and those whose best link, by all parcels, ties with another."""
    return match.best_matches(_list_links(spark, d), ["county_id"]).groupBy("county_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("ambiguous").alias("n_ambiguous"))


def _updates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    records, stored = _links(spark, d)
    best = match.best_matches(match.candidates(records, stored, ["county_id"]), ["county_id"])
    return match.merged_lists(records, stored, best, ["county_id"]), stored


@query()
def match_updates(spark: SparkSession, d: str) -> DataFrame:
    """The updates of all load rows against the stored rows: one per stored row, the strongest."""
    won, _ = match.resolve_conflicts(_updates(spark, d)[0], ["county_id"])
    return won.select("county_id", F.col("row").alias("row_no"), F.col("unique").alias("unique_id"), "score", "overlap", "ids_added", F.array_join("changed", ", ").alias("fields_changed"))


@query()
def match_applied(spark: SparkSession, d: str) -> DataFrame:
    """The stored rows after the updates."""
    updates, stored = _updates(spark, d)
    done = match.apply_updates(stored, match.resolve_conflicts(updates, ["county_id"])[0], ["county_id"])
    return done.select("unique_id", "county_id", F.size("id_list").alias("n_ids"), F.size(F.filter("acres_list", lambda x: x.isNotNull())).alias("n_acres"))


@query("""with o as (select o_orderkey k, case when o_orderkey % 2 = 0 then o_totalprice end v from orders), n as (select l_orderkey k, max(l_extendedprice) v from lineitem group by 1)
    select o.k o_orderkey, coalesce(o.v, n.v) price, o.v is null and n.v is not null filled from o left join n using (k)""")
def merge_fill_missing(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("old"))
    new = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("new"))
    both = old.join(new, "o_orderkey", "left")
    return both.select("o_orderkey", F.coalesce("old", "new").alias("price"), (F.col("old").isNull() & F.col("new").isNotNull()).alias("filled"))


@query("select c_custkey, 'XY' c_mktsegment from customer where c_custkey % 4 = 0 and c_mktsegment <> 'XY'")
def merge_changed_only(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    new = load.keyed_update(c, c.filter("c_custkey % 4 = 0").select("c_custkey", F.lit("XY").alias("c_mktsegment")), ["c_custkey"], ["c_mktsegment"])
    old = c.withColumnRenamed("c_mktsegment", "before")
    return new.join(old, "c_custkey").filter(~F.col("c_mktsegment").eqNullSafe(F.col("before"))).select("c_custkey", "c_mktsegment")


@query("""with u as (select s_nationkey t, s_suppkey r, cast(round(s_acctbal) as bigint) score from supplier), k as (select *, row_number() over (partition by t order by score desc, r desc) n from u)
    select t as "unique", r as "row", score from k where n = 1""")
def conflict_resolution(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    updates = s.select(F.lit(1).alias("area"), F.col("s_nationkey").alias("unique"), F.col("s_suppkey").alias("row"), F.round("s_acctbal").cast("bigint").alias("score"), F.lit(0).alias("overlap"), F.array(F.lit("x")).alias("changed"))
    return match.resolve_conflicts(updates, ["area"])[0].select("unique", "row", "score")


@query("""with a as (select l_orderkey k, l_partkey v, row_number() over (partition by l_orderkey order by l_partkey) p from (select distinct l_orderkey, l_partkey from lineitem where l_returnflag = 'R')),
    b as (select l_orderkey k, l_partkey v, 1000 + row_number() over (partition by l_orderkey order by l_partkey) p from (select distinct l_orderkey, l_partkey from lineitem)),
    u as (select k, v, min(p) p from (from a union all from b) group by 1, 2) select k l_orderkey, string_agg(cast(v as varchar), ',' order by p) ids from u group by 1""")
def id_union_ordered(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_partkey")))).alias("a"), F.array_sort(F.collect_set("l_partkey")).alias("b"))
    return g.select("l_orderkey", F.array_join(ordered_union(F.col("a"), F.col("b")), ",").alias("ids"))


@query("""with a as (select l_orderkey k, list(distinct l_suppkey) x from lineitem where l_linenumber <= 3 group by 1), b as (select l_orderkey k, list(distinct l_suppkey) y from lineitem where l_linenumber >= 3 group by 1)
    select k l_orderkey, cast(len(list_intersect(x, y)) as int) shared from a join b using (k)""")
def array_overlap(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")  # noqa: E741
    a = l.filter("l_linenumber <= 3").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("x"))
    b = l.filter("l_linenumber >= 3").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("y"))
    return a.join(b, "l_orderkey").select("l_orderkey", overlap(F.col("x"), F.col("y")).alias("shared"))


# --- Sources, schema, and text ------------------------------------------------------------------

@query("select s_suppkey, s_name, s_nationkey as nationkey, null::bigint c_custkey, null::varchar c_mktsegment from supplier union all select null, null, c_nationkey, c_custkey, c_mktsegment from customer")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("nationkey"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_mktsegment")
    return remap.union_by_name([s, c])


@query("""with t as (select row_no, trim(regexp_replace(full_name, '\\s+', ' ', 'g')) n, full_name is null or lower(trim(full_name)) in ('','nan','none','null','nat') m from load_rows),
    u as (select row_no, m, trim(split_part(n, '&', 1)) n from t)
    select row_no, case when m or n = '' then null when contains(n, ' ') then substr(substr(n, instr(n, ' ') + 1), 1, 100) else substr(n, 1, 100) end first_name, case when m or not contains(n, ' ') then null else substr(split_part(n, ' ', 1), 1, 100) end last_name from u""")
def split_name(spark: SparkSession, d: str) -> DataFrame:
    first, last = X.split_name(F.col("full_name"))
    return table(spark, d, "load_rows").select("row_no", first.alias("first_name"), last.alias("last_name"))


@query("""select c_custkey, 'Springfield' city, 'TX' state, lpad(cast(10000 + c_custkey % 80000 as varchar), 5, '0') zip from customer""")
def address_zip_state(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    text = F.format_string("%d MAIN ST, SPRINGFIELD, TX %05d-1234", "c_custkey", 10_000 + F.col("c_custkey") % 80_000)
    return enrich.parse_lines(c.select("c_custkey", text.alias("t")), "t", "p").select("c_custkey", X.smart_title(F.col("p")["city"]).alias("city"), F.col("p")["state"].alias("state"), F.col("p")["zip"].alias("zip"))


@query(f"""with t as (select row_no, upper(trim(regexp_replace(mailing_address, '[\\n\\t%]', ' ', 'g'))) a from load_rows where not {MISS.format('mailing_address')})
    select row_no, coalesce(list_last(regexp_extract_all(a, '\\b(\\d{{5}})(?:-\\d{{4}})?(?:\\.0)?\\b', 1)), '') zip from t""")
def address_last_code(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "load_rows").filter(~is_missing(F.col("mailing_address")))
    return rows.select("row_no", enrich.last_code(X.tidy_address(F.col("mailing_address"))).alias("zip"))


@query()
def address_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """City, state and code of the load rows filled from their mailing address."""
    return enrich.enrich_addresses(table(spark, d, "load_rows")).select("row_no", "city", "state", "zip", "address_result")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity + l_discount, 2) acres, 'ac_unit_before_number' as method, 'high' confidence from lineitem")
def acreage_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.format_string("LOT %d AC %.2f", "l_linenumber", F.col("l_quantity") + F.col("l_discount")).alias("t"))
    p = rows.withColumn("p", acreage.parse_acreage(F.col("t")))
    return p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("p")["acres"].alias("acres"), F.col("p")["method"].alias("method"), F.col("p")["confidence"].alias("confidence"))


@query()
def acreage_documents(spark: SparkSession, d: str) -> DataFrame:
    """Acres of the documents as legal descriptions, by method and confidence."""
    filled = acreage.fill_acreage(table(spark, d, "documents").select("doc_id", "text", F.lit("").alias("acres")), acres="acres", description=F.col("text"))
    return acreage.method_counts(filled)


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.6f', l_extendedprice / 43560) acres from lineitem")
def area_to_acres(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.format_string("%.6f", N.to_acres(F.col("l_extendedprice"))).alias("acres"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_linenumber % 3 = 0 then l_quantity when l_linenumber % 3 = 1 then 12.5 else round(l_extendedprice / 43560.0, 6) end acres,
    case when l_linenumber % 3 = 0 then 'existing' when l_linenumber % 3 = 1 then 'legal_description' else 'surface_area' end source from lineitem""")
def fill_precedence(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")  # noqa: E741
    third = F.col("l_linenumber") % 3
    rows = l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(third == 0, F.col("l_quantity").cast("string")).otherwise("").alias("acres"), F.when(third == 1, "ACRES 12.5").otherwise("LOT 4").alias("t"), F.col("l_extendedprice").alias("area"))
    filled = acreage.fill_acreage(rows, acres="acres", description=F.col("t"), surface="area")
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "acres", F.col("legal_acreage_source").alias("source"))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice parsed, l_extendedprice strict from lineitem")
def numeric_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.parse_number(F.concat(text, F.lit(" USD"))).alias("parsed"), N.strict_number(text).alias("strict"))


@query("""select event_id, cast(round_even(value, 0) as bigint) half_even, case when value = trunc(value) then cast(value as bigint) end exact, cast(trunc(value) as bigint) truncated from (select event_id, round(value, 1) as value from events where value is not null)""")
def int_parse_modes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").filter("value is not null").select("event_id", F.format_string("%.1f", F.round("value", 1)).alias("t"))
    return rows.select("event_id", N.whole_half_even(F.col("t")).alias("half_even"), N.whole_exact(F.col("t")).alias("exact"), N.whole_truncated(F.col("t")).alias("truncated"))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_returnflag when 'R' then true when 'A' then false end parsed, l_returnflag = 'R' yes from lineitem")
def bool_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", " Yes").when(F.col("l_returnflag") == "A", "f").otherwise("maybe")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.parse_bool(text).alias("parsed"), N.is_true(text).alias("yes"))


@query("select o_orderkey, cast(o_orderdate as date) a, cast(o_orderdate as date) b, cast(o_orderdate as date) c, cast(o_orderdate as date) d from orders")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    forms = {"a": "M/d/yyyy", "b": "yyyy-MM-dd'T'HH:mm:ss'Z'", "c": "yyyyMMdd", "d": "dd-MMM-yyyy"}
    return o.select("o_orderkey", *[N.parse_date(F.date_format(F.date_trunc("day", at), f)).alias(c) for c, f in forms.items()])


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_partkey as varchar) id from lineitem")
def id_normalize(spark: SparkSession, d: str) -> DataFrame:
    text = F.format_string("%09d.0", "l_partkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.id_text(text).alias("id"))


@query("""select event_id, case when s >= 3600 then (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' when s >= 60 then (s // 60) || 'm ' || (s % 60) || 's' else s || 's' end took
    from (select event_id, cast(floor(coalesce(abs(value), 0) * 10) as bigint) s from events)""")
def duration_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", N.duration_text(F.coalesce(F.abs("value"), F.lit(0.0)) * 10).alias("took"))


@query("""select l_orderkey, '["' || string_agg(cast(l_partkey as varchar), '", "' order by l_partkey) || '"]' spaced, cast(count(*) as int) n from lineitem group by 1""")
def json_list_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x.cast("string")).alias("a"))
    back = list_cell(json_text(F.col("a"), spaced=False))
    return g.select("l_orderkey", json_text(back).alias("spaced"), F.size(list_cell(F.regexp_replace(json_text(F.col("a")), '"', "'"))).alias("n"))


@query("""with g as (select l_orderkey, list(l_partkey order by l_partkey) a from lineitem group by 1) select l_orderkey, array_to_string(list_transform(range(1, 5), lambda i: coalesce(cast(a[i] as varchar), '-')), ',') padded from g""")
def pad_trim_lists(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x.cast("string")).alias("a"))
    return g.select("l_orderkey", F.array_join(pad_trim(F.col("a"), F.lit(4), F.lit("-")), ",").alias("padded"))


@query("""with f as (select l_orderkey k, case when l_linenumber % 2 = 0 then lower(l_linestatus || l_returnflag) else l_linestatus || l_returnflag end v, row_number() over (partition by l_orderkey order by """ + LINE_SQL + """) p from lineitem),
    g as (select k, arg_min(v, p) v, min(p) p from f group by k, lower(v)) select k l_orderkey, string_agg(v, ' | ' order by p) vals from g group by 1""")
def distinct_any_case_values(spark: SparkSession, d: str) -> DataFrame:
    v = F.concat("l_linestatus", "l_returnflag")
    rows = table(spark, d, "lineitem").withColumn("v", F.when(F.col("l_linenumber") % 2 == 0, F.lower(v)).otherwise(v))
    g = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct(*LINE_ORDER, "v"))), lambda s: s["v"]).alias("a"))
    return g.select("l_orderkey", pipe_text(distinct_any_case(F.col("a"))).alias("vals"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events")
def json_scalar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("select l_orderkey, round(sum(l_quantity), 2) acres from lineitem group by 1")
def recompute_acres(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_quantity").cast("string")).alias("a"))
    return g.select("l_orderkey", F.round(recomputed_acres(F.col("a")), 2).alias("acres"))


# --- Pages --------------------------------------------------------------------------------------

_PAGE = "<html><title>Parcel %d</title><div class='panel'><div class='panel-heading'>Property Land</div><table><tr><th>Type</th><th>Acreage</th><th>Sqft</th></tr><tr><td>A<td>%.2f<td>0</tr><tr><td>B<td>0<td></tr><tr><td>C</td><td></td><td>21780</td></tr></table></div></html>"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", F.format_string(_PAGE, "p_partkey", "p_retailprice").alias("html")).withColumn("page", landpage.parse_page(F.col("html")))


@query("select p_partkey, 'Parcel ' || p_partkey title, 'success' status from part")
def html_title(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("p_partkey", F.col("page")["title"].alias("title"), F.col("page")["status"].alias("status"))


@query("select p_partkey, round(p_retailprice + 0.5, 4) acreage, 'property_land_sum' as method, 'property_land_panel' detail from part")
def html_panel(spark: SparkSession, d: str) -> DataFrame:
    page = F.col("page")
    return _pages(spark, d).select("p_partkey", F.round(page["acreage"], 4).alias("acreage"), page["method"].alias("method"), page["detail"].alias("detail"))


@query("select l_orderkey, round(sum(l_tax), 2) total, max(l_tax) largest from lineitem where l_tax <> 0 group by 1")
def land_rows_agg(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").filter("l_tax <> 0").groupBy("l_orderkey").agg(F.round(F.sum("l_tax"), 2).alias("total"), F.max("l_tax").alias("largest"))


@query("select o_orderkey, 1 attempt, 'https://esearch.site' || o_custkey || '.org/Property/View/R' || o_orderkey url, 'success' status from orders")
def page_first_accepted(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", landpage.search_base(F.concat(F.lit("www.site"), "o_custkey", F.lit(".org/home"))).alias("base"))
    o = o.withColumn("urls", F.transform(landpage.id_candidates(F.col("o_orderkey").cast("string")), lambda i: landpage.page_address(F.col("base"), i)))
    pages = o.select(F.explode("urls").alias("url")).withColumn("html", F.when(F.col("url").contains("/R"), F.format_string(_PAGE, F.lit(1), F.lit(1.0))).otherwise("<title>Error</title>"))
    done = landpage.fill_from_pages(o, pages, ["o_orderkey"])
    r = F.col("result")
    return done.select("o_orderkey", r["attempt"].alias("attempt"), r["url"].alias("url"), r["page"]["status"].alias("status"))


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") == "R", "success").otherwise("failed").alias("status"), F.lit(1).alias("parser_version"))
    return landpage.not_done(table(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


# --- Reports ------------------------------------------------------------------------------------

@query("""with w as (select event_id, count(*) over q n, avg(case when event_type = 'error' then 1.0 else 0.0 end) over q s from events window q as (partition by user_id order by ts, event_id rows between 19 preceding and current row))
    select event_id, case when n >= 8 then round(s, 6) end recent_bad_share from w""")
def sliding_failure_rate(spark: SparkSession, d: str) -> DataFrame:
    out = report.recent_bad_share(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return out.select("event_id", F.round("recent_bad_share", 6).alias("recent_bad_share"))


@query("select o_orderkey, cast((row_number() over (partition by o_custkey order by o_orderkey) - 1) % 4 as int) part from orders")
def round_robin_chunks(spark: SparkSession, d: str) -> DataFrame:
    return report.deal(table(spark, d, "orders"), ["o_orderkey"], 4, ["o_custkey"]).select("o_orderkey", "part")


_M8 = "({0} is null or lower(trim({0})) in ('','nan','none','null','n/a','na','--','unknown'))"


@query("select county_id, count(*) n_rows, " + ", ".join(f"count(*) filter ({_M8.format(c)}) blank_{c}" for c in ("land_id", "full_name", "legal_address", "mailing_address", "acres", "city", "zip")) + " from load_rows group by 1")
def missing_counts(spark: SparkSession, d: str) -> DataFrame:
    return remap.blank_counts(table(spark, d, "load_rows"), ["county_id"], ["land_id", "full_name", "legal_address", "mailing_address", "acres", "city", "zip"])


@query("select n_name, count(*) n_rows, round(sum(c_acctbal), 2) sum_c_acctbal from customer join nation on c_nationkey = n_nationkey group by 1 union all select null, count(*), round(sum(c_acctbal), 2) from customer join nation on c_nationkey = n_nationkey")
def county_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return report.totals(rows, ["n_name"], ["c_acctbal"], overall=True).withColumn("sum_c_acctbal", F.round("sum_c_acctbal", 2))


@query("select event_type, count(*) n_rows from events group by 1")
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.reason_counts(table(spark, d, "events"), "event_type")


@query("select user_id, count(*) n_rows, round(avg(case when event_type = 'error' then 1.0 else 0.0 end), 6) bad_share, round(avg(nullif(value, 0)), 6) mean_seconds from events group by 1")
def probe_rates(spark: SparkSession, d: str) -> DataFrame:
    out = report.status_rates(table(spark, d, "events"), ["user_id"], "event_type", ["error"], "value")
    return out.select("user_id", "n_rows", F.round("bad_share", 6).alias("bad_share"), F.round("mean_seconds", 6).alias("mean_seconds"))


@query("select n_nationkey, n_name, coalesce(m.n, -1) customers from (select n_nationkey, n_name from nation) left join (select c_nationkey n_nationkey, count(*) n from customer where c_mktsegment = 'BUILDING' group by 1) m using (n_nationkey)")
def tracker_join(spark: SparkSession, d: str) -> DataFrame:
    tracker = table(spark, d, "nation").select("n_nationkey", "n_name", F.lit(-1).cast("bigint").alias("customers"))
    metrics = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return tracker_update(tracker, metrics, "n_nationkey", ["customers"])


@query("select county_id, count(*) n_rows from db_owner group by 1")
def stored_counts(spark: SparkSession, d: str) -> DataFrame:
    return row_counts(table(spark, d, "db_owner"), "county_id")


_CKEY = "regexp_replace(lower(trim(regexp_replace(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '(?i)\\s+county(?:\\s*,?\\s*(?:texas|tx))?\\s*$', ''))), '[^a-z0-9]+', '', 'g')"


@query(f"""with d as (select {_CKEY.format('county_name')} k, min(county_id) id from db_county group by 1)
    select row_no, d.id found_id, d.id is not null county_known from load_rows l left join d on d.k = {_CKEY.format('l.county_name')}""")
def county_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "load_rows").select("row_no", F.col("county_name").alias("named"))
    return with_county(rows, table(spark, d, "db_county"), "named").select("row_no", F.col("county_id").alias("found_id"), "county_known")


@query("select r_name as name, length(replace(replace(r_name, '&', '&amp;'), '<', '&lt;')) n from region")
def escape_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select(F.col("r_name").alias("name"), F.length(X.html_escape(F.col("r_name"))).alias("n"))


@query(f"select doc_id, {CELL.format('lang')} as lang, {MISS.format('lang')} as missing from documents")
def cell_cleaner(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.clean_cell(F.col("lang")).alias("lang"), is_missing(F.col("lang"), M9).alias("missing"))


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """Load rows as raw rows of an export; the description is the first text of the parcel's documents."""
    texts = table(spark, d, "documents").filter("land_id is not null and text is not null").groupBy("county_id", "land_id").agg(F.min_by("text", "doc_id").alias("legal_desc"))
    r = table(spark, d, "load_rows").join(table(spark, d, "db_county").select("county_id", F.col("county_name").alias("county")), "county_id").join(texts, ["county_id", "land_id"], "left")
    return r.select(
        "county_id", "county", F.col("source_file").alias("_src_file"), F.col("row_no").alias("_src_row"), F.col("land_id").alias("prop_id"), F.col("full_name").alias("owner_name"), F.col("legal_address").alias("situs_address"),
        F.col("mailing_address").alias("mail_addr"), F.col("acres").alias("legal_acreage"), F.col("city").alias("situs_city"), F.col("zip").alias("situs_zip"), F.col("state").alias("situs_state"),
        F.col("market_value_list").alias("market"), F.col("owner_tax_year_list").alias("tax_year"), F.col("deed_date_list").alias("deed_date"), "legal_desc")


_MAPPED = """select * from (values ('id', 'prop_id'), ('full_name', 'owner_name'), ('legal_address', 'situs_address'), ('mailing_address', 'mail_addr'), ('acres', 'legal_acreage'), ('city', 'situs_city'), ('zip', 'situs_zip'), ('state', 'situs_state'),
    ('legal_acreage_filled_by_script', ''), ('Empty_Legal_Acreage', ''), ('market_value_list', 'market'), ('owner_tax_year_list', 'tax_year'), ('deed_date_list', 'deed_date')) t(field, columns)"""


@query(_MAPPED)
def mapped_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns that each essential field of the raw rows is built from."""
    return spark.createDataFrame([(k, ", ".join(v)) for k, v in mapping(_raw(spark, d).columns).items()], "field string, columns string")


@query()
def pipeline_payload(spark: SparkSession, d: str) -> DataFrame:
    """All stages from raw rows to numbered payload rows."""
    from landloom.plans.pipeline import run

    result = run(_raw(spark, d), table(spark, d, "db_county"), table(spark, d, "db_owner"))
    return result.payload.select("unique_id", "county_id", "land_id", "full_name", "mailing_address", "acres", "city", "zip", "owned_lands", "true_flags")
