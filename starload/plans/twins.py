"""The same results in SQL, for checking: plain windows and joins over the given tables."""

from __future__ import annotations

TWINS: dict[str, str] = {}

_DECLARATION = """
declaration as (
    select
        o_orderkey as id,
        o_orderpriority || ' ' || o_orderstatus as declaration_title,
        case o_orderstatus when 'F' then 'DR' when 'O' then 'EM' else 'FM' end
            as declaration_type,
        cast(o_orderdate as date) as declaration_date,
        o_orderkey // 4 as declaration_request_number,
        cast(o_orderdate as date) as incident_begin_date,
        incident_end_date,
        case o_orderstatus
            when 'O' then date_diff('day', cast(o_orderdate as date), incident_end_date) * 24
            when 'P' then n_lines
        end as incident_duration,
        o_totalprice >= 250000 as ih_program_declared,
        o_orderstatus <> 'F' as ia_program_declared,
        o_orderpriority < '3' as pa_program_declared,
        o_totalprice < 100000 as hm_program_declared,
        deaths,
        cast(substr(o_orderpriority, 1, 1) as bigint) as disaster_fk,
        o_custkey as county_fk,
        substr(md5('1:' || o_orderkey), 1, 8) < '33333333' as is_increment
    from orders left join (
        select
            l_orderkey,
            cast(max(l_shipdate) as date) as incident_end_date,
            cast(sum(l_quantity) as bigint) as deaths,
            count(*) as n_lines
        from lineitem group by l_orderkey
    ) on o_orderkey = l_orderkey
),
flat as (
    select declaration.* exclude (id, disaster_fk, county_fk), id as declaration_id,
        c_name as county_name, n_name as state_name, o_orderpriority as incident_type
    from declaration
    left join orders on o_orderkey = id
    left join customer on c_custkey = county_fk
    left join nation on n_nationkey = c_nationkey
),
typed as (
    select
        upper(state_name) as state_name,
        upper(county_name) as county_name,
        upper(incident_type) as incident_type,
        declaration_request_number, incident_begin_date, incident_end_date,
        coalesce(incident_duration,
            date_diff('day', incident_begin_date, incident_end_date) * 24) as incident_duration,
        deaths, declaration_id, is_increment
    from flat
),
dates as (
    select distinct incident_begin_date, incident_end_date, incident_duration, is_increment
    from typed where incident_begin_date is not null and incident_end_date is not null
)
"""

_STAGING = """
    state_name, county_name, incident_type, declaration_request_number, incident_begin_date,
    incident_end_date, incident_duration, deaths, declaration_id
"""

_VALIDITY = """
    cast(1 as integer) as version, date '2024-01-01' as date_from, date '2200-01-01' as date_to
"""

_BY_DATES = "order by incident_begin_date, incident_end_date, incident_duration nulls first"


def _named_dim(tk: str, name: str, members: str) -> str:
    """Keyed members of one name column, and member 0."""
    return f"""
        select cast(0 as bigint) as {tk}, {_VALIDITY}, 'UNKNOWN' as {name}
        union all
        select row_number() over (order by {name}) as {tk}, {_VALIDITY}, {name}
        from (select distinct {name} from ({members}))
    """


def _dates_dim(members: str, first: str = "0") -> str:
    return f"""
        select {first} + row_number() over ({_BY_DATES}) as incident_dates_tk, {_VALIDITY},
            incident_begin_date, incident_end_date, incident_duration
        from ({members})
    """


_UNKNOWN_DATES = f"""
    select cast(0 as bigint) as incident_dates_tk, {_VALIDITY},
        cast(null as date) as incident_begin_date, cast(null as date) as incident_end_date,
        cast(0 as bigint) as incident_duration
"""

_ATTRIBUTES = """
    declaration_title, declaration_type, declaration_date, ih_program_declared,
    ia_program_declared, hm_program_declared, pa_program_declared
"""

_UNKNOWN_DECLARATION = f"""
    select cast(0 as bigint) as declaration_tk, {_VALIDITY},
        cast(null as bigint) as declaration_request_number,
        cast(null as varchar) as declaration_title, cast(null as varchar) as declaration_type,
        cast(null as date) as declaration_date, false as ih_program_declared,
        false as ia_program_declared, false as hm_program_declared, false as pa_program_declared
"""


def _first_declarations(source: str) -> str:
    """The lowest row per request number."""
    return f"""
        select declaration_request_number, {_ATTRIBUTES} from (
            select *, row_number() over (
                partition by declaration_request_number
                order by declaration_title, declaration_type, declaration_date,
                    ih_program_declared, ia_program_declared, hm_program_declared,
                    pa_program_declared
            ) as place
            from {source}
        ) where place = 1
    """


def _declaration_dim(members: str, first: str = "0") -> str:
    return f"""
        select {first} + row_number() over (order by declaration_request_number)
            as declaration_tk, {_VALIDITY}, declaration_request_number, {_ATTRIBUTES}
        from ({members})
    """


# Dimensions and fact of the whole star, dates backfilled after the historical ones.
_STAR = f"""
with {_DECLARATION},
state_dim as ({_named_dim("state_tk", "state_name",
    "select upper(n_name) as state_name from nation union all "
    "select state_name from typed where is_increment")}),
county_dim as ({_named_dim("county_tk", "county_name",
    "select upper(c_name) as county_name from customer union all "
    "select county_name from typed where is_increment")}),
disaster_dim as ({_named_dim("disaster_tk", "incident_type",
    "select upper(o_orderpriority) as incident_type from orders")}),
declaration_dim as (
    {_UNKNOWN_DECLARATION} union all {_declaration_dim(_first_declarations("declaration"))}
),
old_dates as (
    {_dates_dim("select * exclude (is_increment) from dates where not is_increment")}
),
new_dates as (
    {_dates_dim('''
        select incident_begin_date, incident_end_date, incident_duration from dates
        except
        select incident_begin_date, incident_end_date, incident_duration from old_dates
    ''', "(select max(incident_dates_tk) from old_dates)")}
),
dates_dim as (
    {_UNKNOWN_DATES} union all select * from old_dates union all select * from new_dates
),
resolved as (
    select
        coalesce(state_tk, 0) as state_tk,
        coalesce(county_tk, 0) as county_tk,
        coalesce(disaster_tk, 0) as disaster_tk,
        coalesce(declaration_tk, 0) as declaration_tk,
        coalesce(incident_dates_tk, 0) as incident_dates_tk,
        deaths, t.declaration_request_number, declaration_id
    from typed t
    left join state_dim s on s.state_name = t.state_name
    left join county_dim c on c.county_name = t.county_name
    left join disaster_dim i on i.incident_type = t.incident_type
    left join declaration_dim n on n.declaration_request_number = t.declaration_request_number
    left join dates_dim p on p.incident_begin_date = t.incident_begin_date
        and p.incident_end_date = t.incident_end_date
        and p.incident_duration is not distinct from t.incident_duration
),
fact as (
    select row_number() over (
            order by state_tk, county_tk, disaster_tk, declaration_tk, incident_dates_tk,
                declaration_request_number, declaration_id, deaths nulls first
        ) as disaster_fact_tk,
        state_tk, county_tk, disaster_tk, declaration_tk, incident_dates_tk, deaths
    from resolved
)
"""

# ---- sources and sinks ---------------------------------------------------------------------

TWINS["src_csv_roundtrip"] = "select * from customer"

TWINS["src_sql_projection"] = """
    select c_custkey as county_fk, c_name as county_name, c_nationkey as state_fk from customer
"""

TWINS["distinct_date_triples"] = f"""
    with {_DECLARATION}
    select distinct incident_begin_date, incident_end_date, incident_duration from typed
"""

TWINS["sink_readback_count"] = """
    select count(*) as rows_written, count(*) as rows_read, true as same_schema from customer
"""

# ---- columns and rows ----------------------------------------------------------------------

TWINS["clean_base"] = """
    select o_orderkey, o_custkey as county_fk, o_orderdate, o_orderpriority as incident_type
    from orders
"""

TWINS["first_existing_column"] = "select c_custkey, c_name as county_name from customer"

TWINS["drop_null_keys"] = f"""
    with {_DECLARATION}
    select id, incident_begin_date, incident_end_date, incident_duration from declaration
    where incident_begin_date is not null and incident_end_date is not null
        and incident_duration is not null
"""

TWINS["fill_unknown"] = f"""
    with {_DECLARATION}
    select cast(id as varchar) as id,
        coalesce(nullif(declaration_title, '5-LOW F'), 'unknown') as declaration_title,
        coalesce(strftime(incident_end_date, '%Y-%m-%dT%H:%M:%SZ'), 'unknown')
            as incident_end_date
    from declaration
"""

TWINS["norm_names"] = """
    select c_custkey, upper(c_name) as name_norm,
        regexp_replace(c_name, '[^0-9]', '', 'g') as name_digits
    from customer
"""

TWINS["replace_text"] = """
    select c_custkey, regexp_replace(c_name, 'cust[a-z]+#0*', 'C-', 'gi') as by_regex,
        replace(c_name, '#', '$1') as by_text, c_name as unchanged
    from customer
"""

TWINS["map_codes"] = """
    select c_custkey, coalesce(r_name, cast(c_nationkey as varchar)) as state
    from customer left join region on r_regionkey = c_nationkey
"""

TWINS["map_codes_last_wins"] = """
    select o_orderkey, '0' || o_custkey as fips, coalesce(c_name, '0' || o_custkey) as county_name
    from orders left join customer on c_custkey = o_custkey
"""

TWINS["parse_dates"] = f"""
    with {_DECLARATION}
    select cast(id as varchar) as id,
        case when declaration_type <> 'FM' then incident_begin_date end as begin_date,
        strftime(incident_end_date, '%Y-%m-%d') as end_text
    from declaration
"""

TWINS["resolve_duration"] = f"""
    with {_DECLARATION}
    select id, coalesce(incident_duration,
        date_diff('day', incident_begin_date, incident_end_date) * 24) as hours
    from declaration
"""

TWINS["duration_hours"] = f"""
    with {_DECLARATION}
    select id, hours,
        case when hours = 0 then 'same day' when hours < 0 then 'backwards' else 'other' end
            as kind
    from (
        select id, date_diff('day', incident_begin_date, incident_end_date) * 24 as hours
        from declaration
    )
"""

TWINS["duration_elapsed"] = """
    select user_id, event_type,
        cast(floor(micros / 86400000000.0) as bigint) * 24 as hours,
        cast(floor(-micros / 86400000000.0) as bigint) * 24 as hours_back
    from (
        select user_id, event_type, epoch_us(max(ts)) - epoch_us(min(ts)) as micros
        from events group by user_id, event_type
    )
"""

TWINS["seeded_measure"] = """
    select o_orderkey,
        cast('0x' || substr(md5('1:' || o_orderkey), 1, 15) as bigint) % 10000
            as deaths,
        cast('0x' || substr(md5('2:' || o_orderkey), 1, 15) as bigint) % 24 + 1
            as hours,
        cast('0x' || substr(md5('3:' || o_orderkey), 1, 15) as bigint) % 1000000000000
            as large
    from orders
"""

# ---- split ---------------------------------------------------------------------------------

TWINS["split_hash"] = """
    select o_orderkey,
        case when substr(md5('1:' || o_orderkey), 1, 8) < '33333333' then 'sample' else 'rest' end
            as half
    from orders
"""

_EXACT = """
    select *, row_number() over (order by md5('1:' || o_orderkey))
        <= round_even(0.2 * count(*) over (), 0) as is_sample
    from orders
"""

TWINS["split_exact"] = f"""
    select o_orderkey, case when is_sample then 'sample' else 'rest' end as half from ({_EXACT})
"""

TWINS["split_complement"] = f"""
    select * exclude (is_sample) from ({_EXACT}) where not is_sample
"""

# ---- staging -------------------------------------------------------------------------------

TWINS["stage_typed"] = f"""
    with {_DECLARATION} select {_STAGING} from typed
"""

TWINS["stage_union"] = f"""
    with {_DECLARATION}
    select {_STAGING} from typed where not is_increment
    union all select {_STAGING} from typed where is_increment
"""

TWINS["stage_union_ordered"] = f"""
    with {_DECLARATION}
    select {_STAGING}, cast(is_increment as integer) as part from typed
"""

TWINS["merge_sorted"] = """
    select name, row_number() over (order by lower(name), name) as position
    from (select c_name as name from customer union all select lower(s_name) from supplier)
"""

TWINS["denormalize"] = f"with {_DECLARATION} select * exclude (is_increment) from flat"

TWINS["denormalize_merge"] = TWINS["denormalize"]

# ---- keyed tables --------------------------------------------------------------------------

_KEYED = f"""
with {_DECLARATION},
keyed_state as (
    select row_number() over (order by state_name) as id, state_name
    from (select distinct state_name from flat where state_name is not null)
),
keyed_county as (
    select row_number() over (order by state_name, county_name) as id, county_name, state_name
    from (select distinct state_name, county_name from flat)
    where state_name is not null and county_name is not null
),
keyed_type as (
    select row_number() over (order by incident_type) as id, incident_type
    from (select distinct incident_type from flat where incident_type is not null)
)
"""

TWINS["normalize_state"] = f"{_KEYED} select * from keyed_state"

TWINS["normalize_county"] = f"""
    {_KEYED}
    select c.id, county_name, s.id as state_fk from keyed_county c join keyed_state s
    using (state_name)
"""

TWINS["normalize_county_bag"] = f"""
    {_KEYED}
    select row_number() over (order by state_name, county_name, declaration_id) as id,
        county_name, s.id as state_fk
    from flat join keyed_state s using (state_name) where county_name is not null
"""

TWINS["normalize_type"] = f"{_KEYED} select * from keyed_type"

TWINS["normalize_declaration"] = f"""
    {_KEYED}
    select row_number() over (order by declaration_id) as id, declaration_id,
        declaration_request_number, deaths, first_county as county_fk, t.id as disaster_fk
    from flat
    join (select county_name, min(id) as first_county from keyed_county group by county_name)
        using (county_name)
    join keyed_type t using (incident_type)
"""

TWINS["fk_first_match"] = """
    select p_partkey, p_name, min(p_partkey) over (partition by p_name) as first_part_fk from part
"""

TWINS["insert_if_absent"] = f"""
    with {_DECLARATION},
    existing as (
        select row_number() over (order by state_name, county_name) as id, state_name, county_name
        from (select distinct state_name, county_name from flat where not is_increment)
    )
    select * from existing
    union all
    select (select count(*) from existing) + row_number() over (order by state_name, county_name),
        state_name, county_name
    from (
        select state_name, county_name from flat where is_increment
        except select state_name, county_name from existing
    )
"""

TWINS["distinct_members"] = "select distinct o_custkey, o_orderpriority from orders"

_PLACED_ORDERS = """
    select *, row_number() over (
        partition by o_custkey
        order by o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
    ) as place
    from orders
"""

TWINS["dedupe_by_key"] = f"select * exclude (place) from ({_PLACED_ORDERS}) where place = 1"

TWINS["duplicate_rejects"] = f"select * exclude (place) from ({_PLACED_ORDERS}) where place > 1"

TWINS["dense_key"] = """
    select o_orderkey, o_orderpriority, o_orderdate,
        row_number() over (order by o_orderpriority, o_orderdate, o_orderkey) as order_tk
    from orders
"""

TWINS["sequence_key"] = """
    select o_orderkey, o_custkey,
        90 + 10 * row_number() over (order by o_custkey, o_orderkey) as order_seq
    from orders
"""

TWINS["next_key"] = "select coalesce(max(o_orderkey), 0) as max_key from orders"

TWINS["append_keys"] = """
    select o_orderkey, o_orderdate,
        row_number() over (order by o_orderdate, o_orderkey) + (
            select max(o_orderkey) from orders
            where substr(md5('1:' || o_orderkey), 1, 8) >= '33333333'
        ) as order_tk
    from orders
    where substr(md5('1:' || o_orderkey), 1, 8) < '33333333'
"""

TWINS["sorted_rows"] = """
    select c_mktsegment, c_name, row_number() over (
        order by lower(c_mktsegment), c_mktsegment, lower(c_name), c_name
    ) as position
    from customer
"""

# ---- dimensions ----------------------------------------------------------------------------

TWINS["dim_state"] = f"{_STAR} select * from state_dim"
TWINS["dim_county"] = f"{_STAR} select * from county_dim"
TWINS["dim_type"] = f"{_STAR} select * from disaster_dim"
TWINS["dim_declaration"] = f"{_STAR} select * from declaration_dim"

TWINS["dim_declaration_full"] = f"""
    with {_DECLARATION}
    {_UNKNOWN_DECLARATION}
    union all
    select row_number() over (
            order by declaration_request_number, declaration_title, declaration_type,
                declaration_date, ih_program_declared, ia_program_declared, hm_program_declared,
                pa_program_declared
        ), {_VALIDITY}, declaration_request_number, {_ATTRIBUTES}
    from (select distinct declaration_request_number, {_ATTRIBUTES} from declaration)
"""

_ALL_DATES = "select distinct * exclude (is_increment) from dates"
_OLD_DATES = "select * exclude (is_increment) from dates where not is_increment"

TWINS["dim_dates"] = f"""
    with {_DECLARATION} {_UNKNOWN_DATES} union all {_dates_dim(_ALL_DATES)}
"""

TWINS["dim_dates_pair"] = f"""
    with {_DECLARATION} {_UNKNOWN_DATES} union all
    {_dates_dim('''
        select incident_begin_date, incident_end_date, min(incident_duration) as incident_duration
        from dates group by incident_begin_date, incident_end_date
    ''')}
"""

_CUSTOMER_DIM = _named_dim(
    "county_tk", "county_name", "select upper(c_name) as county_name from customer"
)

TWINS["dim_with_unknown"] = _CUSTOMER_DIM
TWINS["dim_without_unknown"] = f"select * from ({_CUSTOMER_DIM}) where county_tk <> 0"

TWINS["missing_members"] = f"""
    with {_DECLARATION}
    select * exclude (is_increment) from dates n where is_increment and not exists (
        select 1 from dates o where not o.is_increment
            and o.incident_begin_date = n.incident_begin_date
            and o.incident_end_date = n.incident_end_date
            and o.incident_duration is not distinct from n.incident_duration
    )
"""

TWINS["backfill_dimension"] = f"{_STAR} select * from dates_dim"

TWINS["upsert_dimension"] = f"""
    with {_DECLARATION},
    old as ({_declaration_dim(_first_declarations("declaration where not is_increment"))})
    {_UNKNOWN_DECLARATION}
    union all select * from old
    union all {_declaration_dim(
        "select * from (" + _first_declarations("declaration where is_increment") + ") where "
        "declaration_request_number not in (select declaration_request_number from old)",
        "(select max(declaration_tk) from old)")}
"""

# ---- lookups -------------------------------------------------------------------------------


def _old_members(name: str) -> str:
    return f"""
        select {name}, row_number() over (order by {name}) as tk
        from (select distinct {name} from typed where not is_increment)
    """


TWINS["resolve_by_name"] = f"""
    with {_DECLARATION}
    select declaration_id, coalesce(s.tk, 0) as state_tk, coalesce(c.tk, 0) as county_tk,
        coalesce(i.tk, 0) as disaster_tk
    from typed
    left join ({_old_members("state_name")}) s using (state_name)
    left join ({_old_members("county_name")}) c using (county_name)
    left join ({_old_members("incident_type")}) i using (incident_type)
"""

TWINS["resolve_by_number"] = f"""
    with {_DECLARATION}
    select id, d.declaration_request_number, coalesce(tk, 0) as declaration_tk
    from declaration d left join (
        select declaration_request_number,
            row_number() over (order by declaration_request_number) as tk
        from (select distinct declaration_request_number from declaration where not is_increment)
    ) n on n.declaration_request_number = d.declaration_request_number
"""

TWINS["resolve_by_period"] = f"""
    with {_DECLARATION},
    given as (
        select incident_begin_date as b, incident_end_date as e, incident_duration as h,
            row_number() over ({_BY_DATES}) as tk
        from (
            select distinct incident_begin_date, incident_end_date, incident_duration
            from declaration where not is_increment and incident_begin_date is not null
                and incident_end_date is not null
        )
    )
    select id, coalesce(tk, 0) as incident_dates_tk
    from declaration left join given on b = incident_begin_date and e = incident_end_date
        and h is not distinct from incident_duration
"""

TWINS["resolve_or_drop"] = f"""
    with {_DECLARATION}
    select declaration_id, county_name, tk as county_tk
    from typed join ({_old_members("county_name")}) c using (county_name)
"""

# ---- fact ----------------------------------------------------------------------------------

TWINS["fact_for_state"] = f"""
    {_STAR} select state_tk, count(*) as n_rows, cast(sum(deaths) as bigint) as deaths
    from resolved group by state_tk
"""

TWINS["fact_disaster"] = f"{_STAR} select * from fact"

TWINS["fact_disaster_bag"] = f"""
    {_STAR} select row_number() over (order by disaster_tk, deaths nulls first)
        as disaster_fact_tk, disaster_tk, deaths
    from resolved
"""

TWINS["fact_for_member"] = f"{_STAR} select * from fact where state_tk = 1"

# ---- checks --------------------------------------------------------------------------------

TWINS["row_counts"] = f"""
    {_STAR}
    select 'state_dim' as table_name, count(*) as n_rows from state_dim
    union all select 'county_dim', count(*) from county_dim
    union all select 'disaster_dim', count(*) from disaster_dim
    union all select 'declaration_dim', count(*) from declaration_dim
    union all select 'incident_datesdim', count(*) from dates_dim
    union all select 'disaster_fact', count(*) from fact
"""

TWINS["distinct_count"] = "select count(distinct o_orderdate) as n_distinct from orders"

TWINS["duplicate_groups"] = """
    select count(*) as n_groups
    from (select o_orderdate from orders group by o_orderdate having count(*) > 1)
"""

TWINS["unknown_report"] = f"""
    {_STAR}
    select count(*) as n_rows,
        count(*) filter (state_tk = 0) as unknown_state_tk,
        count(*) filter (county_tk = 0) as unknown_county_tk,
        count(*) filter (disaster_tk = 0) as unknown_disaster_tk,
        count(*) filter (declaration_tk = 0) as unknown_declaration_tk,
        count(*) filter (incident_dates_tk = 0) as unknown_incident_dates_tk
    from fact
"""

TWINS["pk_violations"] = """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
    group by l_orderkey, l_linenumber
    having count(*) > 1 or l_orderkey is null or l_linenumber is null
"""

TWINS["constraint_violations"] = f"""
    with {_DECLARATION}
    select 'id' as column_name, 'not_null' as constraint_name,
        count(*) - count(id) as n_violations from declaration
    union all select 'incident_end_date', 'not_null', count(*) - count(incident_end_date)
    from declaration
    union all select 'incident_duration', 'not_null', count(*) - count(incident_duration)
    from declaration
    union all select 'id', 'unique', count(id) - count(distinct id) from declaration
    union all select 'declaration_request_number', 'unique',
        count(declaration_request_number) - count(distinct declaration_request_number)
    from declaration
"""

TWINS["fk_orphans"] = """
    select l_orderkey, count(*) as n_rows from lineitem
    where not exists (
        select 1 from orders where o_orderkey = l_orderkey
            and substr(md5('1:' || o_orderkey), 1, 8) >= '33333333'
    )
    group by l_orderkey
"""

# ---- end to end ----------------------------------------------------------------------------

def _clean(more: str = "") -> str:
    return f"""
    select {more} declaration_request_number,
        coalesce(r_name, cast(c_nationkey as varchar)) as state_name,
        case declaration_type
            when 'DR' then 'Velika katastrofa'
            when 'EM' then 'Upravljanje hitnim situacijama'
            else 'Upravljanje požarom'
        end as declaration_type,
        strftime(declaration_date, '%Y-%m-%d') as declaration_date,
        coalesce(nullif(declaration_title, '5-LOW F'), 'unknown') as declaration_title,
        case when declaration_type <> 'FM' then strftime(incident_begin_date, '%Y-%m-%d') end
            as incident_begin_date,
        strftime(incident_end_date, '%Y-%m-%d') as incident_end_date,
        c_name as county_name,
        o_orderpriority as incident_type,
        cast(ih_program_declared as integer) as ih_program_declared,
        cast(ia_program_declared as integer) as ia_program_declared,
        cast(pa_program_declared as integer) as pa_program_declared,
        cast(hm_program_declared as integer) as hm_program_declared,
        cast('0x' || substr(md5('1:deaths:' || id), 1, 15) as bigint) % 10000 as deaths,
        case
            when declaration_type = 'FM' then null
            when incident_begin_date = incident_end_date
                then cast('0x' || substr(md5('1:hours:' || id), 1, 15) as bigint) % 24 + 1
            else date_diff('day', incident_begin_date, incident_end_date) * 24
        end as incident_duration
    from declaration
    join orders on o_orderkey = id
    join customer on c_custkey = county_fk
    left join region on r_regionkey = c_nationkey
    where incident_end_date is not null
"""


TWINS["clean_declarations"] = f"with {_DECLARATION} {_clean()}"

# ---- later additions -----------------------------------------------------------------------

TWINS["src_csv_whole_text"] = """
    select doc_id, case doc_id % 10 when 3 then null when 4 then '' else text end as text,
        lang, source, n_chars
    from documents
"""

TWINS["src_csv_rejects"] = """
    select o_orderkey || ',' || case when o_orderkey % 7 = 0 then 'x' else '' end || o_custkey
        as line
    from orders
"""

TWINS["split_hash_bounds"] = " union all ".join(
    f"""
    select o_orderkey, {fraction}::double as fraction from orders
    where cast('0x' || substr(md5('1:' || o_orderkey), 1, 15) as bigint) < {round(fraction * 16**15)}
    """
    for fraction in (0.0, 0.2, 0.9999999999, 1.0)
)

TWINS["split_exact_pair"] = """
    select o_orderkey,
        case when row_number() over (order by md5('1:' || a || ':' || b))
            <= round_even(0.3 * count(*) over (), 0) then 'sample' else 'rest' end as half
    from (
        select o_orderkey,
            case when o_orderkey % 2 = 0 then length(half) || '=' || half else 'null' end as a,
            case when o_orderkey % 2 = 1 then length(half) || '=' || half else 'null' end as b
        from (select o_orderkey, cast(o_orderkey // 2 as varchar) as half from orders)
    )
"""

TWINS["insert_if_absent_by_key"] = """
    with old as (
        select row_number() over (order by c_custkey // 4) as id, c_custkey // 4 as area,
            c_name as name
        from customer where c_custkey % 12 = 0
    )
    select * from old
    union all
    select (select count(*) from old) + row_number() over (order by area), area, name
    from (
        select c_custkey // 4 as area, min(c_name) as name from customer
        where c_custkey // 4 not in (select area from old) group by 1
    )
"""

TWINS["dim_declaration_nulls"] = f"""
    with {_DECLARATION},
    titled as (
        select * replace (case when id % 3 > 0 then declaration_title end as declaration_title)
        from declaration
    )
    {_UNKNOWN_DECLARATION} union all {_declaration_dim(_first_declarations("titled"))}
"""

TWINS["resolve_untidy"] = f"""
    with {_DECLARATION},
    dim as ({_named_dim("county_tk", "county_name",
        "select upper(c_name) as county_name from customer")})
    select declaration_id, coalesce(county_tk, 0) as county_tk
    from typed left join dim using (county_name)
"""

TWINS["unknown_misses"] = f"""
    with {_DECLARATION}
    select count(*) as n_rows,
        cast(sum(cast(declaration_id % 3 = 1 or state_name like '%A%' as integer)) as bigint)
            as unknown_state_tk,
        cast(sum(cast(incident_type = '5-LOW' as integer)) as bigint) as unknown_disaster_tk
    from typed
"""

TWINS["clean_halves"] = f"""
    with {_DECLARATION},
    clean as ({_clean("id,")})
    select cast(id as varchar) as row, county_name, state_name, deaths,
        case when row_number() over (order by md5('1:' || id))
            <= round_even(0.2 * count(*) over (), 0) then 'increment' else 'historical' end as half
    from clean
"""

TWINS["apply_increment"] = f"""
    with {_DECLARATION}
    select true as in_range, is_increment and declaration_id % 2 = 1 as is_later,
        state_name, county_name, incident_type, declaration_request_number,
        case when incident_end_date is not null then incident_begin_date end
            as incident_begin_date,
        case when incident_end_date is not null then incident_duration else 0 end
            as incident_duration,
        deaths
    from typed
"""

TWINS["feed_increments"] = TWINS["apply_increment"]

TWINS["load_star_counts"] = f"""
    {_STAR}
    select 'state_dim' as table_name, 'n_rows' as metric, count(*) as n from state_dim
    union all select 'county_dim', 'n_rows', count(*) from county_dim
    union all select 'disaster_dim', 'n_rows', count(*) from disaster_dim
    union all select 'declaration_dim', 'n_rows', count(*) from declaration_dim
    union all select 'incident_datesdim', 'n_rows', count(*) from dates_dim
    union all select 'disaster_fact', 'n_rows', count(*) from fact
    union all select 'disaster_fact', 'unknown_state_tk', count(*) filter (state_tk = 0) from fact
    union all select 'disaster_fact', 'unknown_county_tk', count(*) filter (county_tk = 0) from fact
    union all select 'disaster_fact', 'unknown_disaster_tk', count(*) filter (disaster_tk = 0)
    from fact
    union all select 'disaster_fact', 'unknown_declaration_tk',
        count(*) filter (declaration_tk = 0) from fact
    union all select 'disaster_fact', 'unknown_incident_dates_tk',
        count(*) filter (incident_dates_tk = 0) from fact
"""


def _request_rows(which: str) -> str:
    """One row per request and date, the lowest."""
    return f"""
        select declaration_request_number as k, declaration_date as since,
            declaration_title as title, declaration_type as type
        from declaration where {which} and declaration_date is not null
        qualify row_number() over (
            partition by k, since order by title nulls last, type nulls last
        ) = 1
    """


# The second load keeps the stored versions and adds what differs from the version before.
_REQUESTS = f"""
with {_DECLARATION},
first_load as (
    select *, row_number() over (partition by k order by since) = 1 as is_first from (
        select *, lag((title, type)) over (partition by k order by since) as before
        from ({_request_rows("not is_increment")})
    ) where before is null or before is distinct from (title, type)
),
stored as (
    select k, case when is_first then date '1900-01-01' else since end as since, title, type,
        row_number() over (order by k, first_load.since) as tk
    from first_load
),
both_loads as (
    select * from stored
    union all
    select *, null from ({_request_rows("is_increment")}) as later
    where not exists (select 1 from stored where stored.k = later.k and stored.since = later.since)
),
changes as (
    select * from (
        select *, lag((title, type)) over (partition by k order by since) as before from both_loads
    ) where tk is not null or before is null or before is distinct from (title, type)
),
versions as (
    select
        coalesce(tk, (select max(tk) from stored)
            + sum(case when tk is null then 1 else 0 end) over (order by k, since)) as declaration_tk,
        row_number() over (partition by k order by since) as version,
        since as date_from,
        coalesce(lead(since) over (partition by k order by since), date '2200-01-01') as date_to,
        k as declaration_request_number, title as declaration_title, type as declaration_type
    from changes
),
request_dim as (
    select cast(0 as bigint) as declaration_tk, cast(1 as integer) as version,
        date '1900-01-01' as date_from, date '2200-01-01' as date_to,
        cast(null as bigint) as declaration_request_number,
        cast(null as varchar) as declaration_title, cast(null as varchar) as declaration_type
    union all
    select cast(declaration_tk as bigint), cast(version as integer),
        case when version = 1 then date '1900-01-01' else date_from end, date_to,
        declaration_request_number, declaration_title, declaration_type
    from versions
)
"""

TWINS["dim_versions"] = f"{_REQUESTS} select * from request_dim"

TWINS["resolve_at_date"] = f"""
    {_REQUESTS}
    select id, declaration.declaration_request_number, incident_end_date,
        coalesce(declaration_tk, 0) as declaration_tk
    from declaration left join request_dim
        on request_dim.declaration_request_number = declaration.declaration_request_number
        and date_from <= incident_end_date and incident_end_date < date_to
"""

TWINS["resolve_at_date_sorted"] = TWINS["resolve_at_date"]

TWINS["resolve_hot"] = """
    with dim as (
        select p_partkey, row_number() over (order by p_partkey) as tk
        from part where p_partkey % 5 <> 0
    ),
    lines as (
        select l_orderkey, l_linenumber,
            case when l_orderkey % 3 = 0 then cast(7 as bigint)
                when l_orderkey % 3 = 1 and l_linenumber % 2 = 0 then null
                else l_partkey * 2 end as part
        from lineitem
    )
    select l_orderkey, l_linenumber, part, coalesce(tk, 0) as part_tk
    from lines left join dim on p_partkey = part
"""

TWINS["resolve_bucketed"] = """
    select o_orderkey, o_custkey, coalesce(tk, 0) as county_tk
    from orders left join (
        select c_custkey, row_number() over (order by c_custkey) as tk
        from customer where c_custkey % 5 <> 0
    ) on c_custkey = o_custkey
"""

TWINS["resolve_collated"] = """
    select c_custkey, dense_rank() over (order by c_custkey // 3) as county_tk from customer
"""

TWINS["sorted_collated"] = """
    select c_custkey, row_number() over (order by strip_accents(lower(name)), name) as position
    from (
        select c_custkey,
            case c_custkey % 3
                when 0 then upper('Customer ' || number)
                when 1 then replace('Customer ' || number, 'u', 'ú')
                else 'Customer ' || number
            end as name
        from (select c_custkey, lpad(cast(c_custkey // 3 as varchar), 9, '0') as number from customer)
    )
"""

TWINS["pk_violations_dense"] = """
    select o_custkey, count(*) as n_rows from orders group by o_custkey
    having count(*) > 1 or o_custkey is null
"""

TWINS["fk_orphans_dense"] = TWINS["fk_orphans"]

TWINS["distinct_keys"] = "select count(distinct l_partkey) as n_distinct from lineitem"

TWINS["distinct_sketches"] = """
    select 'o_custkey' as column_name, count(distinct o_custkey) as n_exact, true as is_near
    from orders
    union all select 'o_orderdate', count(distinct o_orderdate), true from orders
    union all select 'o_orderkey', count(distinct o_orderkey), true from orders
"""

TWINS["sink_readback_content"] = """
    select count(*) as rows_written, count(*) as rows_read, true as same_schema,
        true as same_content
    from customer
    union all select count(*), count(*), true, false from customer
"""

TWINS["split_exact_bag"] = """
    with counted as (
        select l_returnflag, l_linestatus, count(*) as copies,
            md5('1:' || coalesce(length(l_returnflag) || '=' || l_returnflag, 'null') || ':'
                || coalesce(length(l_linestatus) || '=' || l_linestatus, 'null')) as h
        from lineitem group by all
    ),
    cut as (
        select *, greatest(0, least(copies,
            round_even(0.3 * sum(copies) over (), 0)
                - coalesce(sum(copies) over (
                    order by h rows between unbounded preceding and 1 preceding), 0)
        )) as taken
        from counted
    )
    select l_returnflag, l_linestatus, 'sample' as half
    from (select *, unnest(range(cast(taken as bigint))) from cut)
    union all
    select l_returnflag, l_linestatus, 'rest' as half
    from (select *, unnest(range(cast(copies - taken as bigint))) from cut)
"""
