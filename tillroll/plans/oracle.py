"""The queries of :mod:`tillroll.plans.queries` as SQL over the same tables."""

from __future__ import annotations

from tillroll.constants import MIN_SUPPORT, N_CLUSTERS, SAMPLE_VISITS, TOP_UPCS, WEEKDAYS
from tillroll.operators.minibatch import SCALE
from tillroll.plans.queries import (
    ALL_COLUMNS,
    BINS,
    DEPARTMENTS,
    FEW_BATCHES,
    FEW_UPCS,
    IGNORED,
    PROFILED,
    SIGNED_DEPARTMENTS,
    VISIT,
)

SCANS = """scans as (
    select l_orderkey as visit_number,
           cast(substr(o_orderpriority, 1, 1) as int) as trip_type,
           dayname(o_orderdate) as weekday,
           case when l_linenumber = 7 then null else l_partkey end as upc,
           case when l_returnflag = 'R' then -cast(l_quantity as bigint)
                else cast(l_quantity as bigint) end as scan_count,
           case when l_linenumber = 7 and l_linestatus = 'O' then null else p_name end as department,
           case when (l_linenumber = 7 and l_returnflag <> 'N')
                  or (l_linenumber = 6 and l_returnflag = 'A') then null else p_size end as fineline,
           coalesce(o_orderstatus, 'O') as status
    from lineitem
    left join part on l_partkey = p_partkey
    left join orders on l_orderkey = o_orderkey
)"""

SIGNED = "case when scan_count < 0 then '-' || department else department end"
ORDINAL = "array_position([{}], weekday) - 1".format(", ".join(f"'{d}'" for d in WEEKDAYS))
ALL = ", ".join(ALL_COLUMNS)

_TOP_UPCS, _FEW_UPCS = (
    f"""upcs as (
    select upc from scans where upc is not null and status <> 'O'
    group by upc order by count(*) desc, upc limit {k}
)"""
    for k in (TOP_UPCS, FEW_UPCS)
)

_CATEGORIES = """categories as (
    select department, unnest(list_distinct(string_split(department, ' '))) as category
    from (select distinct p_name as department from part) as names
)"""

_SUMS = """select visit_number, feature, cast(sum(scan_count) as bigint) as value
from ({rows}) as named where feature is not null group by visit_number, feature"""

_SIGNED_CATEGORY = "case when scan_count < 0 then '-' || category else category end"

_DEPARTMENT_ROWS = f"select visit_number, {SIGNED} as feature, scan_count from scans"
_FINELINE_ROWS = "select visit_number, 'FLN_' || fineline as feature, scan_count from scans"
_UPC_ROWS = "select visit_number, 'UPC_' || upc as feature, scan_count from scans join upcs using (upc)"
_CATEGORY_ROWS = (
    f"select visit_number, {_SIGNED_CATEGORY} as feature, scan_count from scans join categories using (department)"
)

_FAMILIES = " union all ".join(
    [
        f"select *, case when scan_count < 0 then 0 else 1 end as family from ({_DEPARTMENT_ROWS})",
        f"select *, 2 from ({_FINELINE_ROWS})",
        f"select *, 3 from ({_UPC_ROWS})",
        f"select *, 5 from ({_CATEGORY_ROWS})",
    ]
)

_FEATURES = f"""features as (
    select visit_number, family, feature, cast(sum(scan_count) as bigint) as value
    from ({_FAMILIES}) as named where feature is not null group by visit_number, family, feature
    union all
    select visit_number, 4, 'Returns', count(*) filter (where scan_count < 0) from scans group by visit_number
    union all
    select visit_number, 4, 'Weekday', cast(min({ORDINAL}) as bigint) from scans group by visit_number
    union all
    select visit_number, 4, 'Mon_To_Fri', cast(min({ORDINAL}) < 5 as bigint) from scans group by visit_number
)"""

_DICTIONARY = f"""dictionary as (
    select row_number() over (order by family, rank, feature) - 1 as idx, family, feature
    from (
        select distinct case when scan_count < 0 then 0 else 1 end as family, 0 as rank, {SIGNED} as feature
        from scans where department is not null
        union all
        select distinct 2, fineline, 'FLN_' || fineline from scans where fineline is not null
        union all
        select 3, upc, 'UPC_' || upc from upcs
        union all
        select * from (values (4, 1, 'Returns'), (4, 2, 'Weekday'), (4, 3, 'Mon_To_Fri')) as visit
        union all
        select distinct 5, 0, category from categories
        union all
        select distinct 5, 1, '-' || category from categories
        {{fitted}}
    ) as terms
)"""
_FITTED_DICTIONARY = _DICTIONARY.format(fitted="union all select * from (values (6, 4, 'ItemSet'), (6, 5, 'Dept_Category'))")
_DICTIONARY = _DICTIONARY.format(fitted="")

_LABELLED = f"scans where status <> 'O' and trip_type not in ({', '.join(map(str, IGNORED))})"

# Every subset of the departments of a visit, grown in sorted order.
_ITEMSETS = f"""least as (
    select ceil(cast({MIN_SUPPORT} as double) * count(distinct visit_number)) as freq from {_LABELLED}
),
baskets as (
    select distinct visit_number, trip_type, department from {_LABELLED} and department is not null
),
subsets as (
    select visit_number, trip_type, department as last, department as items, 1 as size from baskets
    union all
    select s.visit_number, s.trip_type, b.department, s.items || ';' || b.department, s.size + 1
    from subsets as s
    join baskets as b on b.visit_number = s.visit_number and b.department > s.last
),
itemsets as (
    select trip_type, items, count(*) as freq from subsets
    where size >= 2 group by trip_type, items having count(*) >= (select freq from least)
)"""

_MATCH = """best as (
    select items, trip_type from (
        select *, row_number() over (partition by items order by freq desc, trip_type) as place from itemsets
    ) as placed where place = 1
),
positive as (
    select visit_number, department from scans where department is not null and scan_count >= 0
    group by visit_number, department having sum(scan_count) > 0
),
prefixes as (
    select visit_number,
           row_number() over (partition by visit_number order by department) as size,
           string_agg(department, ';') over (
               partition by visit_number order by department rows unbounded preceding) as items
    from positive
),
matched as (
    select visit_number, max_by(trip_type, size) as item_set
    from prefixes join best using (items) where size >= 2 group by visit_number
),
answer as (
    select visit_number, coalesce(item_set, 0) as item_set
    from (select distinct visit_number from scans) as visits left join matched using (visit_number)
)"""


# Non-zero sums by department and visit, and the first distinct vectors of the shuffled settled visits.
_POINTS = f"""listed as (
    select unnest(range({len(DEPARTMENTS)})) as place, unnest([{', '.join(f"'{d}'" for d in DEPARTMENTS)}]) as department
),
points as materialized (
    select visit_number, place, cast(sum(scan_count) as bigint) as value from scans join listed using (department)
    where scan_count >= 0 group by visit_number, place having sum(scan_count) <> 0
),
visits as materialized (
    select visit_number, any_value(status) as status,
           cast('0x' || substr(md5('0:' || visit_number), 1, 15) as bigint) as key
    from scans group by visit_number
),
vectors as (
    select key, visit_number, coalesce(string_agg(place || ':' || value, ',' order by place), '') as vector
    from visits left join points using (visit_number) where status <> 'O' group by key, visit_number
),
chosen as (
    select min(key) as key, min_by(visit_number, key) as visit_number from vectors
    group by vector order by key limit {N_CLUSTERS}
),
ranked as (select cast(row_number() over (order by key) - 1 as int) as cluster, visit_number from chosen),
sums0 as materialized (
    select cluster, place, coalesce(value, 0) as value
    from ranked cross join listed left join points using (visit_number, place)
),
counts0 as materialized (select distinct cluster, cast(1 as bigint) as n from sums0)"""


def _assigned(step: int, where: str = "true") -> str:
    # The nearest centre after so many batches, of equally near ones the smallest.
    return f"""centres{step} as materialized (
    select cluster, place, cast({SCALE} * value // n as bigint) as centre from sums{step} join counts{step} using (cluster)
),
norms{step} as (select cluster, cast(sum(centre * centre) as bigint) as norm from centres{step} group by cluster),
dots{step} as (
    select visit_number, cluster, cast(sum(value * centre) as bigint) as dot
    from points join centres{step} using (place) group by visit_number, cluster
),
assigned{step} as materialized (
    select visit_number, cluster, norm - {2 * SCALE} * coalesce(dot, 0) as rest
    from (select * from visits where {where}) as v cross join norms{step} left join dots{step} using (visit_number, cluster)
    qualify row_number() over (partition by visit_number order by rest, cluster) = 1
)"""


def _step(batch: int) -> str:
    # One mini-batch: each centre moves to the mean of all visits it has had.
    return f"""{_assigned(batch, f"status <> 'O' and key % {FEW_BATCHES} = {batch}")},
sums{batch + 1} as materialized (
    select cluster, place, cast(sum(value) as bigint) as value from (
        select * from sums{batch} union all
        select cluster, place, value from assigned{batch} join points using (visit_number)
    ) group by cluster, place
),
counts{batch + 1} as materialized (
    select cluster, cast(sum(n) as bigint) as n from (
        select * from counts{batch} union all select cluster, count(*) from assigned{batch} group by cluster
    ) group by cluster
)"""


_BATCHES = ",\n".join(map(_step, range(FEW_BATCHES)))


def _distances(step: int) -> str:
    return f"""select visit_number, cluster, cast(rest + coalesce(own, 0) as bigint) as distance
    from assigned{step} left join (
        select visit_number, cast({SCALE * SCALE} * sum(value * value) as bigint) as own from points group by visit_number
    ) using (visit_number)"""


_PACKED = """select visit_number,
    coalesce(string_agg(idx, ';' order by idx) filter (where value <> 0), '') as indices,
    coalesce(string_agg(value, ';' order by idx) filter (where value <> 0), '') as values
from {rows} join dictionary using (family, feature) group by visit_number"""


def _with(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{', '.join((SCANS, *ctes))}\n{select}"


def _mined(select: str, *ctes: str) -> str:
    return _with(_ITEMSETS, *ctes, select=select, recursive=True)


def _value_counts(column: str, where: str = "true") -> str:
    return _with(
        select=f"""select {column}, count(*) as n from scans
        where {column} is not null and {where} group by {column}"""
    )


def _crosstab(index: str, column: str) -> str:
    return f"""select {index}, {column}, count(*) as n from scans
        where {index} is not null and {column} is not null group by {index}, {column}"""


def _top(index: str, column: str) -> str:
    return _with(
        f"cells as ({_crosstab(index, column)})",
        select=f"""select {column}, {index}, n from (
            select *, row_number() over (partition by {column} order by n desc, {index}) as place from cells
        ) as placed where place = 1""",
    )


def _each(columns: list[str], value: str, name: str) -> str:
    return _with(
        select=" union all ".join(
            f"select '{c}' as column_name, {value.format(c=c)} as {name} from scans" for c in columns
        )
    )


def _mean(column: str) -> str:
    return _with(
        select=f"""select visit_number, {column}, round(avg(scan_count), 6) as mean_scan_count
        from scans where {column} is not null group by visit_number, {column}"""
    )


def _bins(bins: int, key: str | None) -> str:
    # Expects a relation `cells` with the key and a bigint column `cell`.
    keys, by = (f"{key}, ", f"group by {key}") if key else ("", "")
    using = f"{key}, bin" if key else "bin"
    join = f"join bounds using ({key})" if key else ", bounds"
    return f""",
    raw_bounds as (select {keys}min(cell) as lo, max(cell) as hi from cells {by}),
    bounds as (
        select {keys}case when lo = hi then lo - 0.5::double else lo end as start,
               case when lo = hi then 1.0::double else hi - lo end as width
        from raw_bounds where lo is not null
    ),
    counts as (
        select {keys}least(cast(floor((cell - start) * {bins} / width) as int) + 1, {bins}) as bin, count(*) as n
        from cells {join} group by all
    ),
    every as (select {keys}start, width, unnest(range(1, {bins + 1}))::int as bin from bounds)
    select {keys}bin, round(start + (bin - 1) * width / {bins}, 6) as low,
           round(start + bin * width / {bins}, 6) as high, coalesce(n, 0) as n
    from every left join counts using ({using})"""


def _split(status: str) -> str:
    return _with(
        _TOP_UPCS,
        _CATEGORIES,
        _FEATURES,
        select=f"""select visit_number, feature, value from features
        where visit_number in (select visit_number from scans where status {status})""",
    )


def _matrix(status: str) -> str:
    return _mined(
        _PACKED.format(rows="whole"),
        _MATCH,
        _TOP_UPCS,
        _CATEGORIES,
        _FEATURES,
        _FITTED_DICTIONARY,
        _POINTS,
        _BATCHES,
        _assigned(FEW_BATCHES),
        f"""whole as (
            select * from (
                select * from features union all select visit_number, 6, 'ItemSet', item_set from answer
                union all select visit_number, 6, 'Dept_Category', cluster from assigned{FEW_BATCHES}
            ) where visit_number in (select visit_number from scans where status {status})
        )""",
    )


_WEEKDAY_COLUMNS = ", ".join(f"count(*) filter (where weekday = '{d}') as \"{d}\"" for d in WEEKDAYS)
_PIVOT_COLUMNS = ", ".join(
    f"cast(coalesce(sum(value) filter (where feature = '{d}'), 0) as bigint) as \"{d}\"" for d in SIGNED_DEPARTMENTS
)
_VECTOR = ", ".join(
    f"cast(coalesce(sum(scan_count) filter (where department = '{d}' and scan_count >= 0), 0) as bigint)"
    for d in DEPARTMENTS
)
_MISSING = "{} is null and department is not null"

ORACLE_SQL: dict[str, str] = {
    "signed_departments": _with(select=f"select visit_number, {SIGNED} as department, scan_count from scans"),
    "one_visit": _with(select=f"select {ALL} from scans where visit_number = {VISIT}"),
    "sample_visits": _with(
        select=f"""select {ALL} from scans where visit_number in (
            select distinct visit_number from scans order by visit_number limit {SAMPLE_VISITS})"""
    ),
    "both_inputs": _with(
        select=f"""select {ALL.replace('trip_type', "case when status <> 'O' then trip_type end as trip_type")}
        from scans"""
    ),
    "distinct_counts": _each(PROFILED, "count(distinct {c}) + max(({c} is null)::int)", "n_values"),
    "null_counts": _each(ALL_COLUMNS, "count(*) filter (where {c} is null)", "n_nulls"),
    "null_overlap": _with(
        select="""select count(*) filter (where department is null and upc is null) as department_and_upc_null,
        count(*) filter (where department is null and fineline is not null) as department_null_fineline_set,
        count(*) filter (where fineline is null and upc is not null) as fineline_null_upc_set from scans"""
    ),
    "department_values": _with(
        select="""select distinct case
            when department is null then 'nan'
            when contains(department, '''') and not contains(department, '"') then '"' || department || '"'
            else '''' || department || '''' end as department from scans"""
    ),
    "department_values_filled": _with(select="select distinct coalesce(department, '') as department from scans"),
    "scan_describe": _with(
        select="""select count(scan_count) as n, round(avg(scan_count), 6) as mean,
        round(stddev_samp(scan_count), 6) as std, min(scan_count) as min_value,
        round(quantile_cont(scan_count, 0.25), 6) as q25, round(quantile_cont(scan_count, 0.5), 6) as q50,
        round(quantile_cont(scan_count, 0.75), 6) as q75, max(scan_count) as max_value from scans"""
    ),
    "scan_histogram": _with(
        "cells as (select scan_count as cell from scans where scan_count is not null)", select=""
    ).rstrip()
    + _bins(BINS, None),
    "dept_when_fineline_null": _value_counts("department", _MISSING.format("fineline")),
    "dept_when_upc_null": _value_counts("department", _MISSING.format("upc")),
    "scans_when_upc_null": _value_counts("scan_count", _MISSING.format("upc")),
    "scans_when_fineline_null": _value_counts("scan_count", _MISSING.format("fineline")),
    "top_upcs": _value_counts("upc") + f" order by n desc, upc limit {TOP_UPCS}",
    "crosstab_trip_fineline": _with(select=_crosstab("fineline", "trip_type")),
    "crosstab_trip_department": _with(select=_crosstab("department", "trip_type")),
    "crosstab_trip_weekday": _with(
        select=f"""select trip_type, {_WEEKDAY_COLUMNS} from scans
        where trip_type is not null and weekday is not null group by trip_type"""
    ),
    "top_fineline_by_trip": _top("fineline", "trip_type"),
    "top_department_by_trip": _top("department", "trip_type"),
    "top_weekday_by_trip": _top("weekday", "trip_type"),
    "top_trip_by_weekday": _top("trip_type", "weekday"),
    "crosstab_histogram": _with(
        f"pairs as ({_crosstab('trip_type', 'weekday')})",
        """cells as (
            select weekday, coalesce(n, 0) as cell
            from (select distinct weekday from pairs) as w cross join (select distinct trip_type from pairs) as t
            left join pairs using (weekday, trip_type)
        )""",
        select="",
    ).rstrip()
    + _bins(10, "weekday"),
    "visit_labels": _with(
        select="select visit_number, min(trip_type) as trip_type from scans group by visit_number"
    ),
    "visit_label_pairs": _with(select="select distinct visit_number, trip_type from scans"),
    "visits_per_trip_type": _with(
        select="""select trip_type, count(*) as n from (select distinct visit_number, trip_type from scans) as visits
        where trip_type is not null group by trip_type"""
    ),
    "trip_labels": _with(
        select="""select visit_number, min(trip_type) as trip_type from scans
        where status <> 'O' group by visit_number"""
    ),
    "visit_returns": _with(
        select="""select visit_number, count(*) filter (where scan_count < 0) as n_returns,
        cast(count(*) filter (where scan_count < 0) > 0 as int) as has_returns from scans group by visit_number"""
    ),
    "visit_calendar": _with(
        select=f"""select visit_number, cast(min({ORDINAL}) as int) as weekday,
        cast(min({ORDINAL}) < 5 as int) as mon_to_fri from scans group by visit_number"""
    ),
    "visit_summary": _with(
        f"sums as ({_SUMS.format(rows=_DEPARTMENT_ROWS)})",
        f"""facts as (
            select visit_number, cast(min({ORDINAL}) as int) as weekday, cast(min({ORDINAL}) < 5 as int) as mon_to_fri,
                   count(*) filter (where scan_count < 0) as n_returns,
                   cast(count(*) filter (where scan_count < 0) > 0 as int) as has_returns
            from scans group by visit_number
        )""",
        select="""select visit_number, weekday, mon_to_fri, n_returns, has_returns, feature, value
        from facts left join sums using (visit_number)""",
    ),
    "department_sums": _with(select=_SUMS.format(rows=_DEPARTMENT_ROWS)),
    "department_pivot": _with(
        f"sums as ({_SUMS.format(rows=_DEPARTMENT_ROWS)})",
        select=f"select visit_number, {_PIVOT_COLUMNS} from sums group by visit_number",
    ),
    "fineline_sums": _with(select=_SUMS.format(rows=_FINELINE_ROWS)),
    "upc_sums": _with(_TOP_UPCS, select=_SUMS.format(rows=_UPC_ROWS)),
    "upc_sums_few": _with(_FEW_UPCS, select=_SUMS.format(rows=_UPC_ROWS)),
    "category_sums": _with(_CATEGORIES, select=_SUMS.format(rows=_CATEGORY_ROWS)),
    "visit_dept_mean": _mean("department"),
    "visit_fineline_mean": _mean("fineline"),
    "visit_mean_features": _with(
        select=f"""select visit_number, feature, round(avg(value), 6) as value from (
            select visit_number, department as feature, scan_count as value from scans
            union all select visit_number, 'FLN_' || fineline, scan_count from scans
            union all select visit_number, 'Weekday', {ORDINAL} from scans
        ) as named where feature is not null group by visit_number, feature"""
    ),
    "visit_features": _with(
        _TOP_UPCS, _CATEGORIES, _FEATURES, select="select visit_number, feature, value from features"
    ),
    "feature_dictionary": _with(_TOP_UPCS, _CATEGORIES, _DICTIONARY, select="select * from dictionary"),
    "sparse_rows": _with(
        _TOP_UPCS,
        _CATEGORIES,
        _FEATURES,
        _DICTIONARY,
        select=_PACKED.format(rows="features"),
    ),
    "dense_rows": _with(
        _TOP_UPCS,
        _CATEGORIES,
        _FEATURES,
        _DICTIONARY,
        "filled as (select visit_number, map(list(idx), list(value)) as cells "
        "from features join dictionary using (family, feature) group by visit_number)",
        select="""select visit_number, array_to_string(list_transform(
            range((select count(*) from dictionary)), lambda i: coalesce(cells[i], 0)), ',') as line from filled""",
    ),
    "transactions": _with(
        select=f"""select visit_number, concat_ws(';', cast(-min(trip_type) as varchar),
            string_agg(distinct department, ';' order by department)) as items
        from {_LABELLED} group by visit_number"""
    ),
    "itemsets": _mined("select * from itemsets"),
    "itemset_lines": _mined("select trip_type || ';' || items as value from itemsets"),
    "itemset_preview": _mined(
        """select '-' || trip_type || ', ' || replace(items, ';', ', ') as itemset, freq
        from itemsets order by freq desc, itemset limit 50"""
    ),
    "itemset_trip_types": _mined("select trip_type, count(*) as n_itemsets from itemsets group by trip_type"),
    "itemset_match": _mined("select * from answer", _MATCH),
    "itemset_match_counts": _mined("select item_set, count(*) as n from answer group by item_set", _MATCH),
    "department_vectors": _with(
        select=f"select visit_number, concat_ws(';', {_VECTOR}) as vector from scans group by visit_number"
    ),
    "cluster_centres": _with(
        _POINTS,
        _BATCHES,
        select=f"""select cluster, string_agg({SCALE} * value // n, ';' order by place) as centre, n
        from sums{FEW_BATCHES} join counts{FEW_BATCHES} using (cluster) group by cluster, n""",
    ),
    "nearest_centre": _with(_POINTS, _BATCHES, _assigned(FEW_BATCHES), select=_distances(FEW_BATCHES)),
    "nearest_frozen_centre": _with(_POINTS, _assigned(0), select=_distances(0)),
    "train_matrix": _matrix("<> 'O'"),
    "test_matrix": _matrix("= 'O'"),
    "labelled_matrix": _with(
        _TOP_UPCS,
        _CATEGORIES,
        _FEATURES,
        _DICTIONARY,
        f"packed as ({_PACKED.format(rows='features')})",
        select="""select visit_number, trip_type, indices, values from packed join (
            select visit_number, min(trip_type) as trip_type from scans where status <> 'O' group by visit_number
        ) using (visit_number)""",
    ),
    "scans_by_csv": _with(select=f"select {ALL} from scans where status <> 'O'"),
    "rejected_by_csv": _with(
        select="""select case when scan_count = -50 then 'fields' else 'ScanCount' end as reason, count(*) as n
        from scans where scan_count in (-50, -49) group by 1"""
    ),
    "itemsets_by_lines": _mined("select trip_type, items from itemsets"),
    "labels_by_csv": _with(
        select="""select visit_number, min(trip_type) as trip_type from scans
        where status <> 'O' group by visit_number"""
    ),
    "test_ids_by_csv": _with(select="select distinct visit_number from scans where status = 'O'"),
    "split_train": _split("<> 'O'"),
    "split_test": _split("= 'O'"),
    "shuffled_train": _with(
        select="""select visit_number, min(trip_type) as trip_type,
        cast('0x' || substr(md5('0:' || visit_number), 1, 15) as bigint) as shuffle_key
        from scans where status <> 'O' group by visit_number"""
    ),
}
