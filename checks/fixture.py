"""Indicator tables derived from the driver's parquet files.

The driver's tables hold no grid cells. Customers are placed on pseudo-random cells, and what
they order becomes the indicators: ``facts`` and ``METADATA_SQL`` form a small, dense base with
many cells; the ``REGISTRY`` tables turn every supplier into an indicator version, so that the
life-cycle jobs grow with the data too. All texts run unchanged in Spark SQL and in DuckDB;
``{customer}`` and the like stand for the driver's tables.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

from hexstats import schemas
from hexstats.sources.staging import shared_folder, stage
from hexstats.sources.tables import read_facts, write_facts

OWNER = "analyst"
ONE, AREA = schemas.ONE_ID, schemas.AREA_ID


def uuid(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"


ACCTBAL, REVENUE, ORDERS, POPULATION, AVG_ORDER, REVENUE_V2 = (uuid(i) for i in range(1, 7))
IDS = schemas.SystemIds(one=ONE, area=AREA, population=POPULATION)
NOW = "2024-06-01 00:00:00"

_digits = "\n".join(
    f"    | ((case when r >= {i} then cast((m - m % {7 ** (8 - i)}) / {7 ** (8 - i)} as bigint) % 7"
    f" else cast(7 as bigint) end) << {45 - 3 * i})"
    for i in range(1, 9)
)
CELLS_SQL = f"""
res as (select cast(r as bigint) as r from (values (0),(1),(2),(3),(4),(5),(6),(7),(8)) t(r)),
cust as (select c_custkey as k, cast(39 + c_nationkey as bigint) as b,
                (c_custkey * 2654435761) % 5764801 as m from {{customer}}),
cells as (
  select c.k, res.r, (cast(1 as bigint) << 59) | (r << 52) | (b << 45)
{_digits}
    | cast(2097151 as bigint) as h3
  from cust c cross join res
)"""

FACTS_SQL = f"""
with {CELLS_SQL},
leaf as (
  select c_custkey as k, '{ACCTBAL}' as ind, c_acctbal as v from {{customer}}
  union all select o_custkey, '{REVENUE}', sum(o_totalprice) from {{orders}} group by o_custkey
  union all select o_custkey, '{ORDERS}', cast(count(*) as double) from {{orders}} group by o_custkey
  union all select c_custkey, '{POPULATION}', cast(1 + c_custkey % 97 as double)
            from {{customer}} where c_custkey % 5 <> 0
  union all select o_custkey, '{AVG_ORDER}', avg(o_totalprice) from {{orders}} group by o_custkey
  union all select o_custkey, '{REVENUE_V2}', sum(o_totalprice) * 1.0005e0 from {{orders}} group by o_custkey
  union all select o_custkey, case l_returnflag when 'A' then '{uuid(11)}' when 'N' then '{uuid(12)}'
                   else '{uuid(13)}' end, sum(l_quantity)
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey group by o_custkey, l_returnflag
)
select h3, ind as indicator_uuid,
       case when ind = '{AVG_ORDER}' then avg(v) else sum(v) end as indicator_value
from leaf join cells on leaf.k = cells.k group by h3, ind
union all
select h3, '{ONE}', 1.0e0 from cells where k % 3 <> 0 group by h3
union all
select h3, '{AREA}', 4357449.416e0 / pow(7e0, max(r)) from cells where k % 3 <> 0 group by h3
"""


def _meta(param, internal, external, state, is_base, date, upload="null", max_res="null"):
    day = f"cast('{date} 00:00:00' as timestamp)" if date else "cast(null as timestamp)"
    upload = "cast(null as string)" if upload == "null" else f"'{upload}'"
    return (
        f"select '{param}' as param_id, '{internal}' as internal_id, '{external}' as external_id, "
        f"'{OWNER}' as owner, '{state}' as state, {str(is_base).lower()} as is_base, {day} as date, "
        f"{upload} as upload_id, cast({max_res} as int) as max_res, cast(null as string) as downscale"
    )


def _ext(n):
    return f"00000000-0000-4000-b000-{n:012d}"


SYSTEM_METADATA_SQL = "\nunion all ".join(
    [
        _meta("one", ONE, ONE, "READY", True, None, max_res="15"),
        _meta("area_km2", AREA, AREA, "READY", True, None, max_res="15"),
    ]
)
METADATA_SQL = SYSTEM_METADATA_SQL + "\nunion all " + "\nunion all ".join(
    [
        _meta("acctbal", ACCTBAL, _ext(1), "READY", False, "2024-01-01"),
        _meta("revenue", REVENUE, _ext(2), "READY", False, "2024-01-02"),
        _meta("orders", ORDERS, _ext(3), "READY", True, "2024-01-03"),
        _meta("population", POPULATION, _ext(4), "READY", True, "2024-01-04"),
        _meta("avg_order", AVG_ORDER, _ext(5), "NEW", False, "2024-01-05"),
        _meta("revenue", REVENUE_V2, _ext(2), "NEW", False, "2024-02-02"),
        _meta("stuck", uuid(7), _ext(7), "COPY IN PROGRESS", False, "2024-02-03"),
        _meta("temp", uuid(8), _ext(8), "TMP CREATED", False, "2024-02-03"),
        _meta("gone", uuid(9), _ext(9), "OUTDATED", False, "2023-01-01"),
        _meta("returned", uuid(11), _ext(11), "READY", False, "2024-01-06"),
        _meta("open quantity", uuid(12), _ext(12), "READY", False, "2024-01-06"),
        _meta("refused", uuid(13), _ext(13), "READY", False, "2024-01-06"),
    ]
)

OVERRIDES_SQL = f"""
select '{_ext(2)}' as numerator_id, '{ONE}' as denominator_id, 0e0 as min, 1e0 as p25, 2e0 as p75, 3e0 as max,
       'Revenue' as label, cast(null as string) as min_label, cast(null as string) as max_label,
       cast(null as string) as p25_label, cast(null as string) as p75_label
union all
select '{_ext(1)}', '{_ext(3)}', -5e0, cast(null as double), cast(null as double), cast(null as double),
       'Balance', null, null, null, null
union all
select '{_ext(99)}', '{ONE}', 1e0, 1e0, 1e0, 1e0, null, null, null, null, null
"""

SPECIAL_PAIRS_SQL = "\nunion all ".join(
    f"select '{a}' as x_numerator_id, '{b}' as x_denominator_id, '{c}' as y_numerator_id, '{d}' as y_denominator_id"
    for a, b, c, d in (
        (ACCTBAL, ONE, ONE, ORDERS),
        (AREA, POPULATION, ONE, ORDERS),
        (ORDERS, ORDERS, ACCTBAL, ONE),
        (ONE, POPULATION, POPULATION, POPULATION),
        (ONE, uuid(9), ACCTBAL, ONE),
    )
)

# --- registry: every supplier is one version of an indicator ----------------------------------

_SUP = "concat('00000000-0000-4000-9000-', lpad(cast({} as string), 12, '0'))"
_SUP_EXT = "concat('00000000-0000-4000-a000-', lpad(cast({0} - {0} % 3 as string), 12, '0'))"


def supplier_id(key: str) -> str:
    return _SUP.format(key)


REGISTRY_SQL = f"""
select concat('indicator ', cast(s_suppkey - s_suppkey % 3 as string)) as param_id,
       {supplier_id("s_suppkey")} as internal_id, {_SUP_EXT.format("s_suppkey")} as external_id,
       '{OWNER}' as owner,
       case s_suppkey % 10 when 0 then 'OUTDATED' when 1 then 'COPY IN PROGRESS' when 2 then 'TMP CREATED'
            when 3 then 'NEW' when 4 then 'NEW' when 5 then 'NEW' else 'READY' end as state,
       s_nationkey = 7 as is_base,
       case when s_suppkey % 13 <> 5 then shipped end as date,
       concat('u', cast(s_suppkey as string)) as upload_id,
       cast(case when s_suppkey % 4 = 0 then null else 8 end as int) as max_res,
       cast(null as string) as downscale
from {{supplier}} left join (select l_suppkey, max(l_shipdate) as shipped from {{lineitem}} group by l_suppkey) l
  on s_suppkey = l_suppkey
union all {SYSTEM_METADATA_SQL}
"""

REGISTRY_AXIS_SQL = f"""
select concat('indicator ', cast(s_suppkey - s_suppkey % 3 as string)) as numerator, 'one' as denominator,
       {supplier_id("s_suppkey")} as numerator_uuid, '{ONE}' as denominator_uuid,
       case when s_suppkey % 9 <> 4 then abs(s_acctbal) / 10000e0 end as quality,
       case when s_suppkey % 7 <> 3 then s_acctbal end as sum_value,
       case when s_suppkey % 7 <> 3 then 0.5e0 * s_acctbal end as min,
       case when s_suppkey % 7 <> 3 then 2e0 * s_acctbal end as max,
       s_suppkey % 6 <> 1 as has_transforms
from {{supplier}}
union all
select concat('indicator ', cast(s_suppkey - s_suppkey % 3 as string)),
       concat('indicator ', cast(s_suppkey - s_suppkey % 5 - (s_suppkey - s_suppkey % 5) % 3 as string)),
       {supplier_id("s_suppkey")}, {supplier_id("s_suppkey - s_suppkey % 5")},
       case when s_suppkey % 8 <> 4 then abs(s_acctbal) / 9000e0 end,
       case when s_suppkey % 7 <> 2 then s_acctbal end, null, null, s_suppkey % 6 <> 2
from {{supplier}} where s_suppkey % 5 <> 0
"""

REGISTRY_CORRELATION_SQL = f"""
select 0.25e0 as correlation, 0.5e0 as quality,
       {supplier_id("s_suppkey")} as x_numerator_id, '{ONE}' as x_denominator_id,
       {supplier_id("s_suppkey - 1")} as y_numerator_id, '{ONE}' as y_denominator_id
from {{supplier}} where s_suppkey % 4 = 3
"""

REGISTRY_OVERRIDES_SQL = f"""
select {_SUP_EXT.format("s_suppkey")} as numerator_id, '{ONE}' as denominator_id, s_acctbal as min,
       cast(null as double) as p25, case when s_suppkey % 2 = 0 then 7e0 end as p75, cast(null as double) as max,
       concat('label ', cast(s_suppkey as string)) as label, cast(null as string) as min_label,
       cast(null as string) as max_label, cast(null as string) as p25_label, cast(null as string) as p75_label
from {{supplier}} where s_suppkey % 3 = 0
union all
select concat('00000000-0000-4000-c000-', lpad(cast(s_suppkey as string), 12, '0')), '{ONE}', s_acctbal,
       null, null, null, null, null, null, null, null
from {{supplier}} where s_suppkey % 8 = 3
"""

#: uploads are single order lines, so a customer's cell occurs many times
STAGED_SQL = f"""
with {CELLS_SQL}
select concat('u', cast(l_suppkey as string)) as upload_id, h3, {supplier_id("l_suppkey")} as indicator_uuid,
       l_extendedprice as indicator_value
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join cells on o_custkey = k and r = 8
"""
#: the same with every other upload of the suppliers being copied empty
PARTLY_EMPTY_SQL = f"{STAGED_SQL}where l_suppkey % 20 <> 11\n"
UPLOAD_NAMES_SQL = """
select concat('tmp_stat_h3_u', cast(s_suppkey as string)) as table_name from {supplier} where s_suppkey % 10 = 1
union all select concat('tmp_stat_h3_x', cast(s_suppkey as string)) from {supplier} where s_suppkey % 10 = 2
union all select concat('backup_', cast(s_suppkey as string)) from {supplier}
"""
REGISTRY_FACTS_SQL = f"""
with {CELLS_SQL}
select h3, {supplier_id("l_suppkey")} as indicator_uuid, sum(l_quantity) as indicator_value
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join cells on o_custkey = k and r = 8
group by h3, l_suppkey
"""

# --- cell boundaries: hexagons of a planar lattice, in degrees ----------------------------------

_CORNERS = ((0, 2), (-1, 1), (-1, -1), (0, -2), (1, -1), (1, 1))
LATTICE_SQL = f"""
with {CELLS_SQL},
place as (select distinct h3, r, (h3 & cast({(1 << 52) - 1} as bigint)) >> cast(45 - 3 * r as int) as v from cells)
select h3, r, 2 * (v & cast(511 as bigint)) + (v >> 9) as kx, 3 * (v >> 9) as ky from place
"""
CORNERS_VALUES = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(_CORNERS))
AREA_OF_LATTICE_CELL = 6e-12

_TABLES = ("customer", "orders", "lineitem", "supplier")
#: customers whose rows one task puts into the cells of all resolutions
_TASK_CUSTOMERS = 20_000
_written: dict[tuple[str, str, str], DataFrame] = {}


def derive(spark: SparkSession, sf_dir: str, text: str, **prepared: DataFrame) -> DataFrame:
    """The rows of a text; ``prepared`` stands for the driver's tables of these names."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if "{" + t + "}" in text}
    return spark.sql(text, **(tables | prepared))


def spread_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers dealt by key to a number of partitions that grows with them.

    Their rows are joined with the cells of every resolution. Adaptive execution sizes the tasks of that join by the
    bytes it reads, before they become nine times as many; a number set here it leaves as it is.
    """
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    tasks = max(ceil(customers.count() / _TASK_CUSTOMERS), spark.sparkContext.defaultParallelism)
    return customers.repartition(tasks, "c_custkey")


def for_duckdb(text: str) -> str:
    return text.format(**{t: t for t in _TABLES})


def once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build a derived table at most once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table, in its on-disk layout."""

    def build() -> DataFrame:
        application = spark.sparkContext.applicationId
        path = f"{shared_folder(spark).rstrip('/')}/hexstats-{application}/facts-{sf_dir.strip('/').replace('/', '-')}"
        rows = derive(spark, sf_dir, FACTS_SQL, customer=spread_customers(spark, sf_dir))
        write_facts(rows, path, mode="overwrite")
        return read_facts(spark, path)

    return once(spark, sf_dir, "facts", build)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, METADATA_SQL)


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, OVERRIDES_SQL)


def empty_axis(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.AXIS)


def full_axis(rows: DataFrame) -> DataFrame:
    """Add the result columns that are still empty."""
    return empty_axis(rows.sparkSession).unionByName(rows, allowMissingColumns=True)


def registry_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, REGISTRY_AXIS_SQL)
    marked = rows.selectExpr(
        "* except (has_transforms)",
        f"case when has_transforms then cast(array() as {schemas.AXIS['transformations'].dataType.simpleString()})"
        " end as transformations",
    )
    return full_axis(marked)


def cell_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = ", ".join(
        f"named_struct('lon', (kx + {x}) * 1e-6, 'lat', (ky + {y}) * 1e-6)" for x, y in _CORNERS
    )

    def build() -> DataFrame:
        lattice = derive(spark, sf_dir, LATTICE_SQL)
        return stage(
            lattice.selectExpr("h3", f"array({corners}) as boundary", "4357449.416e0 / pow(7e0, r) as area_km2")
        )

    return once(spark, sf_dir, "cell_boundary", build)
