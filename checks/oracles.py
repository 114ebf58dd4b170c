"""SQL for DuckDB with the same result as each query of ``queries``."""

from __future__ import annotations

from checks import fixture as fx
from hexstats import schemas

# Fixed values, written out here so that the checks don't lean on the library: average cell area by
# resolution, and the ellipsoid.
AVG_AREA_KM2 = (
    4357449.416078383,
    609788.4417941332,
    86801.7803989972,
    12393.43465508816,
    1770.347654491307,
    252.9038581819449,
    36.12906216441245,
    5.161293359717191,
    0.7373275975944177,
    0.1053325134272067,
    0.01504750190766435,
    0.002149643129451879,
    0.000307091875631606,
    4.387026794728296e-05,
    6.267181135324313e-06,
    8.95311590760579e-07,
)
ECCENTRICITY_SQ = 0.0066943799901413165
AUTHALIC_RADIUS_KM = 6371.0071809
MERCATOR_RADIUS_M = 6378137.0

_E2 = f"{ECCENTRICITY_SQ!r}::double"
ONE, AREA, POP = fx.ONE, fx.AREA, fx.POPULATION
_PAIR = ", ".join(schemas.PAIR_KEYS)


def rnd(x: str) -> str:
    """Same rounding as ``queries.rounded``; NaN and infinity count as NULL."""
    safe = f"(case when isfinite({x}) then {x} end)"
    return (
        f"(case when abs({safe}) >= 1e6 then floor({safe} + 0.4877e0) when abs({safe}) >= 1e3"
        f" then floor({safe} * 1e2 + 0.4877e0) / 1e2 else floor({safe} * 1e6 + 0.4877e0) / 1e6 end + 0.0e0)"
    )


def rnds(*columns: str) -> str:
    return ", ".join(f"{rnd(c)} as {c}" for c in columns)


def cte(**parts: str) -> str:
    return ",\n".join(f"{name} as ({text})" for name, text in parts.items())


def res(cell: str) -> str:
    return f"(({cell} >> 52) & 15)"


def parent(cell: str) -> str:
    r = res(cell)
    return f"(({cell} - (1::bigint << 52)) | (7::bigint << (45 - 3 * {r})::int))"


_AVG_AREA = "[" + ", ".join(f"{a!r}::double" for a in AVG_AREA_KM2) + "]"


def avg_area(r: str) -> str:
    return f"{_AVG_AREA}[({r} + 1)::int]"


FACTS = cte(facts=fx.for_duckdb(fx.FACTS_SQL))
META = cte(metadata=fx.for_duckdb(fx.METADATA_SQL))
DORMANT = "('OUTDATED', 'TMP CREATED', 'COPY IN PROGRESS')"


def axis_pairs(metadata: str) -> str:
    return f"""select a.param_id as numerator, b.param_id as denominator,
      a.internal_id as numerator_uuid, b.internal_id as denominator_uuid
    from {metadata} a join {metadata} b on a.state not in {DORMANT} and b.state not in {DORMANT}
      and a.external_id <> b.external_id and b.is_base"""


AXES = cte(
    all_axes=axis_pairs("metadata"),
    axes=f"select * from all_axes where numerator_uuid not in ('{ONE}', '{AREA}')",
    overrides=fx.for_duckdb(fx.OVERRIDES_SQL),
)

# --- analytics ----------------------------------------------------------------------------------

STATS = cte(
    full_overrides="""select n.internal_id as numerator_uuid, d.internal_id as denominator_uuid
      from overrides o join metadata n on n.external_id = o.numerator_id
      join metadata d on d.external_id = o.denominator_id
      where o.min is not null and o.p25 is not null and o.p75 is not null and o.max is not null""",
    am=f"""select a.numerator_uuid, a.denominator_uuid, {res('n.h3')} as r,
        case when a.denominator_uuid = '{ONE}' then n.indicator_value
             else n.indicator_value / nullif(d.indicator_value, 0) end as m,
        o.numerator_uuid is not null as overridden,
        o.numerator_uuid is not null or a.numerator_uuid = '{POP}' or p.indicator_value is not null as counts
      from axes a join facts n on n.indicator_uuid = a.numerator_uuid
      left join facts d on d.indicator_uuid = a.denominator_uuid and d.h3 = n.h3
      left join facts p on p.indicator_uuid = '{POP}' and p.h3 = n.h3
      left join full_overrides o on o.numerator_uuid = a.numerator_uuid and o.denominator_uuid = a.denominator_uuid
      where a.denominator_uuid = '{ONE}' or d.h3 is not null""",
    stats="""select numerator_uuid, denominator_uuid, overridden, r::int as r,
        nullif(sum(m), 0) as sum, min(m) as min, max(m) as max, nullif(avg(m), 0) as mean,
        nullif(stddev_samp(m), 0) as stddev,
        case when not overridden then quantile_cont(m, 0.33) filter (counts) end as p33,
        quantile_cont(m, 0.5) filter (counts) as p50,
        case when not overridden then quantile_cont(m, 0.66) filter (counts) end as p66
      from am where m is not null
      group by grouping sets ((numerator_uuid, denominator_uuid, overridden, r),
                              (numerator_uuid, denominator_uuid, overridden))""",
)

def _axis_values(value: str, condition: str) -> str:
    return f"""select a.numerator_uuid, a.denominator_uuid, n.h3, {value} as m, p.h3 is not null as has_population
      from axes a join facts n on n.indicator_uuid = a.numerator_uuid
      left join facts d on d.indicator_uuid = a.denominator_uuid and d.h3 = n.h3
      left join facts p on p.indicator_uuid = '{POP}' and p.h3 = n.h3 where {condition}"""


def _values_query(value: str, condition: str, columns: str = "") -> str:
    return f"""with {FACTS}, {META}, {AXES}, v as ({_axis_values(value, condition)})
      select numerator_uuid, denominator_uuid, h3, {rnds('m')}{columns} from v where m is not null"""


_LITERAL_ONE = f"when '{ONE}' then n.indicator_value"
_PER_CELL = "n.indicator_value / nullif(d.indicator_value, 0)"
WITH_STATS = f"with {FACTS}, {META}, {AXES}, {STATS}"


def spread(low: str, high: str) -> str:
    return (
        f"case when {low} = 0 or {high} = 0 then null when {high} / {low} > 0 then log10({high} / {low})"
        f" else log10(({high} - {low}) / least(abs({low}), abs({high}))) end"
    )


_LONG = cte(
    long=" union all ".join(
        f"select numerator_uuid, denominator_uuid, r, '{k}' as key, {k} as stat from stats"
        for k in ("sum", "min", "max", "mean", "stddev", "p33", "p50", "p66")
    ),
    spreads=f"""select numerator_uuid, denominator_uuid, key, value,
        case when value is not null then {spread('low', 'high')} end as quality
      from (select numerator_uuid, denominator_uuid, key, max(case when r = 8 then stat end) as value,
                   min(stat) as low, max(stat) as high from long group by 1, 2, 3)""",
)
_WIDE = cte(
    wide="select numerator_uuid, denominator_uuid, "
    + ", ".join(
        f"max(case when key = '{'p50' if s == 'median' else s}' then {part} end) as {s}_{part}"
        for s in schemas.STATISTICS
        for part in ("value", "quality")
    )
    + " from spreads group by 1, 2",
    overall="""select numerator_uuid, denominator_uuid, mean as mean_all_res, stddev as stddev_all_res,
        case when not overridden then min end as min, p33 as p25, p66 as p75,
        case when not overridden then max end as max from stats where r is null""",
    measured="""select a.numerator_uuid, a.denominator_uuid, w.* exclude (numerator_uuid, denominator_uuid),
        o.* exclude (numerator_uuid, denominator_uuid)
      from all_axes a left join wide w using (numerator_uuid, denominator_uuid)
      left join overall o using (numerator_uuid, denominator_uuid)""",
)
_ANALYTIC_COLUMNS = [f"{s}_{p}" for s in schemas.STATISTICS for p in ("value", "quality")] + [
    "mean_all_res", "stddev_all_res", "min", "p25", "p75", "max",
]

# --- quality ------------------------------------------------------------------------------------


def rel(a: str, b: str) -> str:
    return f"abs({a} - {b}) / nullif(abs({a}) + abs({b}), 0)"


QUALITY = cte(
    children=f"""select indicator_uuid, {parent('h3')} as h3, sum(indicator_value) as csum,
        avg(indicator_value) as cavg
      from facts where {res('h3')} between 1 and 5 group by 1, 2""",
    rated=f"""select a.numerator_uuid, a.denominator_uuid, n.indicator_value as nv, b.csum, b.cavg,
        case a.denominator_uuid when '{ONE}' then 1.0 when '{AREA}' then {avg_area(res('n.h3'))}
             else c.indicator_value end as here,
        case a.denominator_uuid when '{ONE}' then 1.0 when '{AREA}' then {avg_area(res('n.h3') + ' + 1')}
             else d.csum / 7 end as below,
        a.denominator_uuid in ('{ONE}', '{AREA}') as system
      from axes a join facts n on n.indicator_uuid = a.numerator_uuid
      join children b on b.indicator_uuid = n.indicator_uuid and b.h3 = n.h3
      left join facts c on c.indicator_uuid = a.denominator_uuid and c.h3 = n.h3
      left join children d on d.indicator_uuid = a.denominator_uuid and d.h3 = n.h3
      where a.denominator_uuid in ('{ONE}', '{AREA}') or {res('n.h3')} between 1 and 5""",
    normed="""select *, nv / nullif(here, 0) as actual, csum / 7 / nullif(below, 0) as via_sum,
        cavg / nullif(below, 0) as via_avg from rated""",
    scores=f"""select numerator_uuid, denominator_uuid,
        1 - avg({rel('actual', 'via_avg')}) as zoom_avg, 1 - avg({rel('actual', 'via_sum')}) as zoom_sum,
        1 - avg({rel('nv', 'cavg')}) as num_avg, 1 - avg({rel('nv', 'csum')}) as num_sum,
        case when bool_or(system) then 1.0 else count(here)::double / nullif(count(*), 0) end as fill
      from normed group by 1, 2""",
    qualities="""select a.numerator_uuid, a.denominator_uuid,
        coalesce(case when num_avg > num_sum then zoom_avg else zoom_sum end * fill, 0) as quality
      from axes a left join scores using (numerator_uuid, denominator_uuid)""",
)
WITH_QUALITY = f"with {FACTS}, {META}, {AXES}, {QUALITY}"


def _quality(condition: str) -> str:
    return f"{WITH_QUALITY} select numerator_uuid, denominator_uuid, {rnds('quality')} from qualities where {condition}"


# --- transformations ----------------------------------------------------------------------------

WITH_MEASURED = f"with {FACTS}, {META}, {AXES}, {STATS}, {_LONG}, {_WIDE}, {QUALITY}"


def _transform_ctes(layer_min: str = "min") -> str:
    return cte(
        layer=f"""select m.numerator_uuid, m.denominator_uuid, {layer_min} as layer_min,
            mean_all_res as layer_mean, stddev_all_res as layer_stddev
          from measured m join qualities q using (numerator_uuid, denominator_uuid) where q.quality >= 0.5""",
        tm="""select l.*, n.indicator_value / nullif(d.indicator_value, 0) as m
          from layer l join facts n on n.indicator_uuid = l.numerator_uuid
          join facts d on d.indicator_uuid = l.denominator_uuid and d.h3 = n.h3""",
        centre="""select numerator_uuid, denominator_uuid, stddev_samp(m) as new_stddev, avg(m) as new_mean
          from tm where m between layer_mean - 3 * layer_stddev and layer_mean + 3 * layer_stddev group by 1, 2""",
        ordered="""select numerator_uuid, denominator_uuid, m,
            row_number() over (partition by numerator_uuid, denominator_uuid order by m) as rn,
            count(*) over (partition by numerator_uuid, denominator_uuid) as n
          from tm where m is not null""",
        places="""select numerator_uuid, denominator_uuid, i::int as i,
            greatest(1, ceil(i::double / 100 * n))::bigint as rn
          from (select distinct numerator_uuid, denominator_uuid, n from ordered) cross join range(101) t(i)""",
        hist="""select l.*, new_mean, new_stddev, i, m as x
          from places join ordered using (numerator_uuid, denominator_uuid, rn)
          join layer l using (numerator_uuid, denominator_uuid)
          left join centre using (numerator_uuid, denominator_uuid)""",
        domain="""select numerator_uuid, denominator_uuid,
            coalesce(min(x - layer_min + 2.220446049250313e-16) < 0, false) as needs_analytics,
            coalesce(bool_or(x - layer_min + 1 = 0 or x - layer_min + 2.220446049250313e-16 = 0), false) as zero
          from hist group by 1, 2""",
        usable="""select h.*, x between new_mean - 3 * new_stddev and new_mean + 3 * new_stddev as near_centre,
            x between layer_mean - 3 * layer_stddev and layer_mean + 3 * layer_stddev as near_layer
          from hist h join domain using (numerator_uuid, denominator_uuid) where not needs_analytics and not zero""",
        forms=" union all ".join(
            f"select numerator_uuid, denominator_uuid, '{name}' as transformation, i, {t} as t,"
            " near_centre, near_layer from usable"
            for name, t in (
                ("no", "x"),
                ("square_root", "sign(x) * sqrt(abs(x))"),
                ("cube_root", "cbrt(x)"),
                ("log", "log10(x - layer_min + 1)"),
                ("log_epsilon", "log10(x - layer_min + 2.220446049250313e-16)"),
            )
        ),
        tstats="""select numerator_uuid, denominator_uuid, transformation, count(*) filter (near_centre) as n,
            min(t) filter (near_layer) as low, max(t) filter (near_layer) as high,
            stddev_samp(t) filter (near_centre) as stddev, avg(t) filter (near_centre) as mean
          from forms group by 1, 2, 3""",
        skews="""select f.numerator_uuid, f.denominator_uuid, f.transformation,
            n::double / nullif(n - 1, 0) / nullif(n - 2, 0)
              * sum(pow((t - mean) / (stddev + 2.220446049250313e-16), 3)) filter (t between low and high) as skew
          from forms f join tstats s using (numerator_uuid, denominator_uuid, transformation) group by 1, 2, 3, n""",
        transforms="""select numerator_uuid, denominator_uuid, transformation, stddev, mean, high as debug_max,
            greatest(low, mean - 3 * stddev) as lower_bound, least(high, mean + 3 * stddev) as upper_bound, skew
          from tstats join skews using (numerator_uuid, denominator_uuid, transformation)""",
        best="""select * exclude (place) from (select *, row_number() over (
              partition by numerator_uuid, denominator_uuid
              order by abs(skew) asc nulls last, transformation <> 'no', transformation) as place
            from transforms) where place = 1""",
    )


WITH_TRANSFORMS = f"{WITH_MEASURED}, {_transform_ctes()}"
_TRANSFORM_VALUES = ("stddev", "mean", "debug_max", "lower_bound", "upper_bound", "skew")

# --- correlations -------------------------------------------------------------------------------


def candidate_pairs(metadata: str, axis: str) -> str:
    """Well-rated axes of live indicators first, then their combinations."""
    live = f"state not in {DORMANT}"
    good = f"""(select distinct numerator_uuid, denominator_uuid, external_id, is_base
        from {axis} join {metadata} on internal_id = numerator_uuid and {live}
        where {axis}.quality > .5 and denominator_uuid in (select internal_id from {metadata} where {live}))"""
    return f"""select x.numerator_uuid as x_numerator_id, x.denominator_uuid as x_denominator_id,
        y.numerator_uuid as y_numerator_id, y.denominator_uuid as y_denominator_id
      from {good} x join {good} y on x.external_id <> y.external_id and x.numerator_uuid <> y.numerator_uuid
      where not x.is_base"""


def pruned(pairs: str) -> str:
    """Without the pairs whose mirror is there too and begins with the larger numerator."""
    return f"""select p.* from {pairs} p anti join {pairs} m
      on m.x_numerator_id > p.x_numerator_id
        and m.x_numerator_id = p.y_numerator_id and m.x_denominator_id = p.y_denominator_id
        and m.y_numerator_id = p.x_numerator_id and m.y_denominator_id = p.x_denominator_id"""


CORRELATION = cte(
    pairs=candidate_pairs("metadata", "qualities"),
    kept=pruned("pairs"),
    cm=f"""select a.numerator_uuid, a.denominator_uuid, n.h3,
        case a.denominator_uuid when '{ONE}' then n.indicator_value
          when '{AREA}' then n.indicator_value / {avg_area(res('n.h3'))}
          else n.indicator_value / nullif(d.indicator_value, 0) end as m
      from axes a join facts n on n.indicator_uuid = a.numerator_uuid
      left join facts d on d.indicator_uuid = a.denominator_uuid and d.h3 = n.h3
      where a.denominator_uuid in ('{ONE}', '{AREA}') or d.h3 is not null""",
    correlations=f"""select {_PAIR}, corr(x.m, y.m) as correlation from kept
      left join (cm x join cm y on x.h3 = y.h3) on x.numerator_uuid = x_numerator_id
        and x.denominator_uuid = x_denominator_id and y.numerator_uuid = y_numerator_id
        and y.denominator_uuid = y_denominator_id
      group by all""",
)

# --- registry -----------------------------------------------------------------------------------

REGISTRY = cte(
    registry=fx.for_duckdb(fx.REGISTRY_SQL),
    raxis=fx.for_duckdb(fx.REGISTRY_AXIS_SQL),
    known=fx.for_duckdb(fx.REGISTRY_CORRELATION_SQL),
)
WITH_REGISTRY = f"with {REGISTRY}"
OPEN_PAIRS = cte(
    open_pairs=f"""{candidate_pairs('registry', 'raxis')} except select {_PAIR} from known"""
)
_LIVE = f"select internal_id from registry where state not in {DORMANT}"
_OPEN_AXES = (
    f"raxis where numerator_uuid not in ('{ONE}', '{AREA}') and numerator_uuid in ({_LIVE}) "
    f"and denominator_uuid in ({_LIVE})"
)
WORK = cte(
    work=f"""select 'quality' as kind, numerator_uuid as x_num, denominator_uuid as x_den,
        null::varchar as y_num, null::varchar as y_den from {_OPEN_AXES} and quality is null
      union all select 'analytics', numerator_uuid, denominator_uuid, null, null from {_OPEN_AXES} and sum_value is null
      union all select 'transformations', numerator_uuid, denominator_uuid, null, null from {_OPEN_AXES}
        and not has_transforms and coalesce(quality, 1) >= 0.5
      union all select 'max_resolution', internal_id, null, null, null from registry
        where state not in {DORMANT} and max_res is null and internal_id not in ('{ONE}', '{AREA}')
          and exists (select 1 from raxis where numerator_uuid = internal_id)
      union all select 'correlations', {_PAIR} from open_pairs"""
)
WITH_WORK = f"{WITH_REGISTRY}, {OPEN_PAIRS}, {WORK}"
PUBLISH = cte(
    busy="select distinct x_num as internal_id from work where kind <> 'correlations' and x_num is not null",
    switched=f"""select *, case when state not in {DORMANT} and internal_id not in (select internal_id from busy)
          and external_id in (select external_id from registry where state = 'NEW'
            and internal_id not in (select internal_id from busy)
            and exists (select 1 from raxis where numerator_uuid = internal_id))
        then case state when 'READY' then 'OUTDATED' else 'READY' end else state end as new_state from registry""",
    settled="""select *, case when new_state = 'READY' and row_number() over (partition by external_id, new_state
          order by date desc nulls first, internal_id desc) > 1 then 'OUTDATED' else new_state end as final
        from switched""",
)
MIRRORED = cte(
    mirrored=f"""select correlation, {_PAIR} from known union
      select correlation, y_numerator_id, y_denominator_id, x_numerator_id, x_denominator_id from known""",
    scored=f"""select correlation, 1 - ((1 - x.quality) * (1 - y.quality)) as quality, {_PAIR}
      from mirrored join raxis x on x.numerator_uuid = x_numerator_id and x.denominator_uuid = x_denominator_id
      join raxis y on y.numerator_uuid = y_numerator_id and y.denominator_uuid = y_denominator_id""",
)
LATTICE = cte(lattice=fx.for_duckdb(fx.LATTICE_SQL))
EDGES = cte(
    levels=f"""select indicator_uuid, max(case when n <= 1000 then r end) as coverage_res from (
        select indicator_uuid, {res('h3')} as r, count(*) as n from facts
        where indicator_uuid not in ('{ONE}', '{AREA}') group by 1, 2) group by 1""",
    covered=f"""select distinct l.indicator_uuid, kx, ky from levels l join facts f on f.indicator_uuid = l.indicator_uuid
        and {res('f.h3')} = coverage_res join lattice using (h3)""",
    sides=f"""select indicator_uuid, kx + a.x as x1, ky + a.y as y1, kx + b.x as x2, ky + b.y as y2
      from covered cross join (values {fx.CORNERS_VALUES}) a(i, x, y)
      join (values {fx.CORNERS_VALUES}) b(i, x, y) on b.i = (a.i + 1) % 6""",
    outline="""select indicator_uuid, any_value(x1) as x1, any_value(y1) as y1, any_value(x2) as x2, any_value(y2) as y2
      from sides group by indicator_uuid, least((x1, y1), (x2, y2)), greatest((x1, y1), (x2, y2)) having count(*) = 1""",
)
_DATED = "date < timestamp '" + fx.NOW + "' - interval 1 minute"
_UPLOADS = cte(
    names=fx.for_duckdb(fx.UPLOAD_NAMES_SQL),
    uploads="""select internal_id, upload_id from registry
      where upload_id in (select regexp_replace(table_name, '^tmp_stat_h3_', '') from names
                          where starts_with(table_name, 'tmp_stat_h3_'))""",
    staged=fx.for_duckdb(fx.STAGED_SQL),
)
_DEDUP = """select upload_id, h3, max(indicator_uuid) as indicator_uuid, max(indicator_value) as indicator_value
  from staged group by 1, 2"""
DRIFT = cte(
    versions=f"""select n.internal_id, arg_min(p.internal_id, p.date) as previous_id
      from metadata n join metadata p on p.external_id = n.external_id and p.internal_id <> n.internal_id
        and p.date < n.date and p.state not in {DORMANT} where n.state = 'NEW' group by 1""",
    joined="""select v.internal_id, v.previous_id, a.indicator_value as a, null::double as b, h3
        from versions v join facts a on a.indicator_uuid = v.internal_id
      union all select v.internal_id, v.previous_id, null, b.indicator_value, h3
        from versions v join facts b on b.indicator_uuid = v.previous_id""",
    cells="select internal_id, previous_id, h3, max(a) as a, max(b) as b from joined group by 1, 2, 3",
    drifts="""select internal_id, previous_id, regr_slope(a, nullif(b, 0)) as slope,
        regr_intercept(a, nullif(b, 0)) as intercept, count(a)::double / nullif(count(b), 0) as fill_ratio
      from cells group by 1, 2""",
    judged="""select *, coalesce(slope between 0.999 and 1.001 and intercept between -0.01 and 0.01
        and fill_ratio between 0.99 and 1.01, false) as discard from drifts""",
)
_OUTDATED = "(select internal_id from registry where state = 'OUTDATED')"
_OVERRIDES = cte(roverrides=fx.for_duckdb(fx.REGISTRY_OVERRIDES_SQL))


def _round4(*columns: str) -> str:
    return ", ".join(f"round({c}, 4) + 0.0 as {c}" for c in columns)


ORACLES: dict[str, str] = {
    "axis_values_analytics": _values_query(
        f"case a.denominator_uuid {_LITERAL_ONE} else {_PER_CELL} end",
        f"a.denominator_uuid = '{ONE}' or d.h3 is not null", ", has_population",
    ),
    "axis_values_stored": _values_query(_PER_CELL, "d.h3 is not null"),
    "axis_values_correlation": _values_query(
        f"case a.denominator_uuid {_LITERAL_ONE} when '{AREA}' then n.indicator_value / {avg_area(res('n.h3'))}"
        f" else {_PER_CELL} end",
        f"a.denominator_uuid in ('{ONE}', '{AREA}') or d.h3 is not null",
    ),
    "axis_statistics": f"""{WITH_STATS} select numerator_uuid, denominator_uuid, r,
        {rnds('sum', 'min', 'max', 'mean', 'stddev')} from stats""",
    "axis_stops": f"{WITH_STATS} select numerator_uuid, denominator_uuid, r, {rnds('p33', 'p50', 'p66')} from stats",
    "stat_quality": f"""{WITH_STATS}, {_LONG}
        select numerator_uuid, denominator_uuid, key, {rnds('value', 'quality')} from spreads""",
    "axis_analytics": f"""{WITH_STATS}, {_LONG}, {_WIDE}
        select numerator_uuid, denominator_uuid, {rnds(*_ANALYTIC_COLUMNS)} from measured""",
    "quality_one": _quality(f"denominator_uuid = '{ONE}'"),
    "quality_area": _quality(f"denominator_uuid = '{AREA}'"),
    "quality_user": _quality(f"denominator_uuid not in ('{ONE}', '{AREA}')"),
    "downscale": f"""{WITH_QUALITY} select internal_id, case when a.quality > o.quality then 'proportional'
          when a.quality is not null and o.quality is not null then 'equal' end as downscale
        from metadata left join qualities a on a.numerator_uuid = internal_id and a.denominator_uuid = '{AREA}'
        left join qualities o on o.numerator_uuid = internal_id and o.denominator_uuid = '{ONE}'""",
    "histogram_points": f"""{WITH_TRANSFORMS}
        select numerator_uuid, denominator_uuid, i, {rnds('new_mean', 'new_stddev', 'x')} from hist""",
    "transform_points": f"""{WITH_TRANSFORMS}
        select numerator_uuid, denominator_uuid, transformation, i, {rnds('t')}, near_centre, near_layer from forms""",
    "transform_stats": f"""{WITH_TRANSFORMS}
        select numerator_uuid, denominator_uuid, transformation, {rnds(*_TRANSFORM_VALUES)} from transforms""",
    "best_transform": f"""{WITH_TRANSFORMS}
        select numerator_uuid, denominator_uuid, transformation, {rnds(*_TRANSFORM_VALUES)} from best""",
    "transform_result": f"""{WITH_TRANSFORMS}
        select numerator_uuid, denominator_uuid, b.transformation as default_transformation,
          (case t.transformation when 'no' then 0 when 'square_root' then 1 when 'cube_root' then 2
             when 'log' then 3 else 4 end)::int as place,
          t.transformation, 101::int as points, {rnd('t.skew')} as skew
        from transforms t join best b using (numerator_uuid, denominator_uuid)""",
    "transform_repair": f"""{WITH_MEASURED},
        {_transform_ctes(f"case when m.denominator_uuid = '{ONE}' then max / 2 else min end")}
        select numerator_uuid, denominator_uuid from domain where needs_analytics""",
    "axis_candidates": f"""{WITH_REGISTRY} select * from ({axis_pairs('registry')}) c
        where not exists (select 1 from raxis a where a.numerator_uuid = c.numerator_uuid
                          and a.denominator_uuid = c.denominator_uuid)""",
    "new_indicators": f"""{WITH_REGISTRY} select distinct numerator_uuid as indicator_uuid
        from ({axis_pairs('registry')}) c join registry on numerator_uuid = internal_id and state = 'NEW'
        where not exists (select 1 from raxis a where a.numerator_uuid = c.numerator_uuid
                          and a.denominator_uuid = c.denominator_uuid)""",
    "correlation_candidates": f"{WITH_REGISTRY}, {OPEN_PAIRS} select {_PAIR} from open_pairs",
    "correlation_prune": f"{WITH_REGISTRY}, {OPEN_PAIRS} {pruned('open_pairs')}",
    "correlation_special": f"""with {FACTS}, {META}, pairs as ({fx.for_duckdb(fx.SPECIAL_PAIRS_SQL)}), special as (
          select '{fx.ACCTBAL}' as num, '{ONE}' as den, h3, indicator_value as m from facts
            where indicator_uuid = '{fx.ACCTBAL}'
          union all select case i when 0 then '{ONE}' when 1 then '{AREA}' else indicator_uuid end, indicator_uuid, h3,
            case i when 0 then 1 when 1 then {avg_area(res('h3'))} else indicator_value end / nullif(indicator_value, 0)
            from facts cross join range(3) t(i) where indicator_uuid in ('{fx.ORDERS}', '{fx.POPULATION}')
        ) select {_PAIR}, {rnd('''case when var_pop(x.m) > 0 and var_pop(y.m) > 0 then corr(x.m, y.m) end''')} as correlation
        from pairs left join (special x join special y on x.h3 = y.h3 and x.m is not null and y.m is not null)
          on x.num = x_numerator_id and x.den = x_denominator_id and y.num = y_numerator_id and y.den = y_denominator_id
        group by all""",
    "axis_correlation": f"{WITH_QUALITY}, {CORRELATION} select {_PAIR}, {rnds('correlation')} from correlations",
    "correlation_rows": f"""{WITH_QUALITY}, {CORRELATION}, both_ways as (select {_PAIR}, correlation from correlations
        union all select y_numerator_id, y_denominator_id, x_numerator_id, x_denominator_id, correlation from correlations)
      select {_PAIR}, {rnds('correlation', 'quality')} from (
        select b.*, 1 - (1 - x.quality) * (1 - y.quality) as quality from both_ways b
        join qualities x on x.numerator_uuid = x_numerator_id and x.denominator_uuid = x_denominator_id
        join qualities y on y.numerator_uuid = y_numerator_id and y.denominator_uuid = y_denominator_id)""",
    "missing_pairs": f"""{WITH_REGISTRY}, {OPEN_PAIRS}, told as (
        select {_PAIR} from open_pairs where (x_numerator_id, x_denominator_id) > (y_numerator_id, y_denominator_id)
        union select y_numerator_id, y_denominator_id, x_numerator_id, x_denominator_id from open_pairs
          where (x_numerator_id, x_denominator_id) < (y_numerator_id, y_denominator_id))
      select {_PAIR}, {rnds('qualities')} from (select t.*, x.quality + y.quality as qualities from told t
        join raxis x on x.numerator_uuid = x_numerator_id and x.denominator_uuid = x_denominator_id
        join raxis y on y.numerator_uuid = y_numerator_id and y.denominator_uuid = y_denominator_id)""",
    "correlation_score": f"{WITH_REGISTRY}, {MIRRORED} select {_PAIR}, correlation, {rnds('quality')} from scored",
    "correlation_upsert": f"""{WITH_REGISTRY}, {MIRRORED}
        select {_PAIR}, correlation * 2 as correlation, {rnds('quality')} from scored
        union all select {_PAIR}, correlation, quality from known k where not exists (select 1 from scored s
          where s.x_numerator_id = k.x_numerator_id and s.x_denominator_id = k.x_denominator_id
            and s.y_numerator_id = k.y_numerator_id and s.y_denominator_id = k.y_denominator_id)""",
    "grid_functions": f"""with {FACTS} select h3, {res('h3')}::int as resolution,
          case when {res('h3')} >= 1 then {parent('h3')} end as parent,
          {rnd(avg_area(res('h3')))} as average_area from (select distinct h3 from facts)""",
    "cell_area": f"""with {LATTICE},
        corners as (select h3, i, radians((kx + x) * 1e-6) as lam, radians((ky + y) * 1e-6) as phi
          from lattice cross join (values {fx.CORNERS_VALUES}) c(i, x, y)),
        authalic as (select h3, i, lam, tan((phi
            - sin(phi * 2) * ({_E2} / 3 + 31 * {_E2} * {_E2} / 180 + 59 * {_E2} * {_E2} * {_E2} / 560)
            + sin(phi * 4) * (17 * {_E2} * {_E2} / 360 + 61 * {_E2} * {_E2} * {_E2} / 1260)
            - sin(phi * 6) * (383 * {_E2} * {_E2} * {_E2} / 45360)) / 2) as t from corners)
        select a.h3, round(abs(sum(2 * atan2(tan((b.lam - a.lam) / 2) * (a.t + b.t), 1 + a.t * b.t)))
          * {AUTHALIC_RADIUS_KM!r} * {AUTHALIC_RADIUS_KM!r} * 1e9, 3) as area
        from authalic a join authalic b on a.h3 = b.h3 and b.i = (a.i + 1) % 6 group by 1""",
    "system_metadata": f"""{WITH_REGISTRY} select param_id, internal_id, external_id,
          case when internal_id in ('{ONE}', '{AREA}') then 'NEW' else state end as state, is_base, max_res
        from registry""",
    "missing_cells": f"""with {FACTS} select h3, bool_or(indicator_uuid = '{AREA}') as has_area from facts
        where {res('h3')} <= 8 group by h3
        having bool_or(indicator_uuid not in ('{ONE}', '{AREA}')) and not bool_or(indicator_uuid = '{ONE}')""",
    "missing_cells_of_new": f"""with {FACTS} select h3, bool_or(indicator_uuid = '{AREA}') as has_area from facts
        where {res('h3')} <= 8 group by h3
        having bool_or(indicator_uuid = '{fx.POPULATION}') and not bool_or(indicator_uuid = '{ONE}')""",
    "system_fill": f"""with {FACTS}, missing as (
          select h3 from facts where indicator_uuid not in ('{ONE}', '{AREA}') and {res('h3')} <= 8
          except select h3 from facts where indicator_uuid = '{ONE}')
        select h3, '{ONE}' as indicator_uuid, 1.0::double as indicator_value from missing
        union all select h3, '{AREA}', {rnd(f"4357449.416e0 / pow(7e0, {res('h3')})")} from missing
        where h3 not in (select h3 from facts where indicator_uuid = '{AREA}')""",
    "max_resolution": f"""with {FACTS} select indicator_uuid, max(r)::int as max_res,
          max(case when n <= 1000 then r end)::int as coverage_res
        from (select indicator_uuid, {res('h3')} as r, count(*) as n from facts
              where indicator_uuid not in ('{ONE}', '{AREA}') group by 1, 2) group by 1""",
    "coverage_edges": f"with {FACTS}, {LATTICE}, {EDGES} select indicator_uuid, x1, y1, x2, y2 from outline",
    "coverage_outline": f"""with {FACTS}, {LATTICE}, {EDGES} select indicator_uuid, vertices, cells
        from (select indicator_uuid, count(*) as vertices from outline group by 1)
        join (select indicator_uuid, count(*) as cells from covered group by 1) using (indicator_uuid)""",
    # corners less sides plus cells of an area are its pieces less its holes
    "coverage_polygons": f"""with {FACTS}, {LATTICE}, {EDGES},
        corners as (select indicator_uuid, count(distinct (x1, y1)) as n,
          count(distinct (least((x1, y1), (x2, y2)), greatest((x1, y1), (x2, y2)))) as sides from sides group by 1)
        select indicator_uuid, n - sides + cells as shells_less_holes, vertices, cells
        from corners join (select indicator_uuid, count(*) as vertices from outline group by 1) using (indicator_uuid)
        join (select indicator_uuid, count(*) as cells from covered group by 1) using (indicator_uuid)""",
    "cell_geometry": f"""with {FACTS}, {META}, {LATTICE}
        select h3, r::int as resolution, i::int as i,
          round(radians((kx + x) * 1e-6) * {MERCATOR_RADIUS_M!r}, 3) + 0.0 as x,
          round(ln(tan(radians((ky + y) * 1e-6) / 2 + 3.141592653589793::double / 4)) * {MERCATOR_RADIUS_M!r}, 3) + 0.0 as y
        from lattice cross join (values {fx.CORNERS_VALUES}) c(i, x, y)
        where r between 3 and 8 and h3 in (select h3 from facts where indicator_uuid in (
          select internal_id from metadata where date > timestamp '{fx.NOW}' - interval 150 day))""",
    "drift_check": f"""with {FACTS}, {META}, {DRIFT}
        select internal_id, previous_id, {_round4('slope', 'intercept', 'fill_ratio')}, discard from judged""",
    "drift_discard": f"""with {FACTS}, {META}, {DRIFT} select m.internal_id,
          case when discard then 'OUTDATED' else state end as state
        from metadata m left join judged using (internal_id)""",
    "previous_versions": f"""{WITH_REGISTRY} select n.internal_id,
          min(struct_pack(d := p.date, i := p.internal_id)).i as previous_id
        from registry n join registry p on p.external_id = n.external_id and p.internal_id <> n.internal_id
          and p.date < n.date and p.state not in {DORMANT} where n.state = 'NEW' group by 1""",
    "staging_discovery": f"{WITH_REGISTRY}, {_UPLOADS} select internal_id, upload_id from uploads",
    "ingest_dedup": f"with {cte(staged=fx.for_duckdb(fx.STAGED_SQL))} {_DEDUP}",
    "ingest_rows": f"""{WITH_REGISTRY}, {_UPLOADS} select h3, indicator_uuid, indicator_value from ({_DEDUP})
        where upload_id in (select upload_id from uploads)""",
    "ingest_states": f"""{WITH_REGISTRY}, {_UPLOADS}, {cte(filled=fx.for_duckdb(fx.PARTLY_EMPTY_SQL))} select internal_id,
          case when upload_id in (select upload_id from uploads) then
            case when upload_id in (select upload_id from filled) then 'NEW' else 'OUTDATED' end
          else state end as state from registry""",
    "publish_states": f"""{WITH_WORK}, {PUBLISH} select param_id, internal_id, external_id, state as old_state,
          final as state from settled where final <> state""",
    "latest_ready": f"""{WITH_REGISTRY} select internal_id, external_id,
          case when state = 'READY' and row_number() over (partition by external_id, state
            order by date desc nulls first, internal_id desc) > 1 then 'OUTDATED' else state end as state from registry""",
    "unfinished_work": f"{WITH_WORK} select * from work",
    "unfinished_recorded": f"""{WITH_WORK} select * from work
        where kind <> 'analytics' or right(x_num, 1) not in ('0', '5')""",
    "indicators_with_work": f"""{WITH_WORK} select distinct i as indicator_uuid from (
          select x_num as i from work union all select x_den from work
          union all select y_num from work union all select y_den from work) where i is not null""",
    "important_work": f"""{WITH_WORK} select distinct x_num as indicator_uuid from work
        where kind <> 'correlations' and x_num is not null""",
    "axis_overrides": f"""{WITH_REGISTRY}, {_OVERRIDES}, given as (
          select n.internal_id as num, d.internal_id as den, o.* from roverrides o
          join registry n on n.external_id = o.numerator_id join registry d on d.external_id = o.denominator_id)
        select numerator_uuid, denominator_uuid, coalesce(g.min, a.min) as min, coalesce(g.max, a.max) as max,
          g.p25 as p25, g.p75 as p75, g.label as label, g.min_label as min_label
        from raxis a left join given g on g.num = numerator_uuid and g.den = denominator_uuid""",
    "orphan_overrides": f"""{WITH_REGISTRY}, {_OVERRIDES} select numerator_id, denominator_id, min from roverrides
        where numerator_id not in (select external_id from registry where state <> 'OUTDATED')
           or denominator_id not in (select external_id from registry where state <> 'OUTDATED')""",
    "purge_facts": f"""{WITH_REGISTRY}, rfacts as ({fx.for_duckdb(fx.REGISTRY_FACTS_SQL)})
        select * from rfacts where indicator_uuid not in {_OUTDATED}""",
    "purge_axes": f"""{WITH_REGISTRY} select numerator_uuid, denominator_uuid from raxis
        where numerator_uuid not in {_OUTDATED} and denominator_uuid not in {_OUTDATED}""",
    "purge_correlations": f"{WITH_REGISTRY} select {_PAIR} from known where "
    + " and ".join(f"{k} not in {_OUTDATED}" for k in schemas.PAIR_KEYS),
    "purge_metadata": f"{WITH_REGISTRY} select internal_id, state from registry where state <> 'OUTDATED'",
    "failed_uploads": f"""{WITH_REGISTRY} select param_id, internal_id, external_id from registry
        where state = 'COPY IN PROGRESS' and {_DATED}""",
    "inactive_ids": f"""{WITH_REGISTRY} select distinct {fx.supplier_id('l_suppkey * 2')} as internal_id from lineitem
        where {fx.supplier_id('l_suppkey * 2')} not in (
          select internal_id from registry where state not in ('OUTDATED', 'COPY IN PROGRESS'))""",
    "active_indicators": f"{WITH_REGISTRY} {_LIVE}",
    "report_by_state": f"{WITH_REGISTRY} select state, count(*) as indicators from registry group by 1",
    "unfinished_by_kind": f"{WITH_WORK} select kind, count(*) as open from work group by 1 order by open desc, kind",
    "unfinished_by_indicator": f"{WITH_WORK} select x_num as indicator_uuid, count(*) as open from work group by 1",
    "latest_upload": f"{WITH_REGISTRY} select max(date) as latest_indicator_upload from registry",
}
