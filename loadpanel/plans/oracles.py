"""DuckDB SQL that states each query's result independently of the Spark plans.

Folds are written as plain range joins and ridge as its closed form here, so
that the arithmetic shortcuts of the Spark side are checked and not repeated.
"""

from __future__ import annotations

OBS_D = """obs as (
  select l_returnflag as entity_id, l_shipdate as ts_utc, 'D' as series_type,
         cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as value
  from lineitem group by all
  union all
  select l_returnflag, l_shipdate, 'DF',
         cast(sum(cast(l_extendedprice as decimal(12,2))
                  * (100 - cast(round(l_discount * 100) as int))
                  * (100 + cast(round(l_tax * 100) as int))) as double) / 10000
  from lineitem group by all)"""

OBS_H = """obs as (
  select event_type as entity_id, date_trunc('hour', ts) as ts_utc,
         case when event_id % 2 = 0 then 'D' else 'DF' end as series_type,
         cast(sum(cast(value as decimal(12,2))) as double) as value
  from events group by all)"""

WX = """wx as (
  select l_returnflag as entity_id, l_shipdate as ts_utc,
         case when count(*) > 1 then avg(l_quantity) - 7.5 end as temperature_2m,
         nullif(min(l_quantity), 1) as dewpoint_2m,
         cast(sum(cast(round(l_discount * 100) as int)) as double) / count(*) * 10 as relative_humidity_2m,
         cast(sum(cast(round(l_tax * 100) as int)) as double) / count(*) as wind_speed_10m,
         100.0 * cast(count(*) filter (where l_linestatus = 'O') as double) / count(*) as cloud_cover,
         max(l_extendedprice) / 100 as shortwave_radiation
  from lineitem group by all)"""

FEATURE_NAMES = (
    "temperature_2m",
    "dewpoint_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "cloud_cover",
    "shortwave_radiation",
)

MELTED = "\n  union all ".join(
    f"select entity_id, ts_utc, '{f}' as feature, {f} as value from wx where {f} is not null"
    for f in FEATURE_NAMES
)
COV = f"cov as (\n  {MELTED})"

TZ = """tz as (
  select * from (values ('A', 'America/Los_Angeles'), ('N', 'America/Chicago'),
                        ('R', 'America/New_York')) as z(entity_id, tzname))"""

MED = """med as (
  select entity_id, median(value) as med from obs where series_type = 'D' group by entity_id)"""

DEMAND = """demand as (
  select obs.entity_id, obs.ts_utc, obs.value as demand_mw
  from obs join med using (entity_id)
  where series_type = 'D' and value > 0 and value between med * 0.2 and med * 3)"""

GOOD = """good as (
  select obs.* from obs join med using (entity_id)
  where value > 0 and value between med * 0.2 and med * 3)"""

PAIRS = """pairs as (
  select a.entity_id, a.ts_utc, a.value as actual, f.value as forecast
  from good a join good f using (entity_id, ts_utc)
  where a.series_type = 'D' and f.series_type = 'DF')"""

CLOSE_PAIRS = """close_pairs as (
  select * from pairs where abs(actual - forecast) / actual < 0.5)"""

# At least one covariate must be there for the (entity, hour) to exist.
FEATURES = """wide as (
  select entity_id, ts_utc, temperature_2m as temp_c, dewpoint_2m as dewpoint_c,
         relative_humidity_2m as humidity_pct, wind_speed_10m as wind_kmh,
         cloud_cover as cloud_pct, shortwave_radiation as radiation_wm2
  from wx
  where coalesce(temperature_2m, dewpoint_2m, relative_humidity_2m, wind_speed_10m,
                 cloud_cover, shortwave_radiation) is not null),
local as (
  select demand.*, wide.* exclude (entity_id, ts_utc),
         (ts_utc at time zone 'UTC') at time zone tzname as wall
  from demand join wide using (entity_id, ts_utc) join tz using (entity_id)),
features as (
  select * exclude (wall),
         case when temp_c < 18 then 18 - temp_c else 0.0::double end as hdd,
         case when temp_c > 18 then temp_c - 18 else 0.0::double end as cdd,
         temp_c * temp_c as temp_sq,
         extract(hour from wall) as hour_local, extract(dow from wall) as dayofweek,
         extract(month from wall) as month_local, extract(doy from wall) as dayofyear,
         extract(year from wall) as year,
         cast(extract(dow from wall) in (0, 6) as int) as is_weekend
  from local)"""

LAGGED = """lagged as (
  select *, lag(demand_mw, 48) over w as lag_48h, lag(demand_mw, 168) over w as lag_168h,
         lag(demand_mw, 336) over w as lag_336h,
         (lag(demand_mw, 168) over w + lag(demand_mw, 336) over w
          + lag(demand_mw, 504) over w + lag(demand_mw, 672) over w) / 4.0 as same_hour_4wk_avg,
         cast(sum(cast(demand_mw as decimal(18,6))) over r as double)
           / nullif(count(demand_mw) over r, 0) as rolling_24h_mean
  from features
  window w as (partition by entity_id order by ts_utc),
         r as (partition by entity_id order by ts_utc rows between 71 preceding and 48 preceding))"""

MODEL_INPUTS = (
    "hdd cdd temp_c temp_sq humidity_pct wind_kmh cloud_pct radiation_wm2 hour_local dayofweek "
    "month_local is_weekend lag_48h lag_168h lag_336h same_hour_4wk_avg rolling_24h_mean"
).split()


def _complete(columns: list[str]) -> str:
    return " and ".join(f"{c} is not null" for c in [*columns, "demand_mw"])


def folds(table: str, n: int = 8, days: int = 30, gap: int = 39, least: int = 365) -> str:
    return f"""ends as (
  select entity_id, min(ts_utc) as s, max(ts_utc) as e from {table} group by entity_id),
folds as (
  select entity_id, s, k as fold,
         e - to_days(cast(({n} - k) * {days} as int)) - to_hours({gap}) as train_end,
         e - to_days(cast(({n} - k) * {days} as int)) as test_start,
         e - to_days(cast(({n} - 1 - k) * {days} as int)) as test_end
  from ends, range({n}) r(k)
  where e - to_days(cast(({n} - k) * {days} as int)) - to_hours({gap}) - s >= to_days({least}))"""


def splits(columns: list[str]) -> str:
    whole = _complete(columns)
    return f"""train as (
  select f.fold, l.* from lagged l join folds f
    on l.entity_id = f.entity_id and l.ts_utc <= f.train_end where {whole}),
test as (
  select f.fold, l.* from lagged l join folds f
    on l.entity_id = f.entity_id and l.ts_utc > f.test_start and l.ts_utc <= f.test_end
  where {whole}),
sizes as (
  select * from (select entity_id, fold, count(*) as n_train from train group by all)
  join (select entity_id, fold, count(*) as n_test from test group by all) using (entity_id, fold))"""


MEAN_MODEL = """mean_fit as (
  select entity_id, fold, cast(sum(cast(demand_mw as decimal(18,6))) as double) / count(*) as mean
  from train group by all),
mean_pred as (
  select test.*, mean as prediction from test join mean_fit using (entity_id, fold))"""


def ridge_1f(x: str) -> str:
    return f"""ridge_fit as (
  select entity_id, fold,
         covar_pop(demand_mw, {x}) * count(*) / (var_pop({x}) * count(*) + 1.0) as b,
         avg({x}) as mx, avg(demand_mw) as my
  from train group by all),
ridge_pred as (
  select test.*, my + b * ({x} - mx) as prediction from test join ridge_fit using (entity_id, fold))"""


def ridge_2f(x1: str, x2: str) -> str:
    return f"""moments as (
  select entity_id, fold, avg({x1}) as m1, avg({x2}) as m2, avg(demand_mw) as my,
         var_pop({x1}) * count(*) + 1.0 as a11, var_pop({x2}) * count(*) + 1.0 as a22,
         covar_pop({x1}, {x2}) * count(*) as a12,
         covar_pop({x1}, demand_mw) * count(*) as c1, covar_pop({x2}, demand_mw) * count(*) as c2
  from train group by all),
ridge_pred as (
  select test.*, my + (a22 * c1 - a12 * c2) / (a11 * a22 - a12 * a12) * ({x1} - m1)
                    + (a11 * c2 - a12 * c1) / (a11 * a22 - a12 * a12) * ({x2} - m2) as prediction
  from test join moments using (entity_id, fold))"""


def ridge_n(inputs: list[str], target: str = "demand_mw") -> str:
    """Ridge on any number of inputs: Gauss-Jordan elimination, one common table per pivot."""
    p, names = len(inputs), [f"cast({c} as double)" for c in [*inputs, target]]
    cells = ", ".join(
        f"{{'i': {i}, 'j': {j}, 'v': covar_pop({names[i]}, {names[j]}) * count(*) + {float(i == j)}}}"
        for i in range(p)
        for j in range(p + 1)
    )
    steps = [
        f"""g{k + 1} as materialized (
  select a.entity_id, a.fold, a.i, a.j,
         case when a.i = {k} then a.v / d.v else a.v - r.v * c.v / d.v end as v
  from g{k} a
  join g{k} d on d.entity_id = a.entity_id and d.fold = a.fold and d.i = {k} and d.j = {k}
  join g{k} r on r.entity_id = a.entity_id and r.fold = a.fold and r.i = a.i and r.j = {k}
  join g{k} c on c.entity_id = a.entity_id and c.fold = a.fold and c.i = {k} and c.j = a.j)"""
        for k in range(p)
    ]
    means = ", ".join(f"avg({c})" for c in names[:p])
    first = f"""cells as (
  select entity_id, fold, unnest([{cells}]) as cell from train group by entity_id, fold),
g0 as materialized (select entity_id, fold, cell.i as i, cell.j as j, cell.v as v from cells)"""
    last = f"""slopes as (
  select entity_id, fold, list(v order by i) as b from g{p} where j = {p} group by all),
ridge_fit as (
  select *, my - list_dot_product(b, m) as b0
  from (select entity_id, fold, [{means}] as m, avg({target}) as my from train group by all)
  join slopes using (entity_id, fold)),
ridge_pred as (
  select test.*, b0 + list_dot_product(b, [{", ".join(names[:p])}]) as prediction
  from test join ridge_fit using (entity_id, fold))"""
    return ",\n".join([first, *steps, last])


def scores(model: str, predictions: str) -> str:
    return f"""{model}_scores as (
  select '{model}' as model, entity_id, fold, train_end, test_start, test_end, n_train, n_test, mae, mape
  from (select entity_id, fold, avg(abs(demand_mw - prediction)) as mae,
               avg(abs(demand_mw - prediction) / demand_mw) * 100 as mape
        from {predictions} group by all)
  join sizes using (entity_id, fold) join folds using (entity_id, fold))"""


def rounded(model: str) -> str:
    return f"""select model, entity_id, fold, train_end, test_start, test_end, n_train, n_test,
       round(mae, 2) as mae, round(mape, 4) as mape from {model}_scores"""


def sql(*parts: str) -> str:
    """The last part is the query, the others are its common tables."""
    *tables, final = parts
    return f"with {',\n'.join(tables)}\n{final}" if tables else final


D_FEATURES = (OBS_D, WX, TZ, MED, DEMAND, FEATURES)
D_LAGGED = (*D_FEATURES, LAGGED)
D_PAIRS = (OBS_D, MED, GOOD, PAIRS)
MEAN_BACKTEST = (*D_LAGGED, folds("lagged"), splits(MODEL_INPUTS), MEAN_MODEL)
def _skill_of(model: str, predictions: str) -> str:
    return f"""select '{model}' as model, entity_id, fold, count(*) as n_test, count(forecast) as n_both,
         avg(abs(demand_mw - prediction) / demand_mw) filter (where forecast is not null) * 100 as mape_model,
         avg(abs(demand_mw - forecast) / demand_mw) * 100 as mape_base
  from {predictions} left join close_pairs using (entity_id, ts_utc) group by all"""


SKILL = (
    *MEAN_BACKTEST,
    ridge_n(MODEL_INPUTS),
    GOOD,
    PAIRS,
    CLOSE_PAIRS,
    f"scored as (\n  {_skill_of('mean', 'mean_pred')}\n  union all\n  {_skill_of('ridge', 'ridge_pred')})",
)

# The cut of least squared error over all inputs of a fold, entities pooled, demand as a share of the entity's
# training mean, which is itself an input.
STUMP_MODEL = """levelled as (
  select train.fold, demand_mw / mean as y, cast(is_weekend as double) as w, cast(month_local as double) as m, mean as l
  from train join mean_fit using (entity_id, fold)),
inputs as (
  select fold, 'w' as input, w as v, y from levelled union all
  select fold, 'm', m, y from levelled union all select fold, 'l', l, y from levelled),
steps as (select fold, input, v, count(*) as n, sum(y) as s from inputs group by all),
cuts as (
  select *, sum(n) over up as n_left, sum(s) over up as s_left, lead(v) over (partition by fold, input order by v) as next_v,
         sum(n) over (partition by fold, input) as n_all, sum(s) over (partition by fold, input) as s_all
  from steps window up as (partition by fold, input order by v)),
best as (
  select fold, input, (v + next_v) / 2 as cut, s_left / n_left as below, (s_all - s_left) / (n_all - n_left) as above
  from cuts where next_v is not null
  qualify row_number() over (partition by fold order by s_left * s_left / n_left
                             + (s_all - s_left) * (s_all - s_left) / (n_all - n_left) desc) = 1),
stump_pred as (
  select test.*, case when (case input when 'w' then is_weekend when 'm' then month_local else mean end) <= cut
                      then below else above end * mean as prediction
  from test join mean_fit using (entity_id, fold) join best using (fold))"""



def boost_step(i: int, rate: float) -> str:
    """Table step_{i}: the rows of step_{i - 1} with their prediction p moved towards y by the best cut of what is left."""
    return f"""inputs_{i} as (
  select fold, 'w' as input, w as v, y - p as r from step_{i - 1} where kind = 'train' union all
  select fold, 'm', m, y - p from step_{i - 1} where kind = 'train' union all
  select fold, 'l', l, y - p from step_{i - 1} where kind = 'train'),
sums_{i} as (select fold, input, v, count(*) as n, sum(r) as s from inputs_{i} group by all),
cuts_{i} as (
  select *, sum(n) over up as n_left, sum(s) over up as s_left, lead(v) over (partition by fold, input order by v) as next_v,
         sum(n) over (partition by fold, input) as n_all, sum(s) over (partition by fold, input) as s_all
  from sums_{i} window up as (partition by fold, input order by v)),
best_{i} as (
  select fold, input, (v + next_v) / 2 as cut, s_left / n_left as below, (s_all - s_left) / (n_all - n_left) as above
  from cuts_{i} where next_v is not null
  qualify row_number() over (partition by fold order by s_left * s_left / n_left
                             + (s_all - s_left) * (s_all - s_left) / (n_all - n_left) desc) = 1),
step_{i} as (
  select step_{i - 1}.* replace (p + {rate} * case when (case input when 'w' then w when 'm' then m else l end) <= cut
                                                   then below else above end as p)
  from step_{i - 1} join best_{i} using (fold))"""


TWO_STEPS = f"""step_0 as (
  select *, avg(y) filter (where kind = 'train') over (partition by fold) as p from (
    select 'train' as kind, entity_id, ts_utc, fold, demand_mw, mean, demand_mw / mean as y, cast(is_weekend as double) as w,
           cast(month_local as double) as m, mean as l from train join mean_fit using (entity_id, fold)
    union all
    select 'test', entity_id, ts_utc, fold, demand_mw, mean, demand_mw / mean, cast(is_weekend as double),
           cast(month_local as double), mean from test join mean_fit using (entity_id, fold))),
{boost_step(1, 0.5)},
{boost_step(2, 0.5)},
two_steps_pred as (select entity_id, ts_utc, fold, demand_mw, p * mean as prediction from step_2 where kind = 'test')"""

ASSIGNED = """select entity_id, ts_utc,
       (select max(fold) from folds f where f.entity_id = x.entity_id
         and x.ts_utc > f.test_start and x.ts_utc <= f.test_end) as test_fold,
       (select min(fold) from folds f where f.entity_id = x.entity_id
         and x.ts_utc <= f.train_end) as first_train_fold
from {} x"""

HOURLY_FOLDS = dict(n=8, days=2, gap=39, least=7)

PRESENT = """present as (
  select entity_id, ts_utc, count(*) filter (where series_type = 'D') as d,
         count(*) filter (where series_type = 'DF') as f
  from obs group by all)"""


def _missing(have: str, lack: str) -> str:
    return f"""select entity_id, ts_utc from obs where series_type = '{have}'
except select entity_id, ts_utc from obs where series_type = '{lack}'"""


def _score(pairs: str, median: bool = True) -> str:
    extra = (
        ", round(median(abs(actual - forecast) / actual) * 100, 2) as median_ape_pct" if median else ""
    )
    return f"""select entity_id, count(*) as n_hours, round(avg(abs(actual - forecast)), 1) as mae_mw,
       round(avg(abs(actual - forecast) / actual) * 100, 2) as mape_pct{extra}
from {pairs} group by entity_id"""


STRICT = """select d.entity_id, d.ts_utc, d.demand_mw, l48.demand_mw as lag_48h, l168.demand_mw as lag_168h,
       l336.demand_mw as lag_336h,
       (l168.demand_mw + l336.demand_mw + l504.demand_mw + l672.demand_mw) / 4.0 as same_hour_4wk_avg,
       (select cast(sum(cast(p.demand_mw as decimal(18,6))) as double) / nullif(count(*), 0)
        from demand p where p.entity_id = d.entity_id
          and p.ts_utc between d.ts_utc - to_hours(71) and d.ts_utc - to_hours(48)) as rolling_24h_mean
from demand d
""" + "\n".join(
    f"left join demand l{n} on l{n}.entity_id = d.entity_id and l{n}.ts_utc = d.ts_utc - to_hours({n})"
    for n in (48, 168, 336, 504, 672)
)

IMPLAUSIBLE = """select entity_id, count(*) filter (where value <= 0) as non_positive,
       count(*) filter (where value > 0 and value < med * 0.2) as too_low,
       count(*) filter (where value > med * 3) as too_high, count(*) as total
from obs join med using (entity_id) where series_type = 'D' group by entity_id"""

SPAN = """min(ts_utc) as first_ts, max(ts_utc) as last_ts,
       (epoch_us(max(ts_utc)) - epoch_us(min(ts_utc))) // 86400000000 as span_days"""

FOLD_SUMMARY = """select model, entity_id, fold, strftime(train_end, '%Y-%m-%d') as train_end,
       strftime(test_end, '%Y-%m-%d') as test_end, n_train, n_test,
       round(mae, 1) as mae, round(mape, 2) as mape from mean_scores"""

LADDER = """select entity_id, model, count(*) as n_folds, round(avg(mape), 4) as mean_mape
from (select * from mean_scores union all select * from ridge_scores) group by all"""

DUPLICATES = """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
where (l_orderkey, l_linenumber) in
      (select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)"""


def _null_profile() -> str:
    columns = [*MODEL_INPUTS, "dewpoint_c", "demand_mw"]
    return "\nunion all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as n_null, count(*) as n_rows from lagged"
        for c in columns
    )


def _bands() -> str:
    return "\nunion all ".join(
        f"""select cast({lo} as double) as lo, cast({hi} as double) as hi, count(*) as removed
from obs join med using (entity_id)
where series_type = 'D' and (value <= 0 or value not between med * {lo} and med * {hi})"""
        for lo, hi in ((0.1, 5), (0.2, 3), (0.3, 2.5), (0.5, 2))
    )


def _corr(column: str) -> str:
    return f"round(corr(demand_mw, {column}), 3) as c_{column.removeprefix('lag_')}"


# Queries that give by another way what the SQL of another query says.
SAME_ROWS = {
    "ingest_rowwise_json_split": "ingest_rowwise_json",
    "append_observations": "store_observations",
    "features_bucketed": "features",
    "coverage_counts_bitmap": "coverage_counts",
    "missing_forecast_hours_bitmap": "missing_forecast_hours",
    "missing_actual_hours_bitmap": "missing_actual_hours",
    "backtest_mean_extended": "backtest_mean",
    "backtest_ridge_extended": "backtest_ridge_2f",
}


def all_oracles() -> dict[str, str]:
    found = _oracles()
    return {**found, **{name: found[other] for name, other in SAME_ROWS.items()}}


def _oracles() -> dict[str, str]:
    small = ["hdd", "cdd", "hour_local", "lag_48h", "lag_168h"]
    one, two = ["lag_48h"], ["cloud_pct", "temp_c"]
    every = folds("lagged")
    return {
        "ingest_rowwise_json": sql(OBS_H, "select * from obs"),
        "ingest_columnar_json": sql(WX, COV, "select * from cov"),
        "store_observations": sql(OBS_D, "select * from obs"),
        "store_features": sql(
            *D_FEATURES,
            "select entity_id, count(*) as n_rows, max(demand_mw) as max_demand_mw from features group by all",
        ),
        "scan_entity": sql(OBS_D, "select * from obs where entity_id = 'R'"),
        "source_time_range": sql(
            OBS_D,
            "select * from obs where ts_utc between timestamp '1997-03-01' and timestamp '1998-02-28'",
        ),
        "source_covariates": sql(
            WX,
            COV,
            "select * from cov where ts_utc between timestamp '1999-12-01' and timestamp '2000-02-29'",
        ),
        "union_series": sql(
            OBS_D,
            OBS_H.replace("obs as", "obs_h as", 1),
            "select * from obs union all select * from obs_h",
        ),
        "key_violations": """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
group by all having count(*) > 1""",
        "duplicate_rows": DUPLICATES,
        "first_duplicates": f"{DUPLICATES}\norder by all limit 20",
        "rowcount_by_series": sql(
            OBS_H, "select entity_id, series_type, count(*) as n_rows from obs group by all"
        ),
        "coverage_counts": sql(
            OBS_H,
            PRESENT,
            """select entity_id, cast(sum(d) as bigint) as demand_rows, cast(sum(f) as bigint) as forecast_rows,
       count(*) filter (where d > 0) as demand_hours, count(*) filter (where f > 0) as forecast_hours,
       count(*) filter (where d > 0 and f = 0) as missing_forecast,
       count(*) filter (where d = 0 and f > 0) as missing_actual,
       min(ts_utc) filter (where d > 0 and f = 0) as first_missing_forecast,
       max(ts_utc) filter (where d > 0 and f = 0) as last_missing_forecast,
       min(ts_utc) filter (where d = 0 and f > 0) as first_missing_actual,
       max(ts_utc) filter (where d = 0 and f > 0) as last_missing_actual
from present group by entity_id""",
        ),
        "missing_forecast_hours": sql(OBS_H, _missing("D", "DF")),
        "missing_actual_hours": sql(OBS_H, _missing("DF", "D")),
        "first_missing_hours": sql(
            OBS_H,
            f"""select * from ({_missing('D', 'DF')})
qualify row_number() over (partition by entity_id order by ts_utc) <= 20""",
        ),
        "value_distribution_sketch": sql(
            OBS_D,
            """select entity_id, count(*) as n, true as p001, true as median_val, true as p999, min(value) as min_val,
       max(value) as max_val from obs where series_type = 'D' group by entity_id""",
        ),
        "baseline_error_quantiles_sketch": sql(
            *D_PAIRS, "select entity_id, count(*) as n, true as p50, true as p90, true as p99 from pairs group by entity_id"
        ),
        "value_distribution": sql(
            OBS_D,
            """select entity_id, min(value) as min_val, round(quantile_cont(value, 0.001), 4) as p001,
       round(median(value), 4) as median_val, round(quantile_cont(value, 0.999), 4) as p999,
       max(value) as max_val
from obs where series_type = 'D' group by entity_id""",
        ),
        "implausible_counts": sql(OBS_D, MED, IMPLAUSIBLE),
        "implausible_counts_hourly": sql(OBS_H, MED, IMPLAUSIBLE),
        "absolute_outliers": sql(
            OBS_D,
            """select entity_id, ts_utc, value from obs
where series_type = 'D' and (value <= 0 or value > 500000)""",
        ),
        "band_sensitivity": sql(OBS_D, MED, _bands()),
        "marginal_band_rows": sql(
            OBS_D,
            MED,
            """select entity_id, ts_utc, value, round(med) as median_mw, round(value / med, 3) as ratio
from obs join med using (entity_id)
where series_type = 'D' and value between med * 0.1 and med * 5
  and value not between med * 0.2 and med * 3""",
        ),
        "plausible_rows": sql(OBS_D, MED, GOOD, "select * from good"),
        "covariate_profile": sql(
            WX,
            COV,
            """select feature, count(*) as n, round(min(value), 1) as min_v, round(avg(value), 1) as avg_v,
       round(max(value), 1) as max_v from cov group by feature""",
        ),
        "covariate_counts": sql(WX, COV, "select feature, count(*) as n_rows from cov group by feature"),
        "lag_null_counts": sql(
            *D_LAGGED,
            """select entity_id, count(*) as total, count(*) - count(lag_48h) as null_48,
       count(*) - count(lag_168h) as null_168, count(*) - count(lag_336h) as null_336
from lagged group by entity_id""",
        ),
        "null_profile": sql(*D_LAGGED, _null_profile()),
        "surviving_rows": sql(
            *D_LAGGED,
            f"""select count(*) as n_rows, count(*) filter (where {_complete(MODEL_INPUTS)}) as n_complete
from lagged""",
        ),
        "time_range": sql(OBS_H, f"select {SPAN} from obs"),
        "time_range_by_entity": sql(OBS_D, f"select entity_id, {SPAN} from obs group by entity_id"),
        "daily_profile": sql(
            OBS_H,
            """total as (
  select ts_utc, cast(sum(cast(value as decimal(18,2))) as double) as value,
         strftime(ts_utc, '%Y-%m-%d') as day, extract(hour from ts_utc) as h
  from obs where series_type = 'D' group by ts_utc),
ranked as (
  select *, count(*) over (partition by day) as n,
         row_number() over (partition by day order by value desc, h) as top,
         row_number() over (partition by day order by value, h) as bottom
  from total)""",
            """select 'all' as entity_id, day, max(h) filter (where top = 1) as peak_hour,
       max(value) as peak_value, max(h) filter (where bottom = 1) as min_hour
from ranked where n >= 24 group by day""",
        ),
        "melt_covariates": sql(WX, MELTED),
        "pivot_covariates": sql(
            WX,
            """wide as (
  select entity_id, ts_utc, temperature_2m as temp_c, dewpoint_2m as dewpoint_c,
         relative_humidity_2m as humidity_pct, wind_speed_10m as wind_kmh,
         cloud_cover as cloud_pct, shortwave_radiation as radiation_wm2 from wx)""",
            "select * from wide",
        ),
        "degree_days": sql(
            WX,
            """select entity_id, ts_utc, temperature_2m as temp_c,
       greatest(0, 18 - temperature_2m) as hdd, greatest(0, temperature_2m - 18) as cdd,
       temperature_2m * temperature_2m as temp_sq from wx""",
        ),
        "local_calendar": sql(
            WX,
            TZ,
            """walls as (
  select entity_id, ts_utc, (ts_utc at time zone 'UTC') at time zone tzname as wall
  from wx join tz using (entity_id))""",
            """select entity_id, ts_utc, extract(hour from wall) as hour_local, extract(dow from wall) as dayofweek,
       extract(month from wall) as month_local, extract(doy from wall) as dayofyear,
       extract(year from wall) as year, cast(extract(dow from wall) in (0, 6) as int) as is_weekend
from walls""",
        ),
        "features": sql(*D_FEATURES, "select * from features"),
        "feature_sanity": sql(
            *D_FEATURES,
            """select entity_id, round(avg(hdd), 1) as avg_hdd, round(avg(cdd), 1) as avg_cdd,
       min(hour_local) as min_hr, max(hour_local) as max_hr from features group by entity_id""",
        ),
        "timezone_check": sql(
            *D_FEATURES,
            """select entity_id, ts_utc, (ts_utc at time zone 'UTC') at time zone tzname as ts_local, hour_local
from features join tz using (entity_id)""",
        ),
        "demand_temperature": sql(
            OBS_D,
            WX,
            MED,
            DEMAND,
            """select entity_id, ts_utc, demand_mw, temperature_2m as temp_c
from demand join wx using (entity_id, ts_utc) where temperature_2m is not null""",
        ),
        "response_curve": sql(
            OBS_D,
            WX,
            MED,
            DEMAND,
            """select entity_id, floor(temperature_2m) as temp_bin, count(*) as n,
       cast(sum(cast(demand_mw as decimal(18,6))) as double) / count(*) as mean_demand_mw
from demand join wx using (entity_id, ts_utc) where temperature_2m is not null group by all""",
        ),
        "lag_features": sql(
            *D_LAGGED,
            """select entity_id, ts_utc, demand_mw, lag_48h, lag_168h, lag_336h, same_hour_4wk_avg
from lagged""",
        ),
        "rolling_mean": sql(
            *D_LAGGED, "select entity_id, ts_utc, demand_mw, rolling_24h_mean from lagged"
        ),
        "lag_features_strict": sql(OBS_D, MED, DEMAND, STRICT),
        "lag_features_strict_hourly": sql(OBS_H, MED, DEMAND, STRICT),
        "features_lagged": sql(*D_LAGGED, "select * from lagged"),
        "lag_correlations": sql(
            *D_LAGGED,
            "select entity_id, "
            + ", ".join(_corr(c) for c in ("lag_48h", "lag_168h", "lag_336h", "hdd", "cdd"))
            + " from lagged group by entity_id",
        ),
        "model_matrix": sql(
            *D_LAGGED,
            f"""select entity_id, ts_utc, {', '.join(MODEL_INPUTS)}, demand_mw from lagged
where {_complete(MODEL_INPUTS)}""",
        ),
        "paired_forecasts": sql(*D_PAIRS, CLOSE_PAIRS, "select * from close_pairs"),
        "baseline_score": sql(*D_PAIRS, CLOSE_PAIRS, _score("close_pairs")),
        "baseline_score_hourly": sql(OBS_H, MED, GOOD, PAIRS, CLOSE_PAIRS, _score("close_pairs")),
        "baseline_error_quantiles": sql(
            *D_PAIRS,
            "select entity_id, "
            + ", ".join(
                f"round(quantile_cont(abs(actual - forecast) / actual, {p}) * 100, 2) as {name}"
                for name, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))
            )
            + " from pairs group by entity_id",
        ),
        "baseline_score_raw": sql(
            OBS_H,
            PAIRS.replace("good", "obs"),
            _score("(select * from pairs where actual > 0)", median=False),
        ),
        "fold_bounds": sql(
            OBS_D, folds("obs"), "select entity_id, fold, train_end, test_start, test_end from folds"
        ),
        "fold_assignment": sql(
            *D_FEATURES,
            folds("features"),
            ASSIGNED.format("features"),
        ),
        "fold_assignment_hourly": sql(
            OBS_H, MED, DEMAND, folds("demand", **HOURLY_FOLDS), ASSIGNED.format("demand")
        ),
        "backtest_mean_hourly": sql(
            OBS_H,
            MED,
            DEMAND,
            folds("demand", **HOURLY_FOLDS),
            splits([]).replace("lagged l", "demand l"),
            MEAN_MODEL,
            scores("mean", "mean_pred"),
            rounded("mean"),
        ),
        "backtest_stump": sql(
            *D_LAGGED,
            every,
            splits(["is_weekend", "month_local"]),
            MEAN_MODEL,
            STUMP_MODEL,
            scores("stump", "stump_pred"),
            rounded("stump"),
        ),
        "backtest_two_steps": sql(
            *D_LAGGED,
            every,
            splits(["is_weekend", "month_local"]),
            MEAN_MODEL,
            TWO_STEPS,
            scores("two_steps", "two_steps_pred"),
            rounded("two_steps"),
        ),
        "fold_sizes": sql(
            *D_LAGGED,
            every,
            splits(MODEL_INPUTS),
            """select entity_id, fold, train_end, test_start, test_end, n_train, n_test
from folds join sizes using (entity_id, fold)""",
        ),
        "backtest_mean": sql(*MEAN_BACKTEST, scores("mean", "mean_pred"), rounded("mean")),
        "backtest_smoke": sql(
            *D_LAGGED, every, splits(small), MEAN_MODEL, scores("mean", "mean_pred"), FOLD_SUMMARY
        ),
        "backtest_ridge_1f": sql(
            *D_LAGGED, every, splits(one), ridge_1f(*one), scores("ridge", "ridge_pred"), rounded("ridge")
        ),
        "backtest_ridge_2f": sql(
            *D_LAGGED, every, splits(two), ridge_2f(*two), scores("ridge", "ridge_pred"), rounded("ridge")
        ),
        "backtest_ridge": sql(
            *D_LAGGED,
            every,
            splits(MODEL_INPUTS),
            ridge_n(MODEL_INPUTS),
            scores("ridge", "ridge_pred"),
            rounded("ridge"),
        ),
        "ladder_full": sql(
            *MEAN_BACKTEST,
            ridge_n(MODEL_INPUTS),
            scores("mean", "mean_pred"),
            scores("ridge", "ridge_pred"),
            LADDER,
        ),
        "quantile_forecast_ridge": sql(
            *D_LAGGED,
            every,
            splits(MODEL_INPUTS),
            ridge_n(MODEL_INPUTS),
            f"""residuals as (
  select train.entity_id, train.fold,
         demand_mw - b0 - list_dot_product(b, [{", ".join(f"cast({c} as double)" for c in MODEL_INPUTS)}])
           as residual
  from train join ridge_fit using (entity_id, fold)),
shifts as (
  select entity_id, fold, quantile_cont(residual, 0.05) as lo, quantile_cont(residual, 0.95) as hi
  from residuals group by all)""",
            """select entity_id, fold, count(*) as n_test,
       count(*) filter (where demand_mw between prediction + lo and prediction + hi) / count(*)
         as share_inside
from ridge_pred join shifts using (entity_id, fold) group by all""",
        ),
        "fold_summary": sql(*MEAN_BACKTEST, scores("mean", "mean_pred"), FOLD_SUMMARY),
        "model_ladder": sql(
            *D_LAGGED,
            every,
            splits(one),
            MEAN_MODEL,
            ridge_1f(*one),
            scores("mean", "mean_pred"),
            scores("ridge", "ridge_pred"),
            LADDER,
        ),
        "skill_vs_baseline": sql(
            *SKILL,
            """select model, entity_id, fold, n_test, n_both, round(mape_model, 4) as mape_model,
       round(mape_base, 4) as mape_base, round(n_both / n_test, 4) as coverage,
       round(1 - mape_model / mape_base, 4) as skill from scored""",
        ),
        "ladder_vs_baseline": sql(
            *SKILL,
            """select model, entity_id, count(*) as n_folds, round(sum(n_both) / sum(n_test), 4) as coverage,
       round(avg(mape_model), 4) as mape_model, round(avg(mape_base), 4) as mape_base
from scored group by all""",
        ),
        "quantile_forecast": sql(
            *D_LAGGED,
            every,
            splits(one),
            MEAN_MODEL,
            """shifts as (
  select entity_id, fold, quantile_cont(demand_mw - mean, 0.05) as r05,
         quantile_cont(demand_mw - mean, 0.5) as r50, quantile_cont(demand_mw - mean, 0.95) as r95
  from train join mean_fit using (entity_id, fold) group by all)""",
            """select entity_id, ts_utc, fold, prediction, round(prediction + r05, 5) as q05,
       round(prediction + r50, 5) as q50, round(prediction + r95, 5) as q95
from mean_pred join shifts using (entity_id, fold)""",
        ),
    }
