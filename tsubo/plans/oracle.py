"""The same queries as plain SQL for an independent engine (DuckDB)."""

from __future__ import annotations

from itertools import combinations
from statistics import NormalDist

from tsubo.plans import fixtures
from tsubo.plans.registry import BOXES

RAW_COLUMNS = ", ".join(fixtures.RAW_COLUMNS)
AGAIN_COLUMNS = ", ".join(f"concat(url, '{fixtures.AGAIN}') AS url" if c == "url" else c for c in fixtures.RAW_COLUMNS)

RAW = f"""
base AS (SELECT {", ".join(fixtures.BASE_COLUMNS)} FROM lineitem),
once AS (SELECT {", ".join(f"{sql} AS {name}" for name, sql in fixtures.LISTING_COLUMNS.items())} FROM base),
raw AS (SELECT {RAW_COLUMNS} FROM once UNION ALL SELECT {AGAIN_COLUMNS} FROM once WHERE distance_to_nearest_station = 3)"""


def _double(text: str) -> str:
    prefix = rf"regexp_extract({text}, '^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)', 1)"
    return f"CASE WHEN {text} IS NOT NULL THEN coalesce(TRY_CAST(nullif({prefix}, '') AS DOUBLE), 0.0::DOUBLE) END"


def _integer(text: str) -> str:
    prefix = rf"regexp_extract({text}, '^\s*([+-]?\d+)', 1)"
    return f"CASE WHEN {text} IS NOT NULL THEN coalesce(TRY_CAST(nullif({prefix}, '') AS BIGINT), 0) END"


def _without(text: str, *labels: str) -> str:
    for label in labels:
        text = f"replace({text}, '{label}', '')"
    return text


MAN_YEN = {c: f"({_double(_without(c, '万円'))}) * 10000" for c in ("rent", "deposit", "key_money")}
YEN = _double(_without("management_fee", "円"))
AREA = _double(_without("area", "m2"))
PLAN = "CASE floor_plan WHEN 'ワンルーム' THEN '1R' ELSE floor_plan END"
FLOOR = "rtrim(floor, '階')"
AGE = (
    f"CASE WHEN building_age LIKE '%新築%' THEN 0::BIGINT WHEN building_age LIKE '%以上' "
    f"THEN {_integer(_without('building_age', '築', '年以上'))} ELSE {_integer(_without('building_age', '築', '年'))} END"
)
SIZE = "CASE WHEN building_size LIKE '%平屋%' THEN '1' ELSE rtrim(building_size, '階建') END"


def _size_total(text: str) -> str:
    runs = rf"regexp_extract_all({text}, '\d+')"
    return f"coalesce(list_sum(list_transform({runs}, lambda z: CAST(z AS BIGINT))), 0)::BIGINT"


DISTINCT = f"""{RAW},
distinct_listings AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY title, floor, floor_plan, area, rent ORDER BY url NULLS FIRST) AS rn FROM raw
  ) WHERE rn = 1)"""

STANDARD = f"""{DISTINCT},
standard AS (
  SELECT url, title, address, {MAN_YEN["rent"]} AS rent, {YEN} AS management_fee, {MAN_YEN["deposit"]} AS deposit,
    {MAN_YEN["key_money"]} AS key_money, {FLOOR} AS floor, {PLAN} AS floor_plan, {AREA} AS area, {AGE} AS building_age,
    {SIZE} AS building_size, stations, nearest_station, distance_to_nearest_station,
    round(avg_distance_to_stations, 2) AS avg_distance_to_stations
  FROM distinct_listings)"""

VIEW = f"""{STANDARD},
featured AS (
  SELECT url, title, address, rent, nullif(management_fee, 0.0) AS management_fee, nullif(deposit, 0.0) AS deposit,
    nullif(key_money, 0.0) AS key_money, floor, floor_plan, area, building_age, building_size, nearest_station,
    distance_to_nearest_station, avg_distance_to_stations,
    round(avg(rent) OVER station, 2) AS avg_rent_by_station, round(avg(rent) OVER plan, 2) AS avg_rent_by_floor_plan,
    count(title) OVER station AS count_listings_per_station, count(title) OVER plan AS count_listings_per_floor_plan
  FROM standard WINDOW station AS (PARTITION BY nearest_station), plan AS (PARTITION BY floor_plan))"""


def _floors(source: str, columns: str) -> str:
    """Rows of ``source`` with one ``floor`` per row in place of its label."""
    low = "CASE WHEN p[1] LIKE 'B%' THEN -TRY_CAST(substr(p[1], 2) AS BIGINT) ELSE TRY_CAST(p[1] AS BIGINT) END"
    return f"""
  SELECT {columns}, unnest(generate_series(lo, hi)) AS floor FROM (
    SELECT *, CASE WHEN len(p) = 1 THEN lo ELSE TRY_CAST(p[2] AS BIGINT) END AS hi FROM (
      SELECT *, {low} AS lo FROM (SELECT *, string_split(upper(floor), '-') AS p FROM {source})
    ) WHERE NOT list_contains(p, '')
  ) WHERE lo <= hi"""


CLEAN = f"""{VIEW},
clean AS (SELECT * REPLACE ({_size_total("building_size")} AS building_size) FROM (
{_floors("featured", "* EXCLUDE (floor, p, lo, hi)")}))"""

# Test rows first in hash order, then five consecutive folds.
SPLIT = f"""{CLEAN},
ranked AS (
  SELECT url, rent, area, building_age, building_size, floor, floor_plan, count(*) OVER () AS n,
    row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws('#', url, floor)), 1, 15))::BIGINT) - 1 AS place FROM clean),
placed AS (SELECT *, ceil(0.2::DOUBLE * n)::BIGINT AS tests FROM ranked),
numbered AS (SELECT *, place - tests AS i, (n - tests) // 5 AS size, (n - tests) % 5 AS longer FROM placed),
split AS (
  SELECT url, rent, area, building_age, building_size, CASE floor WHEN 0 THEN 1 ELSE floor END AS floor, floor_plan,
    place < tests AS is_test,
    CASE WHEN place < tests THEN NULL WHEN i < longer * (size + 1) THEN i // (size + 1)
      ELSE longer + (i - longer * (size + 1)) // size END::INTEGER AS fold
  FROM numbered)"""

X = {"area": "x1", "building_age": "x2", "building_size": "x3", "floor": "x4"}


def _fit(train: str) -> str:
    """Slopes and category levels per model ``f`` from ``train`` (f, floor_plan, x1..x4, y).

    Least squares about the category means, solved by elimination.
    """
    sums = [f"sum((x{i} - m{i}) * (x{j} - m{j})) AS a{i}{j}" for i in range(1, 5) for j in range(i, 5)]
    sums += [f"sum((x{i} - m{i}) * (y - my)) AS b{i}" for i in range(1, 5)]
    steps = []
    for p in range(1, 4):
        kept = [f"a{i}{j}" for i in range(1, p + 1) for j in range(i, 5)] + [f"b{i}" for i in range(1, p + 1)]
        new = [f"a{i}{j} - a{p}{i} * a{p}{j} / a{p}{p} AS a{i}{j}" for i in range(p + 1, 5) for j in range(i, 5)]
        new += [f"b{i} - a{p}{i} * b{p} / a{p}{p} AS b{i}" for i in range(p + 1, 5)]
        steps.append(f"e{p} AS (SELECT f, {', '.join(kept + new)} FROM e{p - 1})")
    return f"""
train AS ({train}),
means AS (SELECT f, floor_plan, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(x4) AS m4, avg(y) AS my
  FROM train GROUP BY f, floor_plan),
e0 AS (SELECT f, {", ".join(sums)} FROM train JOIN means USING (f, floor_plan) GROUP BY f),
{", ".join(steps)},
s4 AS (SELECT *, b4 / a44 AS k4 FROM e3),
s3 AS (SELECT *, (b3 - a34 * k4) / a33 AS k3 FROM s4),
s2 AS (SELECT *, (b2 - a23 * k3 - a24 * k4) / a22 AS k2 FROM s3),
slopes AS (SELECT f, (b1 - a12 * k2 - a13 * k3 - a14 * k4) / a11 AS k1, k2, k3, k4 FROM s2),
levels AS (SELECT f, floor_plan, n, my - k1 * m1 - k2 * m2 - k3 * m3 - k4 * m4 AS level FROM means JOIN slopes USING (f)),
baselines AS (SELECT f, level AS base FROM levels WHERE floor_plan = (SELECT min(floor_plan) FROM train))"""


TRAIN_COLUMNS = "floor_plan, area AS x1, building_age AS x2, building_size AS x3, floor AS x4, rent AS y"
MODEL = f"{SPLIT}, {_fit(f'SELECT 0 AS f, {TRAIN_COLUMNS} FROM split WHERE NOT is_test')}"
PREDICTED = "k1 * area + k2 * building_age + k3 * building_size + k4 * floor + coalesce(level, base)"
FOLD_MODELS = f"""{SPLIT}, {_fit(
    f"SELECT f, {TRAIN_COLUMNS} FROM split JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS f) ON NOT is_test AND fold <> f"
)},
scored AS (
  SELECT fold, rent, {PREDICTED} AS predicted FROM split JOIN slopes ON fold = slopes.f JOIN baselines ON fold = baselines.f
  LEFT JOIN levels ON fold = levels.f AND split.floor_plan = levels.floor_plan WHERE NOT is_test),
multiple AS (SELECT fold, count(*) AS n, 1 - sum((rent - predicted) ** 2) / (var_pop(rent) * count(*)) AS r2 FROM scored GROUP BY fold)"""
SIMPLE_CV = """
lines AS (SELECT f, regr_slope(rent, area) AS b, regr_intercept(rent, area) AS a
  FROM split JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS f) ON NOT is_test AND fold <> f GROUP BY f),
simple AS (SELECT fold, count(*) AS n, 1 - sum((rent - a - b * area) ** 2) / (var_pop(rent) * count(*)) AS r2
  FROM split JOIN lines ON fold = f GROUP BY fold)"""

# Test rows scaled by their own mean and deviation.  Per dummy the training
# coefficient is (level - base) * deviation.
REFIT = f"""{MODEL},
train_scale AS (SELECT stddev_pop(x1) AS t1, stddev_pop(x2) AS t2, stddev_pop(x3) AS t3, stddev_pop(x4) AS t4, avg(y) AS my,
  count(*) AS rows FROM train),
test_scale AS (SELECT avg(area) AS u1, avg(building_age) AS u2, avg(building_size) AS u3, avg(floor) AS u4,
  stddev_pop(area) AS v1, stddev_pop(building_age) AS v2, stddev_pop(building_size) AS v3, stddev_pop(floor) AS v4,
  count(*) AS tests FROM split WHERE is_test),
shares AS (SELECT floor_plan, count(*)::DOUBLE / (SELECT tests FROM test_scale) AS seen FROM split WHERE is_test GROUP BY floor_plan),
dummies AS (
  SELECT floor_plan, seen, (level - base) * sqrt((l.n / rows) * (1 - l.n / rows)) / sqrt(seen * (1 - seen)) AS effect
  FROM levels l JOIN baselines USING (f) JOIN shares USING (floor_plan), train_scale
  WHERE floor_plan <> (SELECT min(floor_plan) FROM train)),
refitted AS (
  SELECT rent, my + k1 * t1 * (area - u1) / v1 + k2 * t2 * (building_age - u2) / v2 + k3 * t3 * (building_size - u3) / v3
    + k4 * t4 * (floor - u4) / v4 + coalesce(effect, 0) - (SELECT sum(effect * seen) FROM dummies) AS predicted
  FROM split LEFT JOIN dummies USING (floor_plan), slopes, train_scale, test_scale WHERE is_test)"""


def _binned(source: str, value: str) -> str:
    return f"""
v AS (SELECT {value}::DOUBLE AS x FROM {source} WHERE {value} IS NOT NULL),
s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v),
w AS (SELECT *, least(2 * (q3 - q1) * n ** (-1.0::DOUBLE / 3), (hi - lo) / (log2(n) + 1)) AS width FROM s),
b AS (SELECT *, ceil((hi - lo) / width)::BIGINT AS bins, (hi - lo) / ceil((hi - lo) / width) AS step FROM w),
g AS (SELECT x, lo, step, bins, least(floor((x - lo) / step)::BIGINT, bins - 1) AS i FROM v, b),
c AS (SELECT CASE WHEN x < lo + i * step THEN i - 1 WHEN x >= lo + (i + 1) * step AND i < bins - 1 THEN i + 1 ELSE i END AS bin,
  count(*) AS count FROM g GROUP BY 1)"""


def _histogram(source: str, value: str) -> str:
    return f"""{_binned(source, value)},
r AS (SELECT unnest(range(bins)) AS bin, lo, step, n FROM b)
SELECT bin, round(lo + bin * step, 4) AS bin_low, round(lo + (bin + 1) * step, 4) AS bin_high,
  coalesce(count, 0) AS count, round(coalesce(count, 0) / (n * step), 12) AS density
FROM r LEFT JOIN c USING (bin)"""


def _histogram_runs(source: str, value: str) -> str:
    return f"""{_binned(source, value)},
k AS (SELECT bin, count, lead(bin) OVER (ORDER BY bin) AS next FROM c),
r AS (SELECT bin, 1 AS bins, count FROM k UNION ALL SELECT bin + 1, next - bin - 1, 0 FROM k WHERE next > bin + 1)
SELECT bin, r.bins, round(lo + bin * step, 4) AS bin_low, round(lo + (bin + r.bins) * step, 4) AS bin_high,
  count, round(count / (n * step), 12) AS density FROM r, b"""


def _curve(source: str, value: str, cut: int) -> str:
    return f"""
v AS (SELECT {value}::DOUBLE AS x FROM {source} WHERE {value} IS NOT NULL),
s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) * count(*) ** (-0.2::DOUBLE) AS h FROM v),
g AS (SELECT i AS point, lo - {cut} * h + i * (hi - lo + 2 * {cut} * h) / 199 AS spot, h, n FROM s, range(200) t(i)),
d AS (SELECT x, count(*) AS c FROM v GROUP BY x)
SELECT point, round(spot, 4) AS x, round(sum(c * exp(-0.5 * ((spot - d.x) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
FROM g, d GROUP BY point, spot"""


def _box(group: str, value: str = "rent") -> str:
    return f"""
v AS (SELECT {group} AS g, {value} AS x FROM clean WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
q AS (SELECT g, quantile_cont(x, 0.25) AS q1, median(x) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY g),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


def _box_summary(group: str) -> str:
    return f"""WITH {CLEAN}, {_box(group)}
SELECT g AS {group}, count(*) AS count, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  least(min(x) FILTER (x BETWEEN lo AND hi), any_value(q1)) AS whisker_low,
  greatest(max(x) FILTER (x BETWEEN lo AND hi), any_value(q3)) AS whisker_high,
  count(*) FILTER (x NOT BETWEEN lo AND hi) AS outliers
FROM v JOIN f USING (g) GROUP BY g"""


def _box_outliers(group: str, value: str = "rent") -> str:
    return f"""WITH {CLEAN}, {_box(group, value)}
SELECT g AS {group}, x AS value, count(*) AS n FROM v JOIN f USING (g) WHERE x NOT BETWEEN lo AND hi GROUP BY g, x"""


# Name, whether numeric, and type of the clean table's columns.
CLEAN_TYPES = {
    "url": "string", "title": "string", "address": "string", "rent": "double", "management_fee": "double",
    "deposit": "double", "key_money": "double", "floor": "bigint", "floor_plan": "string", "area": "double",
    "building_age": "bigint", "building_size": "bigint", "nearest_station": "string",
    "distance_to_nearest_station": "bigint", "avg_distance_to_stations": "double", "avg_rent_by_station": "double",
    "avg_rent_by_floor_plan": "double", "count_listings_per_station": "bigint", "count_listings_per_floor_plan": "bigint",
}
NUMERIC = [c for c, t in CLEAN_TYPES.items() if t != "string"]
TEXT = [c for c, t in CLEAN_TYPES.items() if t == "string"]
Z = NormalDist().inv_cdf(0.975)


def _each(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in columns)


DESCRIBE_NUMERIC = f"WITH {CLEAN} " + _each(
    NUMERIC,
    "SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    "round(min({c})::DOUBLE, 4) AS min, round(max({c})::DOUBLE, 4) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, "
    "round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75 FROM clean",
)
DESCRIBE_TEXT = f"""WITH {CLEAN}, cells AS ({_each(TEXT, "SELECT '{c}' AS column_name, {c} AS value FROM clean WHERE {c} IS NOT NULL")}),
frequency AS (SELECT column_name, value, count(*) AS n FROM cells GROUP BY 1, 2),
ordered AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place FROM frequency)
SELECT column_name, sum(n)::BIGINT AS count, count(*) AS "unique", min(value) FILTER (place = 1) AS top, max(n) AS freq
FROM ordered GROUP BY column_name"""


def _interval(by: str = "") -> str:
    named = f"{by}, " if by else ""
    return f"""WITH {CLEAN}, i AS (SELECT {named}count(*) AS sample_size, avg(rent) AS m, {Z!r} * stddev_pop(rent) / sqrt(count(*)) AS e
FROM clean {f"GROUP BY {by}" if by else ""})
SELECT {named}sample_size, round(m, 4) AS mean, round(e, 4) AS margin, round(m - e, 4) AS lower, round(m + e, 4) AS upper FROM i"""


def _pearson(x: str) -> str:
    """p by Simpson's rule over the tail of Student's density, 40 units in 4000 steps."""
    return f"""WITH {CLEAN}, c AS (SELECT corr({x}, rent) AS r, regr_count(rent, {x}) AS n FROM clean),
d AS (SELECT r, n, n - 2 AS v, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c),
tail AS (SELECT v, abs(t) + i / 100 AS z, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM d, range(4001) s(i)),
p AS (SELECT 2 * sum(w * exp(lgamma((v + 1) / 2) - lgamma(v / 2) - 0.5 * ln(v * pi()) - (v + 1) / 2 * ln(1 + z * z / v))) / 300 AS p FROM tail)
SELECT '{x}' AS x, 'rent' AS y, n::BIGINT AS n, round(r, 8) AS r, round(t, 4) AS t, round(p, 8) AS p FROM d, p"""


CORRELATION = f"WITH {CLEAN} " + " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM clean" for x, y in combinations(NUMERIC, 2)
)

PLANS = ["1K", "1LDK", "1R", "2DK", "2LDK", "3LDK", "4LDK"]
DUMMIES = {f"floor_plan_{p}": f"(floor_plan = '{p}')::DOUBLE" for p in PLANS}
DUMMY_SQL = ", ".join(f'{sql} AS "{name}"' for name, sql in DUMMIES.items())


def _standardized(refit: bool) -> str:
    features = [*X, *DUMMIES]
    scale = ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "d_{c}"' for c in features)
    scores = ", ".join(f'round(("{c}" - "m_{c}") / CASE "d_{c}" WHEN 0 THEN 1 ELSE "d_{c}" END, 6) AS "{c}"' for c in features)
    subset = "is_test = subset" if refit else "NOT subset"
    return f"""WITH {SPLIT}, hot AS (SELECT url, floor AS at_floor, is_test, {", ".join(X)}, {DUMMY_SQL} FROM split),
scales AS (SELECT is_test AS subset, {scale} FROM hot GROUP BY is_test)
SELECT url, at_floor, is_test, {scores} FROM hot JOIN scales ON {subset}"""


COEFFICIENTS = f"""WITH {MODEL}, total AS (SELECT count(*) AS rows FROM train),
numeric_rows AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, any_value(k{x[1]}) * stddev_pop({x}) AS coefficient, stddev_samp({x}) AS feature_std, "
    f"any_value(k{x[1]}) * stddev_pop({x}) / stddev_samp({x}) AS per_unit FROM train, slopes"
    for c, x in X.items()
)}),
dummy_rows AS (SELECT concat('floor_plan_', l.floor_plan) AS feature, (level - base) * sqrt((l.n / rows) * (1 - l.n / rows)) AS coefficient,
  sqrt((l.n / rows) * (1 - l.n / rows) * rows / (rows - 1)) AS feature_std, NULL::DOUBLE AS per_unit
  FROM levels l JOIN baselines USING (f), total WHERE l.floor_plan <> (SELECT min(floor_plan) FROM train))
SELECT feature, round(coefficient, 4) AS coefficient, round(feature_std, 8) AS feature_std, round(per_unit, 4) AS per_unit
FROM (SELECT * FROM numeric_rows UNION ALL SELECT * FROM dummy_rows)"""

OWN = f"""own AS (SELECT is_test, rent, {PREDICTED} AS predicted FROM split
  LEFT JOIN levels USING (floor_plan), slopes, baselines)"""
R2 = "round(1 - sum((rent - predicted) ** 2) / (var_pop(rent) * count(*)), 8)"

# Stations as the pages state them: names and first digit runs of each block.
ROUNDTRIP = rf"""WITH {RAW},
blocks AS (SELECT *, string_split(stations, ',') AS blocks FROM raw),
lists AS (SELECT *, list_transform(blocks, lambda b: regexp_extract(b, '/(.*?)\s*歩', 1)) AS names,
  list_transform(blocks, lambda b: CAST(regexp_extract(b, '\d+') AS BIGINT)) AS minutes FROM blocks)
SELECT title, address, building_age, building_size, stations, names[list_position(minutes, list_min(minutes))] AS nearest_station,
  list_min(minutes) AS distance_to_nearest_station, list_avg(minutes) AS avg_distance_to_stations, url,
  {", ".join(f"coalesce({c}, '') AS {c}" for c in ("rent", "management_fee", "deposit", "key_money", "floor", "floor_plan", "area"))}
FROM lists"""

NEXT_PAGES = f"SELECT concat('{fixtures.PAGE_URL}', page_id) AS url, concat('{fixtures.PAGE_URL}', page_id + 2) AS next_url FROM pages"

MENU_LINKS = r"""regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="([^"]*)">', 1)"""
MENU_TEXTS = r"""regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="[^"]*">(.*?)</a>', 1)"""


def _unescaped(text: str) -> str:
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return text


ORACLE: dict[str, str] = {
    "dedup_listings": f"WITH {DISTINCT} SELECT * FROM distinct_listings",
    "standardize_money": f"WITH {RAW} SELECT url, {', '.join(f'{sql} AS {c}' for c, sql in MAN_YEN.items())}, {YEN} AS management_fee FROM raw",
    "standardize_area": f"WITH {RAW} SELECT url, {AREA} AS area FROM raw",
    "standardize_floor_plan": f"WITH {RAW} SELECT url, {PLAN} AS floor_plan, {FLOOR} AS floor FROM raw",
    "building_age": f"WITH {RAW} SELECT url, {AGE} AS building_age FROM raw",
    "building_size_label": f"WITH {RAW} SELECT url, {SIZE} AS building_size FROM raw",
    "building_size_total": f"WITH {RAW} SELECT url, {_size_total(f'({SIZE})')} AS building_size FROM raw",
    "nullify_zero_fees": (
        f"WITH {RAW} SELECT url, nullif({YEN}, 0.0) AS management_fee, nullif({MAN_YEN['deposit']}, 0.0) AS deposit, "
        f"nullif({MAN_YEN['key_money']}, 0.0) AS key_money FROM raw"
    ),
    "lenient_casts": (
        f"WITH {RAW} SELECT url, {_double('rent')} AS rent_prefix, {_integer('floor')} AS floor_prefix, "
        f"{_integer('area')} AS area_prefix, {_integer('floor_plan')} AS plan_prefix FROM raw"
    ),
    "station_features": f"WITH {VIEW} SELECT url, nearest_station, avg_rent_by_station, count_listings_per_station FROM featured",
    "plan_features": f"WITH {VIEW} SELECT url, floor_plan, avg_rent_by_floor_plan, count_listings_per_floor_plan FROM featured",
    "featured_view": f"WITH {VIEW} SELECT * FROM featured",
    "clean_listings": f"WITH {CLEAN} SELECT * FROM clean",
    "explode_floors": f"WITH {STANDARD} {_floors('standard', 'url')}",
    "floor_rejects": f"""WITH {STANDARD}, kept AS ({_floors('standard', 'url')})
SELECT CASE WHEN list_contains(string_split(floor, '-'), '') THEN 'missing' WHEN url IN (SELECT url FROM kept) THEN 'kept'
  WHEN regexp_matches(floor, '^B?[0-9]+-[0-9]+$') THEN 'descending' ELSE 'unreadable' END AS outcome, count(*) AS listings
FROM standard GROUP BY 1""",
    "floor_zero_to_one": f"WITH {CLEAN} SELECT url, floor, CASE WHEN floor = 0 THEN 1 ELSE floor END AS model_floor FROM clean",
    "column_profile": f"WITH {CLEAN} "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{t}' AS type FROM clean" for c, t in CLEAN_TYPES.items()),
    "describe_numeric": DESCRIBE_NUMERIC,
    "describe_text": DESCRIBE_TEXT,
    "rent_confidence_interval": _interval(),
    "rent_confidence_interval_by_plan": _interval("floor_plan"),
    "correlation_matrix": CORRELATION,
    "pearson_area_rent": _pearson("area"),
    "pearson_age_rent": _pearson("building_age"),
    "pearson_distance_rent": _pearson("distance_to_nearest_station"),
    "rent_histogram": f"WITH {CLEAN}, {_histogram('clean', 'rent')}",
    "rate_histogram_runs": f"WITH {CLEAN}, rates AS (SELECT rent * rent / area AS rate FROM clean), {_histogram_runs('rates', 'rate')}",
    "rent_kde": f"WITH {CLEAN}, {_curve('clean', 'rent', 3)}",
    **{name: _box_summary(group) for name, group in BOXES.items()},
    **{name.replace("box", "box_outliers"): _box_outliers(group) for name, group in BOXES.items()},
    **{name.replace("box", "box_outliers_of_rate"): _box_outliers(group, "(rent / area)") for name, group in BOXES.items()},
    "scatter_area_rent": f"WITH {CLEAN} SELECT area AS x, rent AS y FROM clean",
    "scatter_age_rent": f"WITH {CLEAN} SELECT building_age AS x, rent AS y FROM clean",
    "train_test_split_counts": f"WITH {SPLIT} SELECT is_test, fold, count(*) AS n FROM split GROUP BY is_test, fold",
    "train_test_split_rows": f"WITH {SPLIT} SELECT url, floor, rent, is_test, fold FROM split",
    "one_hot_floor_plan": f"WITH {SPLIT} SELECT url, {', '.join(X)}, {DUMMY_SQL} FROM split",
    "one_hot_entries": f"""WITH {SPLIT}, slots AS (
  SELECT url, row_number() OVER (ORDER BY url) - 1 AS slot FROM (SELECT DISTINCT url FROM split WHERE NOT is_test))
SELECT url, floor, is_test, slot, 1.0::DOUBLE AS value FROM split JOIN slots USING (url) WHERE slot > 0""",
    "assembled_features": f"""WITH {SPLIT} SELECT url, floor AS at_floor, {len(X) + len(PLANS)} AS n_features,
  {", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate([*X, *DUMMIES.values()]))} FROM split""",
    "standardize_features": _standardized(refit=False),
    "standardize_features_refit": _standardized(refit=True),
    "simple_regression": (
        f"WITH {SPLIT} SELECT count(*) AS n, round(regr_slope(rent, area), 6) AS slope, "
        "round(regr_intercept(rent, area), 4) AS intercept, round(regr_r2(rent, area), 8) AS r2 FROM split WHERE NOT is_test"
    ),
    "cv_simple_r2": f"WITH {SPLIT}, {SIMPLE_CV} SELECT fold, n, round(r2, 8) AS r2 FROM simple",
    "cv_multiple_r2": f"WITH {FOLD_MODELS} SELECT fold, n, round(r2, 8) AS r2 FROM multiple",
    "cv_mean_r2": (
        f"WITH {FOLD_MODELS}, {SIMPLE_CV} SELECT 'simple' AS model, round(avg(r2), 8) AS mean_r2 FROM simple "
        "UNION ALL SELECT 'multiple', round(avg(r2), 8) FROM multiple"
    ),
    "multiple_regression_scores": f"""WITH {REFIT}, {OWN}
SELECT 'train' AS subset, count(*) AS n, {R2} AS r2 FROM own WHERE NOT is_test
UNION ALL SELECT 'test', count(*), {R2} FROM own WHERE is_test UNION ALL SELECT 'test_refitted', count(*), {R2} FROM refitted""",
    "coef_table": COEFFICIENTS,
    "residuals": (
        f"WITH {MODEL}, {OWN} SELECT rent AS actual, round(predicted, 2) AS predicted, round(predicted - rent, 2) AS residual "
        "FROM own WHERE is_test"
    ),
    "residuals_refit": f"WITH {REFIT} SELECT rent AS actual, round(predicted, 2) AS predicted, round(predicted - rent, 2) AS residual FROM refitted",
    "residual_histogram": f"WITH {REFIT}, errors AS (SELECT predicted - rent AS residual FROM refitted), {_histogram('errors', 'residual')}",
    "residual_kde": f"WITH {REFIT}, errors AS (SELECT predicted - rent AS residual FROM refitted), {_curve('errors', 'residual', 0)}",
    "html_roundtrip_listings": ROUNDTRIP,
    "html_strict_stations": f"WITH {RAW} SELECT url, nearest_station, distance_to_nearest_station, avg_distance_to_stations FROM raw",
    "html_images": f"WITH {RAW} SELECT url, {fixtures.IMAGE} AS img FROM raw",
    "html_block_rejects": (
        f"WITH {RAW} SELECT 2 * (SELECT count(*) FROM once) AS buildings, (SELECT count(*) FROM once) AS without_units, "
        "count(*) AS listings FROM raw"
    ),
    "html_next_pages": NEXT_PAGES,
    "html_page_frontier": f"WITH chain AS ({NEXT_PAGES}) SELECT DISTINCT next_url AS url FROM chain WHERE next_url NOT IN (SELECT url FROM chain)",
    "append_pages": f"SELECT concat('{fixtures.PAGE_URL}', page_id) AS url, 2 * count(*) AS copies FROM pages GROUP BY page_id",
    "page_links": f"""WITH menu AS (SELECT url, {MENU_LINKS} AS hrefs, {MENU_TEXTS} AS texts FROM pages),
items AS (SELECT url, unnest(range(len(hrefs))) AS link, unnest(hrefs) AS href, unnest(texts) AS text FROM menu)
SELECT url, link, concat('{fixtures.BASE_URL[:-1]}', {_unescaped("href")}) AS target, trim({_unescaped("text")}) AS text FROM items""",
    "csv_roundtrip": f"WITH {CLEAN} SELECT * FROM clean",
    "table_roundtrip": f"WITH {RAW} SELECT * FROM raw",
}
# The same results by another route.
ORACLE |= {
    "station_features_sliced": ORACLE["station_features"],
    "view_scan": ORACLE["featured_view"],
    "stored_view": ORACLE["featured_view"],
    "describe_numeric_by_ranks": ORACLE["describe_numeric"],
    "box_by_station_ranked": ORACLE["box_by_station"],
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
