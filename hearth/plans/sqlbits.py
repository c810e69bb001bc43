"""SQL snippets shared by oracle queries (DuckDB dialect), written from the formulas."""

from ..sources.fixture_sql import CITY_INDEX_LABELS

YOY = """SELECT country_code, "date",
  100 * (price / lag(price, 4) OVER (PARTITION BY country_code ORDER BY "date") - 1) AS price FROM {src}"""

MACRO_BY_YEAR = """SELECT CAST(year("date") AS INTEGER) AS sale_year,
  avg(CASE WHEN s = 'real_price_yoy' THEN price END) AS real_price_yoy,
  avg(CASE WHEN s = 'real_price_idx' THEN price END) AS real_price_idx,
  avg(CASE WHEN s = 'nom_price_yoy' THEN price END) AS nom_price_yoy,
  avg(CASE WHEN s = 'nom_price_idx' THEN price END) AS nom_price_idx
FROM (SELECT 'real_price_yoy' AS s, * FROM (""" + YOY.format(src="series") + """) a
      UNION ALL SELECT 'real_price_idx', * FROM series
      UNION ALL SELECT 'nom_price_yoy', * FROM (""" + YOY.format(src="series_nominal") + """) b
      UNION ALL SELECT 'nom_price_idx', * FROM series_nominal) u
WHERE country_code = 'R0' AND "date" IS NOT NULL AND price IS NOT NULL
GROUP BY 1"""

REVERSED_QUARTERS = ", ".join(f'"{c}"' for c in reversed(CITY_INDEX_LABELS))

LATEST_HPI = f"""SELECT coalesce((SELECT coalesce({REVERSED_QUARTERS}, 200.0e0) FROM city_index_wide
  WHERE trim("Particulars") = 'INDIA' LIMIT 1), 200.0e0) AS latest_hpi"""

ENRICHED = """SELECT p.*, m.real_price_yoy, m.real_price_idx, m.nom_price_yoy, m.nom_price_idx,
  h.latest_hpi
FROM properties p LEFT JOIN (""" + MACRO_BY_YEAR + """) m ON p.sale_year = m.sale_year
CROSS JOIN (""" + LATEST_HPI + """) h"""


SEASON = """CASE WHEN sale_month IN (12, 1, 2) THEN 'winter' WHEN sale_month IN (3, 4, 5) THEN 'spring'
  WHEN sale_month IN (6, 7, 8) THEN 'summer' ELSE 'fall' END"""


def matrix_sql() -> str:
    """The feature matrix of all listings: scaled numbers, ordinal ranks, season flags, target encoding."""
    numeric = ["bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "sqft_above", "sqft_basement", "yr_built", "yr_renovated", "lat",
               "long", "sqft_living15", "sqft_lot15", "schools_nearby", "airport_distance_km", "property_age", "has_renovated",
               "years_since_renovation", "basement_ratio", "market_demand_index", "size_vs_neighborhood", "school_accessibility",
               "total_interior_area", "grade_condition_score", "waterfront_view_premium", "real_price_yoy", "real_price_idx", "nom_price_yoy",
               "nom_price_idx", "latest_hpi"]
    ordinal = ["waterfront", "view", "condition", "grade", "sale_month", "sale_year", "schools_nearby"]
    iqr = lambda c: f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
    scaled = ", ".join(f"round(coalesce((f.{c} - s.m{i}) / s.r{i}, 0.0e0), 6) AS {c}" for i, c in enumerate(numeric))
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS m{i}, CASE WHEN {iqr(c)} = 0 THEN 1.0e0 ELSE {iqr(c)} END AS r{i}" for i, c in enumerate(numeric))
    ranks = ", ".join(f"CAST(coalesce(o{i}.code, -2) AS INTEGER) AS {c}_ord" for i, c in enumerate(ordinal))
    joins = " ".join(f"""LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT "{c}" AS v FROM f
                     WHERE "{c}" IS NOT NULL) d) o{i} ON f."{c}" = o{i}.v""" for i, c in enumerate(ordinal))
    seasons = ", ".join(f"CASE WHEN f.season = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS sale_season_{v}" for v in ("fall", "spring", "summer", "winter"))
    return f"""
WITH e AS ({ENRICHED}),
z AS (SELECT zipcode, quantile_cont(price, 0.5) AS zp, quantile_cont(sqft_living, 0.5) AS zs, avg(price) AS m, count(*) AS n FROM e GROUP BY zipcode),
g AS (SELECT quantile_cont(price, 0.5) AS gp, quantile_cont(sqft_living, 0.5) AS gs, avg(price) AS prior FROM e),
f AS (SELECT e.*, greatest(sale_year - yr_built, 0) AS property_age, CASE WHEN yr_renovated > 0 THEN 1 ELSE 0 END AS has_renovated,
        greatest(CASE WHEN yr_renovated > 0 THEN sale_year - yr_renovated ELSE greatest(sale_year - yr_built, 0) END, 0) AS years_since_renovation,
        least(greatest(coalesce(sqft_basement / nullif(sqft_living, 0), 0.0e0), 0.0e0), 1.0e0) AS basement_ratio,
        z.zp / g.gp AS market_demand_index, sqft_living / CASE WHEN z.zs = 0 THEN 1 ELSE z.zs END AS size_vs_neighborhood,
        CASE WHEN ln(1 + airport_distance_km) <> 0 THEN schools_nearby / ln(1 + airport_distance_km) END AS school_accessibility,
        sqft_above + sqft_basement AS total_interior_area, grade * "condition" AS grade_condition_score,
        waterfront * CASE WHEN "view" > 0 THEN 1 ELSE 0 END AS waterfront_view_premium, {SEASON} AS season,
        (z.n * z.m + 10 * g.prior) / (z.n + 10) AS te
      FROM e JOIN z ON e.zipcode = z.zipcode CROSS JOIN g),
s AS (SELECT {stats} FROM f)
SELECT f.id, round(f.price, 6) AS price, {scaled}, {ranks}, {seasons}, round(f.te, 6) AS zipcode_te
FROM f CROSS JOIN s {joins}
"""


def _correlations(cols: list[str]) -> str:
    """The correlation matrix of the complete rows of ``properties``, row by row in one list."""
    whole = " AND ".join(f'"{c}" IS NOT NULL' for c in cols)
    return f"""SELECT [{", ".join(f'corr("{a}", "{b}")' for a in cols for b in cols)}] AS r FROM properties WHERE {whole}"""


def _swept(m: str, k: str, p: int) -> str:
    """Matrix ``m`` with column ``k`` (from 0) cleared outside of its row; a column without anything left is passed over."""
    return f"""CASE WHEN {m}[{k} * {p} + {k} + 1] <= 1e-9 THEN {m} ELSE list_transform(range({p * p}), lambda x: {m}[x + 1] - CASE WHEN x // {p} = {k} THEN 0.0e0
      ELSE {m}[(x // {p}) * {p} + {k} + 1] * {m}[{k} * {p} + x % {p} + 1] / {m}[{k} * {p} + {k} + 1] END) END"""


def vif_sql(cols: list[str]) -> str:
    """VIFs by the sweep operator: what is left of a column's variance when all others are swept out is 1 − R²."""
    p = len(cols)
    names = ", ".join(f"'{c}'" for c in cols)
    return f"""
WITH RECURSIVE r AS ({_correlations(cols)}),
s AS (SELECT CAST(i AS BIGINT) AS i, CAST(0 AS BIGINT) AS k, r AS m FROM r, range({p}) t(i)
      UNION ALL SELECT i, k + 1, CASE WHEN k = i THEN m ELSE {_swept("m", "k", p)} END FROM s WHERE k < {p}),
v AS (SELECT i, m[i * {p} + i + 1] AS rest FROM s WHERE k = {p})
SELECT [{names}][i + 1] AS "column", CASE WHEN rest > 1e-12 THEN round(1 / rest, 6) END AS vif, rest <= 1e-12 AS infinite FROM v
"""


def vif_prune_sql(cols: list[str], threshold: float) -> str:
    """Pruning: sweep for every kept column, drop the one with the greatest VIF (the first on ties), begin again."""
    p = len(cols)
    names = ", ".join(f"'{c}'" for c in cols)
    vif = f"CASE WHEN m[keep[i] * {p} + keep[i] + 1] > 1e-12 THEN 1 / m[keep[i] * {p} + keep[i] + 1] ELSE 'infinity'::DOUBLE END"
    return f"""
WITH RECURSIVE r AS ({_correlations(cols)}),
s AS (
  SELECT r, CAST(range({p}) AS BIGINT[]) AS keep, CAST([] AS BIGINT[]) AS gone, CAST([] AS DOUBLE[]) AS found, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS k, r AS m,
         CAST(0 AS DOUBLE) AS best, CAST(-1 AS BIGINT) AS which, false AS done FROM r
  UNION ALL
  SELECT r,
    CASE WHEN i > len(keep) AND best > {threshold} AND len(keep) > 1 THEN list_filter(keep, lambda c: c <> which) ELSE keep END,
    CASE WHEN i > len(keep) AND best > {threshold} AND len(keep) > 1 THEN list_append(gone, which) ELSE gone END,
    CASE WHEN i > len(keep) AND best > {threshold} AND len(keep) > 1 THEN list_append(found, best) ELSE found END,
    CASE WHEN i > len(keep) THEN 1 WHEN k > len(keep) THEN i + 1 ELSE i END,
    CASE WHEN i > len(keep) OR k > len(keep) THEN 1 ELSE k + 1 END,
    CASE WHEN i > len(keep) OR k > len(keep) THEN r WHEN keep[k] = keep[i] THEN m ELSE {_swept("m", "keep[k]", p)} END,
    CASE WHEN i > len(keep) THEN 0 WHEN k > len(keep) THEN greatest(best, {vif}) ELSE best END,
    CASE WHEN i > len(keep) THEN -1 WHEN k > len(keep) AND {vif} > best THEN keep[i] ELSE which END,
    i > len(keep) AND NOT (best > {threshold} AND len(keep) > 1)
  FROM s WHERE NOT done),
f AS (SELECT gone, found FROM s WHERE done)
SELECT [{names}][c + 1] AS "column", list_contains(gone, c) AS dropped, CAST(nullif(coalesce(list_position(gone, c), 0), 0) - 1 AS INTEGER) AS drop_order,
       CASE WHEN isfinite(found[list_position(gone, c)]) THEN round(found[list_position(gone, c)], 6) END AS vif_at_drop FROM f, range({p}) t(c)
"""


def _mixed(source: str, x: str, name: str) -> str:
    """``source`` with the splitmix64 finaliser of ``x``; one subquery a step, since aliases of one select are expanded in place."""
    times = lambda v, by: f"CAST(CAST({v} AS UHUGEINT) * '{by}'::UHUGEINT & '{(1 << 64) - 1}'::UHUGEINT AS UBIGINT)"
    one = f"SELECT *, {x} AS _x FROM ({source})"
    two = f"SELECT * REPLACE ({times('xor(_x, _x >> 30)', 0xBF58476D1CE4E5B9)} AS _x) FROM ({one})"
    three = f"SELECT * REPLACE ({times('xor(_x, _x >> 27)', 0x94D049BB133111EB)} AS _x) FROM ({two})"
    return f"SELECT * EXCLUDE (_x), xor(_x, _x >> 31) AS {name} FROM ({three})"


def _start_sql(x: str, add: int) -> str:
    return f"CAST((CAST({x} AS UHUGEINT) + '{add % (1 << 64)}'::UHUGEINT) & '{(1 << 64) - 1}'::UHUGEINT AS UBIGINT)"


def _uniform(source: str, key: str, seed: int, name: str) -> str:
    """``source`` (which has ``th``, the tree's hash) with a uniform number for (key, tree)."""
    keyed = _mixed(source, _start_sql(key, seed * 0x9E3779B97F4A7C15), f"{name}_k")
    return f"SELECT * EXCLUDE ({name}_k, {name}_h), CAST({name}_h >> 11 AS DOUBLE) / {float(1 << 53)!r} AS {name} FROM ({_mixed(keyed, f'xor({name}_k, th)', f'{name}_h')})"


def iforest_ctes(source: str, cols: list[str], trees: int = 200, psi: int = 256, seed: int = 42, contamination: float = 0.03) -> str:
    """CTEs down to ``kept(id, score)``: an isolation forest over ``source``, level by level (for tables of ``psi`` rows or more)."""
    depth = (psi - 1).bit_length()
    euler = 0.5772156649015329
    c = lambda n: f"CASE WHEN {n} > 2 THEN 2.0e0 * (ln({n} - 1.0e0) + {euler}e0) - 2.0e0 * ({n} - 1.0e0) / {n} WHEN {n} = 2 THEN 1.0e0 ELSE 0.0e0 END"
    row = ", ".join(f"CAST({x} AS DOUBLE)" for x in cols)
    keyed = _mixed(f"SELECT id, [{row}] AS x FROM {source}", _start_sql("id", seed * 0x9E3779B97F4A7C15), "k")
    hashed = _mixed(f"SELECT range AS tree FROM range({trees})", _start_sql("tree", 0x632BE59BD9B4E019), "th")
    drawn = _mixed("SELECT tree, th, id, k FROM keyed CROSS JOIN trees_", "xor(k, th)", "h")
    out = [f"keyed AS MATERIALIZED ({keyed})", "rows_ AS MATERIALIZED (SELECT id, x FROM keyed)", f"trees_ AS MATERIALIZED ({hashed})",
           f"drawn AS MATERIALIZED (SELECT tree, th, id, u FROM (SELECT tree, th, id, CAST(h >> 11 AS DOUBLE) / {float(1 << 53)!r} AS u FROM ({drawn})) "
           f"WHERE u < {16 * psi}.0e0 / (SELECT count(*) FROM rows_) QUALIFY row_number() OVER (PARTITION BY tree ORDER BY u, id) <= {psi})",
           "m0 AS MATERIALIZED (SELECT tree, th, d.id, x, 1 AS path FROM drawn d JOIN rows_ r ON d.id = r.id)"]
    lows, highs = (", ".join(f"{f}(x[{i + 1}])" for i in range(len(cols))) for f in ("min", "max"))
    for d in range(depth + 1):
        grow = "len(usable) > 0 AND n > 1" if d < depth else "false"
        out.append(f"g{d} AS (SELECT tree, th, path, count(*) AS n, [{lows}] AS lo, [{highs}] AS hi FROM m{d} GROUP BY ALL)")
        usable = f"SELECT *, list_filter({list(range(1, len(cols) + 1))}, lambda i: hi[i] > lo[i]) AS usable FROM g{d}"
        lots = _uniform(_uniform(usable, "2 * path", seed + 1, "pick"), "2 * path + 1", seed + 1, "share")
        axis = f"SELECT *, CASE WHEN {grow} THEN usable[1 + CAST(floor(pick * len(usable)) AS INTEGER)] END AS f FROM ({lots})"
        out.append(f"n{d} AS MATERIALIZED (SELECT tree, path, f, lo[f] + share * (hi[f] - lo[f]) AS t, "
                   f"CAST(round_even(({d} + {c('n')}) / 1e-9, 0) AS BIGINT) AS v FROM ({axis}))")
        if d < depth:
            out.append(f"m{d + 1} AS MATERIALIZED (SELECT m.tree, th, id, x, 2 * m.path + CASE WHEN x[f] <= t THEN 0 ELSE 1 END AS path "
                       f"FROM m{d} m JOIN n{d} n ON m.tree = n.tree AND m.path = n.path WHERE f IS NOT NULL)")
    nodes = " UNION ALL ".join(f"SELECT tree, path, f, t, v FROM n{d}" for d in range(depth + 1))
    # one subquery a step: column aliases of one select are expanded in place, which doubles them at every step
    walk = "SELECT id, x, fs, ts, vs, 1 AS p FROM rows_ CROSS JOIN forest"
    for _ in range(depth):
        walk = f"SELECT id, x, fs, ts, vs, CASE WHEN fs[p] IS NULL THEN p WHEN x[fs[p]] <= ts[p] THEN 2 * p ELSE 2 * p + 1 END AS p FROM ({walk})"
    out += [f"nodes AS ({nodes})",
            f"places AS (SELECT t.range AS tree, p.range AS path FROM range({trees}) t CROSS JOIN range(1, {2 << depth}) p)",
            "forest AS MATERIALIZED (SELECT tree, list(f ORDER BY path) AS fs, list(t ORDER BY path) AS ts, "
            "list(coalesce(v, CAST(floor(log2(path)) AS BIGINT) * 1000000000) ORDER BY path) AS vs FROM places LEFT JOIN nodes USING (tree, path) GROUP BY tree)",
            f"walked AS (SELECT id, vs[p] AS v FROM ({walk}))",
            f"scored AS MATERIALIZED (SELECT id, pow(2.0e0, -(sum(v)::DOUBLE * 1e-9 / {trees}) / ({c(f'{float(psi)}e0')})) AS score FROM walked GROUP BY id)",
            f"kept AS (SELECT id, score FROM scored WHERE score <= (SELECT quantile_cont(score, {1 - contamination!r}) FROM scored))"]
    return ", ".join(out)
