"""The same fixture views as ANSI SQL (DuckDB dialect) for the oracle queries.

Written from FIXTURES.md, independently of the DataFrame code in
``fixtures.py``; ``with_views`` prepends only the views a query names.
"""

from __future__ import annotations

import re

from .schemas import RAW_HEADER

# SQL must name its columns: the quarters that the driver tables hold at every scale factor.
CITY_INDEX_LABELS = [f" {m:02d}-{y}" for y in range(1995, 2002) for m in (3, 6, 9, 12)][:-1]

_LISTING = """
SELECT *, greatest(sqft_living - sqft_basement, 0.0e0) AS sqft_above,
       sqft_living + (id % 10) * 10 AS sqft_living15,
       sqft_lot + (id % 7) * 100 AS sqft_lot15,
       50000 + 120 * sqft_living + 15000 * grade + 200000 * waterfront + 20000 * "view"
         - 400 * airport_distance_km + 3000 * (zipcode % 10) + noise AS price
FROM (
  SELECT l_orderkey * 10000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                                 l_quantity, l_extendedprice) AS id,
         1 + p_size % 6 AS bedrooms,
         1 + (p_size % 9) * 0.25e0 AS bathrooms,
         400 + l_quantity * 80 + (l_partkey % 7) * 10 AS sqft_living,
         CAST(1000 + (l_partkey * 37) % 20000 AS DOUBLE) AS sqft_lot,
         1 + (l_linenumber % 4) * 0.5e0 AS floors,
         CASE WHEN l_suppkey % 25 = 0 THEN 1 ELSE 0 END AS waterfront,
         CAST(CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey % 4 ELSE 0 END AS INTEGER) AS "view",
         1 + p_size % 5 AS "condition",
         4 + p_size % 9 AS grade,
         CASE WHEN l_partkey % 3 = 0 THEN l_quantity * 20 ELSE 0.0e0 END AS sqft_basement,
         CAST(1900 + p_partkey % 99 AS INTEGER) AS yr_built,
         CAST(CASE WHEN l_partkey % 11 = 0 THEN 1980 + l_partkey % 15 ELSE 0 END AS INTEGER) AS yr_renovated,
         CAST(122000 + c_nationkey * 4 + c_custkey % 4 AS INTEGER) AS zipcode,
         8 + c_nationkey + (l_partkey % 100) * 0.01e0 AS lat,
         70 + c_nationkey * 0.5e0 + (l_suppkey % 100) * 0.01e0 AS long,
         l_linenumber % 3 + 1 AS schools_nearby,
         CAST(l_orderkey % 120 AS DOUBLE) AS airport_distance_km,
         CAST(year(o_orderdate) AS INTEGER) AS sale_year,
         CAST(month(o_orderdate) AS INTEGER) AS sale_month,
         l_extendedprice * 0.5e0 AS noise,
         o_orderdate, o_orderpriority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
) b
"""

_COLS = ("id, bedrooms, bathrooms, sqft_living, sqft_lot, floors, waterfront, \"view\", "
         "\"condition\", grade, sqft_above, sqft_basement, yr_built, yr_renovated, zipcode, "
         "lat, long, sqft_living15, sqft_lot15, schools_nearby, airport_distance_km, "
         "sale_year, sale_month, noise, price")

_Q = ", ".join(f"avg(CASE WHEN q = '{lab}' THEN o_totalprice END) AS q{i}"
               for i, lab in enumerate(CITY_INDEX_LABELS))
_W = ", ".join(
    (f"CASE WHEN n_nationkey % 5 <> 0 THEN 100 * q{i} / q0 END" if i == len(CITY_INDEX_LABELS) - 1
     else f"100 * q{i} / q0") + f' AS "{lab}"'
    for i, lab in enumerate(CITY_INDEX_LABELS))

_Y1 = "(SELECT year(max(o_orderdate) + INTERVAL 1 DAY) - 1 FROM orders)"
_Y0 = "(SELECT year(max(o_orderdate) + INTERVAL 1 DAY) - 2 FROM orders)"

VIEWS: dict[str, str] = {
    "listing_base": _LISTING,
    "properties": f"SELECT {_COLS} FROM listing_base",
    "properties_dirty": f"""
SELECT * FROM pd0 UNION ALL SELECT * FROM pd0 WHERE id % 101 = 0
""",
    "pd0": """
SELECT id, bedrooms,
       CASE WHEN id % 17 <> 0 THEN bathrooms END AS bathrooms,
       sqft_living,
       CASE WHEN id % 997 <> 0 THEN sqft_lot END AS sqft_lot,
       CASE WHEN NOT (id % 23 = 0 OR zipcode = 122003) THEN floors END AS floors,
       CASE WHEN id % 29 <> 0 THEN waterfront END AS waterfront,
       "view", "condition", grade, sqft_above, sqft_basement, yr_built, yr_renovated, zipcode,
       lat, long, sqft_living15, sqft_lot15, schools_nearby,
       CASE WHEN id % 991 <> 0 THEN airport_distance_km END AS airport_distance_km,
       sale_year, sale_month, noise,
       CASE WHEN id % 211 = 0 THEN NULL WHEN id % 1009 = 0 THEN price * 20 ELSE price END AS price
FROM properties
""",
    "properties_text": """
SELECT id,
       concat('  ', o_orderpriority, ' ') AS priority,
       CASE WHEN id % 7 = 0 THEN concat(CAST(bedrooms AS VARCHAR), '.6')
            ELSE CAST(bedrooms AS VARCHAR) END AS bedrooms,
       CASE WHEN id % 37 = 0 THEN 'n/a' ELSE CAST(CAST(sqft_living AS BIGINT) AS VARCHAR) END AS sqft_living,
       CASE WHEN id % 41 = 0 THEN 'unknown' WHEN waterfront = 1 THEN 'Y' ELSE 'N' END AS waterfront,
       CASE "condition" WHEN 1 THEN 'Poor' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Average'
            WHEN 4 THEN 'Good' WHEN 5 THEN 'Very Good' END AS "condition",
       CASE WHEN id % 43 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y%m%dT%H%M%S') END AS "date",
       CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS INTEGER) AS date_serial,
       CAST(price AS VARCHAR) AS price
FROM listing_base
""",
    "listings_raw": "SELECT " + ", ".join(
        (f'CAST(date_diff(\'day\', DATE \'1899-12-30\', CAST(o_orderdate AS DATE)) AS INTEGER) AS "{raw}"'
         if new == "date_serial" else f'"{new}" AS "{raw}"')
        for raw, new in RAW_HEADER) + " FROM listing_base",
    "second_market_raw": """
SELECT p.id, p.bedrooms, p.bathrooms, p.sqft_living, p.sqft_lot, p.floors, p."view", p.grade,
       p.sqft_above, p.sqft_basement, p.yr_built, p.yr_renovated, p.zipcode, p.lat, p.long,
       p.sqft_living15, p.sqft_lot15, p.price, t.waterfront, t."condition", t."date"
FROM properties p JOIN properties_text t ON p.id = t.id
""",
    "orders_by_nation": """
SELECT o_orderkey, o_totalprice, o_orderdate, n_nationkey, n_name, n_regionkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""",
    "series": """
SELECT concat('R', CAST(n_regionkey AS VARCHAR)) AS country_code,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS "date",
       avg(o_totalprice) AS price
FROM orders_by_nation GROUP BY 1, 2
""",
    "series_nominal": """
SELECT country_code, "date", price * (1 + 0.03e0 * (year("date") - 1995)) AS price FROM series
""",
    "city_index_wide": f"""
SELECT n_name AS "Particulars", {_W}
FROM (SELECT n_nationkey, n_name, {_Q}
      FROM (SELECT *, concat(' ', lpad(CAST(quarter(o_orderdate) * 3 AS VARCHAR), 2, '0'), '-',
                             CAST(year(o_orderdate) AS VARCHAR)) AS q
            FROM orders_by_nation) x
      GROUP BY n_nationkey, n_name) w
""",
    "city_market": f"""
SELECT a.n_name AS city, a.avg_price_cr, a.yoy_growth, y.rental_yield, a.inventory_score,
       CAST(8 + a.n_nationkey AS DOUBLE) AS lat, 70 + a.n_nationkey * 0.5e0 AS lon
FROM (SELECT n_nationkey, n_name, avg(o_totalprice) / 100000 AS avg_price_cr,
             100 * (avg(CASE WHEN year(o_orderdate) = {_Y1} THEN o_totalprice END)
                    / avg(CASE WHEN year(o_orderdate) = {_Y0} THEN o_totalprice END) - 1) AS yoy_growth,
             count(*) AS inventory_score
      FROM orders_by_nation GROUP BY n_nationkey, n_name) a
JOIN (SELECT c_nationkey, avg(l_discount) * 100 AS rental_yield
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      GROUP BY c_nationkey) y ON a.n_nationkey = y.c_nationkey
""",
    "predictions": """
SELECT id, (id % 1000003) % 3 AS fold, price AS y, price - noise + 26527 AS p FROM properties
""",
}


def _deps(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with a WITH clause holding every fixture view it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in _deps(VIEWS[name]):
            if d != name:
                visit(d)
        order.append(name)

    for v in _deps(sql):
        visit(v)
    if not order:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in order)
    body = sql.strip()
    for lead in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(lead):
            return f"{lead}{ctes},\n{body[len(lead):]}"
    return f"WITH {ctes}\n{body}"
