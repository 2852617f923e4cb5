"""DuckDB text of the derived views, used by the oracle SQL of every query.

Each view mirrors a builder in ``pricelens.sources.adapter``; keep the two in
step.  ``q4`` mirrors ``pricelens.functions.q4``.
"""

from __future__ import annotations

from pricelens.sources.adapter import COST_OF_CULTIVATION, FIXED_DATE_HOLIDAYS


def q4(expr: str) -> str:
    return f"(floor(({expr}) * 10000 + 0.37) / 10000)"


PRICE_PANEL = """
SELECT p.p_type AS commodity, r.r_name AS district, CAST(l.l_shipdate AS DATE) AS date,
       AVG(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS modal_price,
       SUM(l.l_quantity) AS arrival
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2, 3
"""

DAILY_SIGNAL = """
SELECT CAST(o.o_orderdate AS DATE) AS date, r.r_name AS district,
       fmod(SUM(o.o_totalprice), CAST(150000 AS DOUBLE)) / CAST(1250 AS DOUBLE) AS rainfall_mm,
       CAST(20 AS DOUBLE) + AVG(o.o_totalprice) / CAST(20000 AS DOUBLE) AS max_temp,
       CAST(10 AS DOUBLE) + AVG(o.o_totalprice) / CAST(50000 AS DOUBLE) AS min_temp,
       CAST(COUNT(*) AS DOUBLE) * CAST(7.5 AS DOUBLE) AS wind
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
"""

_HOL = ", ".join(f"({m}, {d}, '{name}')" for m, d, name in FIXED_DATE_HOLIDAYS)
CALENDAR = f"""
SELECT make_date(CAST(ys.y AS BIGINT), h.month, h.day) AS date, h.festival AS festival, 1 AS holiday
FROM (SELECT UNNEST(range(MIN(year(l_shipdate)), MAX(year(l_shipdate)) + 1)) AS y FROM lineitem) ys,
     (VALUES {_HOL}) h(month, day, festival)
"""

_COST = ", ".join(f"('{c}', CAST({v} AS DOUBLE))" for c, v in COST_OF_CULTIVATION)
COST_DIM = f"SELECT * FROM (VALUES {_COST}) t(commodity, cost)"

# Panel joined to its district weather and the calendar (one row per key-day).
PANEL_WX = """
SELECT p.commodity, p.district, p.date, p.modal_price, p.arrival,
       w.max_temp, w.min_temp, w.rainfall_mm, w.wind
FROM price_panel p LEFT JOIN daily_signal w ON p.date = w.date AND p.district = w.district
"""

VIEWS = {
    "price_panel": PRICE_PANEL,
    "daily_signal": DAILY_SIGNAL,
    "calendar": CALENDAR,
    "cost_dim": COST_DIM,
    "panel_wx": PANEL_WX,
}
_DEPS = {"panel_wx": ["price_panel", "daily_signal"]}


def with_views(views, body: str, ctes=()) -> str:
    """``WITH <views>, <ctes> <body>``; views are expanded with their dependencies."""
    order: list[str] = []

    def add(v):
        for d in _DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in order] + [f"{n} AS ({s})" for n, s in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
