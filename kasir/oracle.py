"""DuckDB SQL for every registered query: an independent re-statement of each
job over the same driver tables, used as the correctness oracle.

Rules that keep the two engines comparable (see FIXTURES.md): group by
position where an alias shadows a column, NULLS FIRST in every window order,
``'g'`` on regexp_replace, ``cast(1.1 as double)``, month as a DATE, week via
``%U``, GREATEST guarded for NULL, integer sums cast to BIGINT, money summed as
DECIMAL and cast to DOUBLE only at the end.
"""

from __future__ import annotations

import datetime as _dt

from kasir.config import (
    MENU_STORE_ATTRS,
    SAME_YEAR_ATTRS,
    STORE_ATTRS,
)
from kasir.sources import fixtures as fx

# Labels, patterns and parameters, spelled out here a second time
# so that a slip in the code under test shows.
VISIT_CHANNELS = (
    ("OFFLINE", ("01.DINE IN", "02.TAKE AWAY", "06.COMPLIMENT")),
    ("GOFOOD", ("03.GOFOOD INT",)),
    ("GRABFOOD", ("04.GRAB FOOD INT",)),
    ("SHOPEEFOOD", ("05.SHOPEE FOOD INT",)),
)
TENDER_CHANNELS = (
    ("OFFLINE", (
        "EDC", "CASH", "RESERVASI", "COMPLIMENT", "QRIS SHOPEE", "CLOUD VOUCHER",
        "OTHERS", "VOUCHER", "EDC CIMB", "QRIS ESB ORDER TABLE", "OVO", "DEBIT BCA",
        "QRIS ESB KIOSK", "VISA CARD", "EDC NIAGA", "QRISIA", "QRIS TELKOM", "TUNAI",
        "MASTER CARD", "FLAZZ", "EDC BRI QRIS", "SHOPEE", "QRIS BNI", "QRIS", "GOPAY")),
    ("GRABFOOD", ("GRAB FOOD", "GRAB_FD")),
    ("SHOPEEFOOD", ("SHOPEEPAY", "SHOPEE PAY", "SHOPEEFOOD INT")),
    ("GOFOOD", ("GO RESTO", "GOFOOD", "GORESTO")),
    ("OTHER ONLINE", ("OKJEK", "AIRASIA FOOD")),
)
UNKNOWN = "Unknown"
ONLINE = ("GOFOOD", "GRABFOOD", "SHOPEEFOOD")
TAX = "1.1"
UNICODE_SPACE_CLASS = (r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
ASCII_SPACE_RUN = r"[\t\n\f\r ]+"
COHORT_FROM = _dt.date(1997, 1, 1)
COHORT_DAYS = 90
SAME_YEAR_FROM = _dt.date(1998, 1, 1)
MENU_UNTIL = _dt.date(1998, 12, 31)
AS_OF = _dt.date(1999, 6, 1)
YEAR_FLOOR = 1997
YEAR_WHEN_NULL = 2016
OVERRIDE_CODE = "Supplier#000000003"
OVERRIDE_NAME = "HEAD OFFICE"
NET = "DECIMAL(38,6)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(labels) -> str:
    return "(" + ", ".join(_q(x) for x in labels) + ")"


def _map(col: str, mapping, default: str) -> str:
    whens = " ".join(f"WHEN {col} IN {_in(labels)} THEN {_q(t)}" for t, labels in mapping)
    return f"CASE {whens} ELSE {_q(default)} END"


def _label(key: str, labels) -> str:
    """The label at the key's remainder; one past the last is NULL."""
    items = ", ".join(_q(x) for x in labels)
    return f"([{items}])[CAST({key} % {len(labels) + 1} AS INTEGER) + 1]"


def _money4(col: str, key: str) -> str:
    return (f"CAST(CAST({col} AS DECIMAL(18,4)) + CAST({key} % 97 AS DECIMAL(10,0)) "
            f"* CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4))")


def _key(col: str) -> str:
    trimmed = (f"regexp_replace({col}, '^{UNICODE_SPACE_CLASS}+|{UNICODE_SPACE_CLASS}+$', '', 'g')")
    return f"lower(regexp_replace({trimmed}, '{ASCII_SPACE_RUN}', ' ', 'g'))"


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _attrs(prefix: str, attrs=STORE_ATTRS) -> str:
    return ", ".join(f"{prefix}.{a}" for a in attrs)


def _month(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def _lagorder(order: str, extra: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in [order, *extra])


# name -> (SQL body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql, deps)


def with_ctes(names: list[str], final: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# --- fixture inputs ----------------------------------------------------------

cte("fx_store", f"""
SELECT CASE WHEN s.s_suppkey % 10 = 9 THEN 'X' ELSE '' END || CAST(s.s_suppkey AS VARCHAR) AS CODE_GIS,
  CASE WHEN s.s_suppkey % 10 = 9 THEN 'Closed ' ELSE '' END || s.s_name AS NEW_CODE_STORE,
  'Store ' || s.s_name AS STORE,
  CASE WHEN s.s_suppkey % 17 = 0 THEN NULL
       ELSE {_d(_dt.date.fromisoformat(fx.OPEN_BASE))} + CAST((s.s_suppkey * 23) % 2400 AS INTEGER) END AS OPEN_STORE,
  'OPS ' || CAST(s.s_suppkey % 7 AS VARCHAR) AS NAMA_OPS,
  'AH ' || CAST(s.s_suppkey % 5 AS VARCHAR) AS AREA_HEAD,
  'RM ' || CAST(s.s_suppkey % 3 AS VARCHAR) AS RM,
  'CITY ' || CAST(s.s_suppkey % 11 AS VARCHAR) AS CITY,
  'AM ' || CAST(s.s_suppkey % 13 AS VARCHAR) AS AM,
  r.r_name AS PROVINSI, n.n_name AS KOTA,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'JAVA' ELSE 'OUTER JAVA' END AS JAVA___OUTER_JAVA,
  'K' || CAST(s.s_suppkey % 4 AS VARCHAR) AS TYPE_KITCHEN,
  CASE WHEN s.s_suppkey % 19 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS STATUS
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("fx_bills", f"""
SELECT CAST(l_shipdate AS DATE) AS "Sales Date", CAST(l_suppkey AS VARCHAR) AS Branch,
  {_label("(l_orderkey + l_linenumber)", fx.VISIT_PURPOSES)} AS "Visit Purpose",
  CAST(l_orderkey AS VARCHAR) AS "Bill Number",
  {_money4("l_extendedprice", "l_orderkey")} AS "Net Sales"
FROM lineitem""")

_TENDER = _label("o_orderkey", fx.TENDERS)
_LEGACY_STORE = f"'{fx.LEGACY_STORE_PREFIX}' || CAST(o_custkey % 10 AS VARCHAR)"

cte("fx_sales_value", f"""
SELECT CAST(o_orderdate AS DATE) AS Date, {_LEGACY_STORE} AS RESTO, {_TENDER} AS Order_Type,
  {_money4("o_totalprice", "o_orderkey")} AS Value FROM orders""")
cte("fx_sales_tc", f"""
SELECT CAST(o_orderdate AS DATE) AS Date,
  CASE WHEN o_orderstatus = 'P' THEN 'Moved ' ELSE '' END || {_LEGACY_STORE} AS RESTO,
  {_TENDER} AS Order_Type, CAST(1 AS BIGINT) AS Value FROM orders""")

cte("fx_store_days", """
SELECT DISTINCT s.s_suppkey, s.s_name,
  CAST(l.l_shipdate AS DATE) + CASE WHEN l.l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS day
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
cte("fx_targets", """
SELECT s_name AS code, day AS date_daily, CAST(s_suppkey * 100 + 1000 AS DOUBLE) AS target_sales_nett
FROM fx_store_days""", ("fx_store_days",))
cte("fx_adjustments", """
SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS date, s_name AS RESTO,
  CASE s_suppkey % 3 WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN 0.0::DOUBLE ELSE 1.05::DOUBLE END AS percentage_gap,
  CAST(s_suppkey * 7 AS DOUBLE) AS sales_taf
FROM fx_store_days""", ("fx_store_days",))

cte("fx_productmix", f"""
SELECT CAST(o.o_orderdate AS DATE) AS Date,
  '{fx.LEGACY_STORE_PREFIX}' || CAST(o.o_custkey % 10 AS VARCHAR) AS Code,
  p.p_name AS Product, l.l_quantity AS QTY
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""")

cte("fx_menu_report", """
SELECT CAST(l.l_shipdate AS DATE) AS "Sales Date", CAST(l.l_suppkey AS VARCHAR) AS Branch,
  CASE WHEN p.p_partkey % 3 = 0 THEN chr(9) || ' ' || upper(p.p_name) || '  '
       WHEN p.p_partkey % 7 = 0 THEN 'unlisted ' || p.p_name
       ELSE replace(p.p_name, ' ', '   ') END AS "Menu Name",
  l.l_quantity AS Qty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")

cte("fx_lookup", """
SELECT p_name AS product, upper(p_name) AS product_cleaned, min(p_type) AS category,
  min(p_brand) AS product_cleaned_2
FROM part GROUP BY p_name""")

cte("fx_lookup_modern", """
SELECT p_name AS product, 'M ' || p_name AS product_cleaned, max(p_type) AS category,
  max(p_brand) AS product_cleaned_2
FROM part GROUP BY p_name""")

# --- Q01 combined sales -------------------------------------------------------

cte("modern_daily", f"""
SELECT Date, RESTO, Order_Type, COUNT(DISTINCT bill) AS total_tc,
  CAST(SUM(net) AS {NET}) AS total_sales_net
FROM (SELECT b."Sales Date" AS Date, s.NEW_CODE_STORE AS RESTO,
        {_map('b."Visit Purpose"', VISIT_CHANNELS, UNKNOWN)} AS Order_Type,
        b."Bill Number" AS bill, b."Net Sales" AS net
      FROM fx_bills b LEFT JOIN fx_store s ON b.Branch = s.CODE_GIS) x
GROUP BY 1, 2, 3""", ("fx_bills", "fx_store"))

cte("legacy_money", f"""
SELECT Date, RESTO, {_map('Order_Type', TENDER_CHANNELS, UNKNOWN)} AS Order_Type,
  CAST(CAST(CAST(SUM(Value) AS DOUBLE) / CAST({TAX} AS DOUBLE) AS DECIMAL(24,6)) AS {NET}) AS total_sales_net
FROM fx_sales_value GROUP BY 1, 2, 3""", ("fx_sales_value",))

cte("legacy_count", f"""
SELECT Date, RESTO, {_map('Order_Type', TENDER_CHANNELS, UNKNOWN)} AS Order_Type,
  CAST(SUM(Value) AS BIGINT) AS total_tc
FROM fx_sales_tc GROUP BY 1, 2, 3""", ("fx_sales_tc",))

cte("legacy_daily", """
SELECT m.Date, m.RESTO, m.Order_Type, c.total_tc, m.total_sales_net
FROM legacy_money m JOIN legacy_count c
  ON m.Date = c.Date AND m.RESTO = c.RESTO AND m.Order_Type = c.Order_Type""",
    ("legacy_money", "legacy_count"))

cte("feed_union", """
SELECT Date, RESTO, Order_Type, total_tc, total_sales_net FROM modern_daily
UNION ALL
SELECT Date, RESTO, Order_Type, total_tc, total_sales_net FROM legacy_daily""",
    ("modern_daily", "legacy_daily"))

cte("combined", f"""
SELECT Date, RESTO, Order_Type,
  CASE WHEN Order_Type IN {_in(ONLINE)} THEN 'ONLINE' ELSE 'OFFLINE' END AS Order_Type_Group,
  total_tc, CAST(total_sales_net AS {NET}) AS total_sales_net
FROM feed_union""", ("feed_union",))

# --- Q02-Q04 daily marts -------------------------------------------------------

cte("combined_store", f"""
SELECT c.Date, c.RESTO, c.Order_Type, c.Order_Type_Group, c.total_sales_net, c.total_tc, {_attrs('s')}
FROM combined c LEFT JOIN fx_store s ON c.RESTO = s.NEW_CODE_STORE""", ("combined", "fx_store"))

_A = ", ".join(STORE_ATTRS)

cte("daily1", f"""
SELECT Date, RESTO, Order_Type, Order_Type_Group, total_sales_net, total_tc,
  LAG(CAST(total_sales_net AS DOUBLE) / CAST({TAX} AS DOUBLE)) OVER w AS previous_sales_net,
  LAG(total_tc) OVER w AS previous_tc, {_A}
FROM combined_store
WINDOW w AS (PARTITION BY RESTO, Order_Type ORDER BY {_lagorder('Date', ['total_sales_net', 'total_tc', 'Order_Type_Group', *STORE_ATTRS])})""",
    ("combined_store",))


def _daily_grouped(keys: list[str]) -> str:
    k = ", ".join(f"c.{x}" for x in keys)
    n = len(keys)
    pos = ", ".join(str(i) for i in range(1, n + len(STORE_ATTRS) + 1))
    return f"""
SELECT {k}, CAST(SUM(c.total_sales_net) AS {NET}) AS total_sales_net,
  CAST(SUM(c.total_tc) AS BIGINT) AS total_tc, {_attrs('s')}
FROM combined c LEFT JOIN fx_store s ON c.RESTO = s.NEW_CODE_STORE
GROUP BY {", ".join(f"c.{x}" for x in keys)}, {_attrs('s')}"""


cte("daily2_base", _daily_grouped(["Date", "RESTO", "Order_Type_Group"]), ("combined", "fx_store"))
cte("daily3_base", _daily_grouped(["Date", "RESTO"]), ("combined", "fx_store"))

cte("daily2", f"""
SELECT Date, RESTO, Order_Type_Group, total_sales_net, total_tc,
  LAG(total_sales_net) OVER w AS previous_sales_net, LAG(total_tc) OVER w AS previous_tc, {_A}
FROM daily2_base
WINDOW w AS (PARTITION BY RESTO, Order_Type_Group ORDER BY {_lagorder('Date', ['total_sales_net', 'total_tc', *STORE_ATTRS])})""",
    ("daily2_base",))

cte("daily3", f"""
SELECT Date, RESTO, total_sales_net, total_tc,
  LAG(total_sales_net) OVER w AS previous_sales_net, LAG(total_tc) OVER w AS previous_tc, {_A}
FROM daily3_base
WINDOW w AS (PARTITION BY RESTO ORDER BY {_lagorder('Date', ['total_sales_net', 'total_tc', *STORE_ATTRS])})""",
    ("daily3_base",))

# --- Q05-Q07 monthly marts (as written: totals from combined ⋈ store, averages
# from the daily mart, left-joined on the keys) ---------------------------------


def _monthly(name: str, keys: list[str], daily: str) -> None:
    kc = ", ".join(f"c.{x}" for x in keys)
    cte(f"{name}_totals", f"""
SELECT {_month('c.Date')} AS month, {kc},
  CAST(SUM(c.total_sales_net) AS {NET}) AS total_sales_net, CAST(SUM(c.total_tc) AS BIGINT) AS total_tc,
  {_attrs('s')}
FROM combined c LEFT JOIN fx_store s ON c.RESTO = s.NEW_CODE_STORE
GROUP BY {_month('c.Date')}, {kc}, {_attrs('s')}""", ("combined", "fx_store"))
    cte(f"{name}_avg", f"""
SELECT {_month('Date')} AS month, {", ".join(keys)},
  CAST(SUM(total_sales_net) AS DOUBLE) / COUNT(total_sales_net) AS avg_sales_net,
  CAST(SUM(total_tc) AS DOUBLE) / COUNT(total_tc) AS avg_tc
FROM {daily} GROUP BY {", ".join(str(i) for i in range(1, len(keys) + 2))}""", (daily,))
    on = " AND ".join(f"t.{x} = a.{x}" for x in ["month", *keys])
    part = ", ".join(f"t.{x}" for x in keys)
    order = _lagorder("t.month", ["t.total_sales_net", "t.total_tc", "a.avg_sales_net", "a.avg_tc",
                                  *[f"t.{a}" for a in STORE_ATTRS]])
    cte(name, f"""
SELECT t.month, {", ".join(f"t.{x}" for x in keys)}, t.total_sales_net, t.total_tc,
  a.avg_sales_net, a.avg_tc,
  LAG(t.total_sales_net) OVER w AS previous_sales_net, LAG(t.total_tc) OVER w AS previous_tc,
  LAG(a.avg_sales_net) OVER w AS avg_previous_sales_net, LAG(a.avg_tc) OVER w AS avg_previous_tc,
  {_attrs('t')}
FROM {name}_totals t LEFT JOIN {name}_avg a ON {on}
WINDOW w AS (PARTITION BY {part} ORDER BY {order})""", (f"{name}_totals", f"{name}_avg"))


_monthly("monthly1", ["RESTO", "Order_Type_Group", "Order_Type"], "daily1")
_monthly("monthly2", ["RESTO", "Order_Type_Group"], "daily2")
_monthly("monthly3", ["RESTO"], "daily3")

# --- Q08, Q09 cohorts -----------------------------------------------------------

cte("distinct_daily", f"""
SELECT Date, RESTO, OPEN_STORE, total_sales_net,
  CAST(date_diff('day', OPEN_STORE, Date) + 1 AS INTEGER) AS days_opened
FROM daily3 WHERE OPEN_STORE >= {_d(COHORT_FROM)}
GROUP BY 1, 2, 3, 4, 5""", ("daily3",))

cte("sales_90days", f"SELECT * FROM distinct_daily WHERE days_opened <= {COHORT_DAYS}",
    ("distinct_daily",))

cte("sales_nso", f"""
SELECT Date, RESTO, {", ".join(SAME_YEAR_ATTRS)}, CAST(SUM(total_sales_net) AS {NET}) AS sales_nett
FROM daily1
WHERE year(Date) = year(OPEN_STORE) AND Date >= {_d(SAME_YEAR_FROM)}
GROUP BY Date, RESTO, {", ".join(SAME_YEAR_ATTRS)}""", ("daily1",))

# --- Q10 tracker ------------------------------------------------------------------

cte("tr_actual", f"""
SELECT Date, RESTO, CAST(SUM(total_sales_net) AS {NET}) AS actual_sales_nett
FROM daily1 GROUP BY Date, RESTO""", ("daily1",))

cte("tr_with_actual", f"""
SELECT t.code, t.date_daily, {_month('t.date_daily')} AS month, t.target_sales_nett, a.actual_sales_nett
FROM fx_targets t LEFT JOIN tr_actual a ON t.code = a.RESTO AND t.date_daily = a.Date""",
    ("fx_targets", "tr_actual"))

cte("tr_gap", f"""
SELECT t.code, t.date_daily, t.month, t.target_sales_nett, t.actual_sales_nett,
  CASE WHEN t.code = {_q(OVERRIDE_CODE)} THEN j.sales_taf
       WHEN CAST(t.actual_sales_nett AS DOUBLE) * j.percentage_gap IS NULL
         OR CAST(t.actual_sales_nett AS DOUBLE) * j.percentage_gap = 0
       THEN CAST(t.actual_sales_nett AS DOUBLE)
       ELSE CAST(t.actual_sales_nett AS DOUBLE) * j.percentage_gap END AS actual_sales_nett_2
FROM tr_with_actual t LEFT JOIN fx_adjustments j ON t.month = j.date AND t.code = j.RESTO""",
    ("tr_with_actual", "fx_adjustments"))

cte("tracker", f"""
SELECT g.code, g.date_daily, CAST(strftime(g.date_daily, '%U') AS INTEGER) AS week_number,
  g.month, g.target_sales_nett,
  CASE WHEN g.date_daily >= {_d(AS_OF)} THEN NULL ELSE g.target_sales_nett END AS ytd_target_sales,
  s.OPEN_STORE, CAST(year(s.OPEN_STORE) AS INTEGER) AS year_open_store,
  CAST(CASE WHEN s.OPEN_STORE IS NULL THEN {YEAR_WHEN_NULL}
            ELSE greatest(year(s.OPEN_STORE), {YEAR_FLOOR}) END AS INTEGER) AS year_open_store2,
  CASE WHEN g.code = {_q(OVERRIDE_CODE)} THEN {_q(OVERRIDE_NAME)} ELSE s.STORE END AS STORE,
  s.PROVINSI, s.KOTA, s.JAVA___OUTER_JAVA, s.AREA_HEAD,
  g.actual_sales_nett, g.actual_sales_nett_2
FROM tr_gap g LEFT JOIN fx_store s ON g.code = s.NEW_CODE_STORE""", ("tr_gap", "fx_store"))

# --- Q11-Q13 menu -------------------------------------------------------------------

cte("menu_legacy_matched", f"""
SELECT p.Date, p.Code, p.Product, p.QTY, k.product_cleaned, k.category, k.product_cleaned_2
FROM fx_productmix p LEFT JOIN fx_lookup k ON {_key('p.Product')} = {_key('k.product')}
WHERE p.Date <= {_d(MENU_UNTIL)}""", ("fx_productmix", "fx_lookup"))

cte("menu_legacy", """
SELECT Date, Code, product_cleaned, category, product_cleaned_2, SUM(QTY) AS Qty
FROM menu_legacy_matched GROUP BY 1, 2, 3, 4, 5""", ("menu_legacy_matched",))

cte("menu_modern", f"""
SELECT m.Date, s.NEW_CODE_STORE AS Code, m.product_cleaned, m.category, m.product_cleaned_2,
  SUM(m.Qty) AS Qty
FROM (SELECT p.Branch, p."Sales Date" AS Date, p.Qty, k.product_cleaned, k.category, k.product_cleaned_2
      FROM fx_menu_report p LEFT JOIN fx_lookup_modern k ON {_key('p."Menu Name"')} = {_key('k.product')}) m
LEFT JOIN fx_store s ON m.Branch = s.CODE_GIS
GROUP BY 1, 2, 3, 4, 5""", ("fx_menu_report", "fx_lookup_modern", "fx_store"))

cte("combined_menu", """
SELECT Date, Code, product_cleaned, category, product_cleaned_2, Qty FROM menu_legacy
UNION ALL
SELECT Date, Code, product_cleaned, category, product_cleaned_2, Qty FROM menu_modern""",
    ("menu_legacy", "menu_modern"))

_MA = ", ".join(MENU_STORE_ATTRS)

cte("prodmix1", f"""
SELECT m.Date, m.Code, m.product_cleaned, m.category, m.product_cleaned_2, m.Qty, {_attrs('s', MENU_STORE_ATTRS)}
FROM combined_menu m JOIN fx_store s ON m.Code = s.NEW_CODE_STORE""", ("combined_menu", "fx_store"))

cte("prodmix2", f"""
SELECT m.Date, m.Code, m.category, SUM(m.Qty) AS Qty, {_attrs('s', MENU_STORE_ATTRS)}
FROM combined_menu m JOIN fx_store s ON m.Code = s.NEW_CODE_STORE
GROUP BY m.Date, m.Code, m.category, {_attrs('s', MENU_STORE_ATTRS)}""", ("combined_menu", "fx_store"))


def _money(cols: list[str], money: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols)


DAILY_MONEY = {"total_sales_net", "previous_sales_net"}


def final(name: str, cols: list[str], money: set[str] = frozenset()) -> str:
    return with_ctes([name], f"SELECT {_money(cols, set(money))} FROM {name}")


__all__ = ["CTES", "with_ctes", "final"]


# --- single operators ----------------------------------------------------------------

cte("chk_map_visit_purpose", f"""
SELECT "Sales Date", Branch, "Bill Number", "Visit Purpose",
  {_map('"Visit Purpose"', VISIT_CHANNELS, UNKNOWN)} AS Order_Type
FROM fx_bills""", ("fx_bills",))

cte("chk_channel_group", """
SELECT Order_Type, Order_Type_Group, COUNT(*) AS n_rows FROM combined GROUP BY 1, 2""", ("combined",))


cte("chk_same_year_filter", """
SELECT Date, RESTO, Order_Type, OPEN_STORE, total_sales_net FROM daily1
WHERE year(Date) = year(OPEN_STORE)""", ("daily1",))

cte("chk_days_open", """
SELECT Date, RESTO, OPEN_STORE, CAST(date_diff('day', OPEN_STORE, Date) + 1 AS INTEGER) AS days_opened
FROM daily3""", ("daily3",))

cte("chk_sunday_week", """
SELECT d AS Date, CAST(strftime(d, '%U') AS INTEGER) AS week_number
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")

cte("chk_year_bucket", f"""
SELECT NEW_CODE_STORE, OPEN_STORE, CAST(year(OPEN_STORE) AS INTEGER) AS year_open_store,
  CAST(CASE WHEN OPEN_STORE IS NULL THEN {YEAR_WHEN_NULL}
            ELSE greatest(year(OPEN_STORE), {YEAR_FLOOR}) END AS INTEGER) AS year_open_store2
FROM fx_store""", ("fx_store",))

cte("chk_to_date_mask", f"""
SELECT code, date_daily, target_sales_nett,
  CASE WHEN date_daily >= {_d(AS_OF)} THEN NULL ELSE target_sales_nett END AS ytd_target_sales
FROM fx_targets""", ("fx_targets",))

cte("chk_menu_cutover", f"""
SELECT Date, Code, Product, QTY FROM fx_productmix WHERE Date <= {_d(MENU_UNTIL)}""",
    ("fx_productmix",))

cte("chk_product_key_join_modern", f"""
SELECT p."Sales Date" AS Date, p.Branch, p."Menu Name", p.Qty, k.product_cleaned, k.category, k.product_cleaned_2
FROM fx_menu_report p LEFT JOIN fx_lookup_modern k ON {_key('p."Menu Name"')} = {_key('k.product')}""",
    ("fx_menu_report", "fx_lookup_modern"))

# raw report strings (same dirt as fixtures.raw_sales_report)


def _p2(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 2, '0')"


cte("fx_raw_sales", f"""
SELECT CAST(l_linenumber AS VARCHAR) AS "No",
  CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN '  '
       ELSE CAST(l_orderkey AS VARCHAR) END AS "Bill Number",
  CASE WHEN l_orderkey % 13 = 0 THEN 'n/a'
       WHEN l_orderkey % 13 = 1 THEN strftime(CAST(l_shipdate AS DATE), '%m/%d/%Y')
       ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS "Sales Date",
  CASE WHEN l_orderkey % 17 = 0 THEN '25:61:00'
       ELSE CAST(l_linenumber + 8 AS VARCHAR) || ':' || {_p2('l_partkey % 60')} || ':' || {_p2('l_suppkey % 60')}
  END AS "Sales In Time",
  CASE WHEN l_orderkey % 19 = 0 THEN '26:00:00'
       WHEN l_orderkey % 19 = 1 THEN '-00:00:30'
       WHEN l_orderkey % 19 = 2 THEN '1 days 02:03:04'
       WHEN l_orderkey % 19 = 3 THEN 'soon'
       WHEN l_orderkey % 19 = 4 THEN '00:00:0' || CAST(l_linenumber AS VARCHAR) || '.5'
       ELSE '00:' || {_p2('l_partkey % 60')} || ':' || {_p2('l_linenumber')} END AS "Kitchen Process",
  CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS "Net Sales",
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS "Pax Total",
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' ' || {_p2('l_linenumber + 8')} || ':' || {_p2('l_partkey % 60')} || ':00' AS "Sales Date In",
  CAST(l_suppkey AS VARCHAR) AS Branch
FROM lineitem""")

_NOT_BLANK = f"""("Bill Number" IS NOT NULL AND regexp_replace("Bill Number",
  '^{UNICODE_SPACE_CLASS}+|{UNICODE_SPACE_CLASS}+$', '', 'g') <> '')"""

cte("chk_drop_blank_key", f'SELECT * FROM fx_raw_sales WHERE {_NOT_BLANK}', ("fx_raw_sales",))


def _num(c: str) -> str:
    return f"""CASE WHEN isnan(TRY_CAST(NULLIF("{c}", '') AS DOUBLE)) THEN NULL
  ELSE CAST(NULLIF("{c}", '') AS DOUBLE) END"""


def _date_sql(x: str) -> str:
    fmts = ["%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y", "%d-%b-%Y", "%Y/%m/%d"]
    tries = ", ".join(f"try_strptime(trim({x}), '{f}')" for f in fmts)
    return f"CAST(COALESCE(TRY_CAST(trim({x}) AS TIMESTAMP), {tries}) AS DATE)"


def _date(c: str) -> str:
    return _date_sql(f'"{c}"')


def _time(c: str) -> str:
    return f"strftime(try_strptime(trim(\"{c}\"), '%H:%M:%S'), '%H:%M:%S')"


_DUR = (r"^\s*([+-])?\s*(?:(\d+)\s*days?\s*,?\s*)?"
        r"(?:\+?(\d+):(\d+):(\d+)(?:\.(\d{1,9}))?)?\s*$")
_BARE = r"^\s*([+-]?\d+)\s*$"
_NS_DAY = 86_400_000_000_000


def _duration(c: str) -> str:
    x = f'"{c}"'

    def g(i: int) -> str:
        return f"regexp_extract({x}, '{_DUR}', {i})"

    days = f"CAST({g(2)} AS BIGINT) * {_NS_DAY}"
    clock = (f"(CAST({g(3)} AS BIGINT) * 3600000000000 + CAST({g(4)} AS BIGINT) * 60000000000"
             f" + CAST({g(5)} AS BIGINT) * 1000000000 + CAST(rpad({g(6)}, 9, '0') AS BIGINT))")
    sign = f"(CASE WHEN {g(1)} = '-' THEN -1 ELSE 1 END)"
    ns = f"""(CASE WHEN regexp_matches({x}, '{_DUR}') AND {g(2)} <> '' THEN
    {sign} * {days} + (CASE WHEN {g(3)} <> '' THEN {clock} ELSE 0 END)
  WHEN regexp_matches({x}, '{_DUR}') AND {g(3)} <> '' THEN {sign} * {clock}
  WHEN regexp_matches({x}, '{_BARE}') THEN CAST(regexp_extract({x}, '{_BARE}', 1) AS BIGINT)
  END)"""
    tod = f"((({ns}) % {_NS_DAY}) + {_NS_DAY}) % {_NS_DAY}"
    secs = f"(({tod}) // 1000000000)"
    sub = f"(({tod}) % 1000000000)"
    return f"""CASE WHEN {ns} IS NULL THEN NULL ELSE
  (CASE WHEN {ns} < 0 THEN '+' ELSE '' END)
  || {_p2(f'{secs} // 3600')} || ':' || {_p2(f'({secs} // 60) % 60')} || ':' || {_p2(f'{secs} % 60')}
  || (CASE WHEN {sub} = 0 THEN '' WHEN {sub} % 1000 = 0 THEN '.' || lpad(CAST({sub} // 1000 AS VARCHAR), 6, '0')
           ELSE '.' || lpad(CAST({sub} AS VARCHAR), 9, '0') END) END"""


cte("chk_typed_numeric", f"""
SELECT "No", "Bill Number", {_num('Net Sales')} AS "Net Sales", {_num('Pax Total')} AS "Pax Total"
FROM fx_raw_sales""", ("fx_raw_sales",))
cte("chk_typed_date", f'SELECT "No", "Bill Number", {_date("Sales Date")} AS "Sales Date" FROM fx_raw_sales',
    ("fx_raw_sales",))
cte("chk_typed_time", f'SELECT "No", "Bill Number", {_time("Sales In Time")} AS "Sales In Time" FROM fx_raw_sales',
    ("fx_raw_sales",))
cte("chk_typed_timestamp", """
SELECT "No", "Bill Number", TRY_CAST("Sales Date In" AS TIMESTAMP) AS "Sales Date In" FROM fx_raw_sales""",
    ("fx_raw_sales",))
cte("chk_clean_duration", f"""
SELECT "No", "Bill Number", "Kitchen Process" AS raw_duration, {_duration('Kitchen Process')} AS "Kitchen Process"
FROM fx_raw_sales""", ("fx_raw_sales",))

cte("chk_typed_report", f"""
SELECT "No", "Bill Number", {_date("Sales Date")} AS "Sales Date", {_time("Sales In Time")} AS "Sales In Time",
  {_duration('Kitchen Process')} AS "Kitchen Process", {_num('Net Sales')} AS "Net Sales",
  {_num('Pax Total')} AS "Pax Total", TRY_CAST("Sales Date In" AS TIMESTAMP) AS "Sales Date In", Branch
FROM fx_raw_sales WHERE {_NOT_BLANK}""", ("fx_raw_sales",))

_REPORT_COLS = ["No", "Bill Number", "Sales Date", "Sales In Time", "Kitchen Process", "Net Sales",
                "Pax Total", "Sales Date In", "Branch"]
cte("chk_null_profile", "SELECT COUNT(*) AS rows, " + ", ".join(
    f'COUNT(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in _REPORT_COLS) + " FROM chk_typed_report",
    ("chk_typed_report",))

cte("chk_stack_files", 'SELECT "No", Branch, "Note", X1, X45 FROM fx_sales_export', ("fx_sales_export",))

cte("chk_unmatched_branches", """
SELECT b.Branch AS key, COUNT(*) AS n_rows
FROM fx_bills b WHERE NOT EXISTS (SELECT 1 FROM fx_store s WHERE s.CODE_GIS = b.Branch)
GROUP BY b.Branch""", ("fx_bills", "fx_store"))

cte("chk_duplicate_store_keys", """
SELECT STORE, COUNT(*) AS count FROM (
  SELECT STORE FROM fx_store UNION ALL SELECT STORE FROM fx_store WHERE CAST(replace(CODE_GIS, 'X', '') AS INTEGER) % 7 = 0) x
GROUP BY 1 HAVING COUNT(*) > 1""", ("fx_store",))

# full Sales export derived from lineitem, typed as the ingest types it
_P = "CAST(l_extendedprice AS DECIMAL(18,2))"
_DI = "CAST(l_discount AS DECIMAL(4,2))"
_TX = "CAST(l_tax AS DECIMAL(4,2))"
_ONE = "CAST(1 AS DECIMAL(4,2))"
_NETX = f"({_P} * ({_ONE} - {_DI}))"


def _m(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS DOUBLE)"


_DATE_TXT = """CASE WHEN l_orderkey % 13 = 0 THEN 'n/a'
       WHEN l_orderkey % 13 = 1 THEN strftime(CAST(l_shipdate AS DATE), '%m/%d/%Y')
       ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END"""

_FILLERS = ", ".join(f"CASE WHEN l_suppkey % 2 = 0 THEN CAST((l_orderkey + {i}) % 10 AS VARCHAR) END AS X{i}"
                     for i in range(1, 46))

cte("fx_sales_export", f"""
SELECT CAST(l_linenumber AS VARCHAR) AS "No",
  CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN '  '
       ELSE CAST(l_orderkey AS VARCHAR) END AS "Bill Number",
  {_DATE_TXT} AS "Sales Date", {_DATE_TXT} AS "Sales In Date",
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "Sales Out Date",
  CASE WHEN l_orderkey % 17 = 0 THEN '25:61:00'
       ELSE CAST(l_linenumber + 8 AS VARCHAR) || ':' || {_p2('l_partkey % 60')} || ':' || {_p2('l_suppkey % 60')}
  END AS "Sales In Time",
  CAST(l_linenumber + 9 AS VARCHAR) || ':' || {_p2('l_partkey % 60')} || ':00' AS "Sales Out Time",
  CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS "Pax Total",
  {_m(_P)} AS "Subtotal", {_m(f"{_P} * {_DI}")} AS "Menu Discount",
  0.0::DOUBLE AS "Bill Discount", 0.0::DOUBLE AS "Voucher Discount",
  CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE {_m(_NETX)} END AS "Net Sales",
  0.0::DOUBLE AS "Service Charge Total", {_m(f"{_NETX} * {_TX}")} AS "Tax Total",
  0.0::DOUBLE AS "VAT Total", 0.0::DOUBLE AS "Delivery Cost", 0.0::DOUBLE AS "Order Fee",
  0.0::DOUBLE AS "Platform Fee", 0.0::DOUBLE AS "Voucher Sales Total", 0.0::DOUBLE AS "Rounding Total",
  {_m(f"{_NETX} * ({_ONE} + {_TX})")} AS "Grand Total",
  CAST(l_suppkey AS VARCHAR) AS Branch,
  'say "hot, red" ' || CAST(l_partkey % 7 AS VARCHAR) || chr(10) || ' end' AS "Note",
  'b' || CAST(l_linenumber AS VARCHAR) AS "Unnamed: 24",
  CAST(l_partkey % 5 AS VARCHAR) AS note_1,
  {_FILLERS},
  row_number() OVER (PARTITION BY l_suppkey, l_orderkey % 2 ORDER BY l_orderkey, l_linenumber,
    l_partkey, l_shipdate, l_extendedprice, l_discount) AS pos
FROM lineitem""")

cte("chk_read_report", f"""
SELECT "No", "Bill Number", {_date("Sales Date")} AS "Sales Date", {_date("Sales In Date")} AS "Sales In Date",
  {_date("Sales Out Date")} AS "Sales Out Date", {_time("Sales In Time")} AS "Sales In Time",
  {_time("Sales Out Time")} AS "Sales Out Time",
  "Pax Total", "Subtotal", "Menu Discount", "Bill Discount", "Voucher Discount", "Net Sales",
  "Service Charge Total", "Tax Total", "VAT Total", "Delivery Cost", "Order Fee", "Platform Fee",
  "Voucher Sales Total", "Rounding Total", "Grand Total", Branch,
  "Note", "Unnamed: 24", note_1, {", ".join(f"X{i}" for i in range(1, 46))}
FROM fx_sales_export WHERE {_NOT_BLANK}""", ("fx_sales_export",))

cte("chk_preview", f"""
SELECT "No", "Bill Number", "Sales Date", "Net Sales", Branch, "Note", CAST(nth AS INTEGER) AS row_in_file
FROM (SELECT "No", "Bill Number", {_date("Sales Date")} AS "Sales Date", "Net Sales", Branch, "Note",
        row_number() OVER (PARTITION BY Branch, CAST("Bill Number" AS BIGINT) % 2 ORDER BY pos) AS nth
      FROM fx_sales_export WHERE {_NOT_BLANK}) x
WHERE nth <= 5""", ("fx_sales_export",))

cte("chk_append_write", """
SELECT "No", "Bill Number", "Net Sales" FROM fx_raw_sales
UNION ALL SELECT "No", "Bill Number", NULL::VARCHAR FROM fx_raw_sales""", ("fx_raw_sales",))
cte("chk_overwrite_write", 'SELECT "No", "Bill Number", "Pax Total" FROM fx_raw_sales', ("fx_raw_sales",))
cte("chk_publish_replace", 'SELECT "Bill Number", "Net Sales" FROM fx_raw_sales', ("fx_raw_sales",))

_PUBLISHED = ("combined", "daily1", "daily2", "daily3", "monthly1", "monthly2", "monthly3",
              "sales_90days", "sales_nso", "tracker", "combined_menu", "prodmix1", "prodmix2")
_AMOUNT = {"sales_nso": "sales_nett", "tracker": "actual_sales_nett", "combined_menu": "Qty",
           "prodmix1": "Qty", "prodmix2": "Qty"}
cte("chk_published_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, "
    f"CAST(SUM(CAST({_AMOUNT.get(t, 'total_sales_net')} AS DECIMAL(38,6))) AS DOUBLE) AS amount FROM {t}"
    for t in _PUBLISHED), _PUBLISHED)

cte("chk_lag_tiebreak", f"""
SELECT Date, RESTO, Order_Type, total_tc, LAG(total_tc) OVER w AS previous_tc
FROM (SELECT Date, RESTO, Order_Type, total_tc, total_sales_net FROM combined UNION ALL
      SELECT Date, RESTO, Order_Type, total_tc + 1, total_sales_net FROM combined) x
WINDOW w AS (PARTITION BY RESTO, Order_Type ORDER BY {_lagorder('Date', ['total_sales_net', 'total_tc'])})""",
    ("combined",))

cte("chk_read_menu_report", f"""
SELECT CAST(l_linenumber AS VARCHAR) AS "No",
  {_date_sql("CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END")} AS "Sales Date",
  CAST(l_suppkey AS VARCHAR) AS Branch, 'MENU ' || CAST(l_partkey % 97 AS VARCHAR) AS "Menu Name",
  CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS Qty, {_m(_P)} AS Subtotal,
  0.0::DOUBLE AS "Service Charge", {_m(f"{_P} * {_TX}")} AS "Tax Total", 0.0::DOUBLE AS "VAT Total",
  CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE {_m(f"{_P} + {_P} * {_TX}")} END AS Total
FROM lineitem""")

_KITCHEN = f"""CASE WHEN l_orderkey % 19 = 0 THEN '26:00:00' WHEN l_orderkey % 19 = 1 THEN '-00:00:30'
  WHEN l_orderkey % 19 = 2 THEN '1 days 02:03:04' WHEN l_orderkey % 19 = 3 THEN 'soon'
  ELSE '00:' || {_p2('l_partkey % 60')} || ':' || {_p2('l_linenumber')} END"""

cte("fx_service_export", f"""
SELECT CAST(l_linenumber AS VARCHAR) AS "No", CAST(l_orderkey AS VARCHAR) AS "Bill Number",
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' ' || {_p2('l_linenumber + 8')} || ':' || {_p2('l_partkey % 60')} || ':00' AS "Sales Date In",
  {_KITCHEN} AS "Kitchen Process",
  '00:00:' || {_p2('l_partkey % 60')} || '.25' AS "Checker Process",
  '00:' || {_p2('l_partkey % 60')} || ':' || {_p2('l_linenumber + 10')} AS "Total Process",
  CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS "Kitchen Qty",
  CAST(l_linenumber AS DOUBLE) AS "Checker Qty", CAST(l_suppkey AS VARCHAR) AS Branch
FROM lineitem""")

cte("chk_read_service_report", f"""
SELECT "No", "Bill Number", TRY_CAST("Sales Date In" AS TIMESTAMP) AS "Sales Date In",
  {_duration('Kitchen Process')} AS "Kitchen Process", {_duration('Checker Process')} AS "Checker Process",
  {_duration('Total Process')} AS "Total Process", "Kitchen Qty", "Checker Qty", Branch
FROM fx_service_export""", ("fx_service_export",))

# --- mechanisms for scale -------------------------------------------------------------

cte("chk_skew_join", f"""
SELECT Date, RESTO, Order_Type, COUNT(DISTINCT bill) AS total_tc, CAST(SUM(net) AS {NET}) AS total_sales_net
FROM (SELECT CAST(l_shipdate AS DATE) AS Date, s.NEW_CODE_STORE AS RESTO,
        {_map(_label("(l_orderkey + l_linenumber)", fx.VISIT_PURPOSES), VISIT_CHANNELS, UNKNOWN)} AS Order_Type,
        CAST(l_orderkey AS VARCHAR) AS bill, {_money4("l_extendedprice", "l_orderkey")} AS net
      FROM lineitem LEFT JOIN fx_store s ON s.CODE_GIS =
        CASE WHEN l_orderkey % 3 = 0 THEN '1' WHEN l_orderkey % 10 = 1 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END) x
GROUP BY 1, 2, 3""", ("fx_store",))

cte("chk_previous_by_ranges", f"""
SELECT Date, RESTO, Order_Type, total_tc, LAG(total_tc) OVER w AS previous_tc,
  LAG(total_sales_net) OVER w AS previous_sales_net
FROM (SELECT Date, CASE WHEN total_tc % 2 = 0 THEN RESTO END AS RESTO, Order_Type, total_tc, total_sales_net
      FROM combined) x
WINDOW w AS (PARTITION BY RESTO, Order_Type ORDER BY {_lagorder('Date', ['total_sales_net', 'total_tc'])})""",
    ("combined",))

# Three lines stand above an export's first row; no cell of it holds a line break.
_FILE = "PARTITION BY l_suppkey, l_orderkey % 2"
_FILE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_discount"
cte("chk_bad_cells", f"""
SELECT branch, part, line, "column", "value", n_in_file FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY branch, part) AS n_in_file
  FROM (
    SELECT branch, part, line, 'Qty' AS "column", 'x' || CAST(l_linenumber AS VARCHAR) AS "value"
    FROM numbered WHERE l_orderkey % 31 = 0
    UNION ALL
    SELECT branch, part, line, 'Tax Total', '1,5 "n.a."' FROM numbered WHERE l_orderkey % 37 = 0) cells) x""", ("numbered",))
cte("numbered", f"""
SELECT l_suppkey AS branch, l_orderkey % 2 AS part, l_orderkey, l_linenumber,
  3 + row_number() OVER ({_FILE} ORDER BY {_FILE_ORDER}) AS line
FROM lineitem""")

cte("chk_batch_shape", "SELECT COUNT(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns, CAST(SUM(m) AS BIGINT) AS n_missing, "
    "MAX(m) > 0 AS has_missing FROM (SELECT "
    + " + ".join(f'CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END' for c in _REPORT_COLS)
    + " AS m FROM chk_typed_report) x", ("chk_typed_report",))

_STYLE = """CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 3 ELSE l_suppkey % 3 END"""
cte("chk_column_dates", f"""
SELECT "No", Branch, "Menu Name", CASE WHEN style = layout THEN day END AS "Sales Date", Total FROM (
  SELECT CAST(l_linenumber AS VARCHAR) AS "No", CAST(l_suppkey AS VARCHAR) AS Branch,
    'MENU ' || CAST(l_partkey % 97 AS VARCHAR) AS "Menu Name", CAST(l_shipdate AS DATE) AS day, {_STYLE} AS style,
    first_value({_STYLE} IGNORE NULLS) OVER ({_FILE} ORDER BY {_FILE_ORDER}
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS layout,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE {_m(f"{_P} + {_P} * {_TX}")} END AS Total
  FROM lineitem) x""")

cte("chk_unit_durations", f"""
SELECT l_orderkey, l_linenumber, raw_duration,
  CASE WHEN ms IS NULL THEN NULL ELSE CASE WHEN ms < 0 THEN '+' ELSE '' END
    || {_p2("tod // 3600000")} || ':' || {_p2("tod // 60000 % 60")} || ':' || {_p2("tod // 1000 % 60")}
    || CASE WHEN tod % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(tod % 1000 AS VARCHAR), 3, '0') || '000' END END AS clock,
  CAST(ms AS DOUBLE) / 1000 AS seconds
FROM (SELECT *, ((ms % 86400000) + 86400000) % 86400000 AS tod FROM (
  SELECT l_orderkey, l_linenumber,
    CASE l_orderkey % 9 WHEN 0 THEN n || ' min' WHEN 1 THEN ln || 'h' || n || 'm' WHEN 2 THEN n || '.5 hours'
      WHEN 3 THEN 'PT' || n || 'M' || ln || 'S' WHEN 4 THEN '-' || n || ' Seconds' WHEN 5 THEN ln || ' days, ' || n || ' ms'
      WHEN 6 THEN n || ' M' WHEN 7 THEN 'P1DT' || ln || 'H' ELSE n || ' blinks' END AS raw_duration,
    CAST(CASE l_orderkey % 9 WHEN 0 THEN m * 60000 WHEN 1 THEN l_linenumber * 3600000 + m * 60000
      WHEN 2 THEN m * 3600000 + 1800000 WHEN 3 THEN m * 60000 + l_linenumber * 1000 WHEN 4 THEN -m * 1000
      WHEN 5 THEN l_linenumber * 86400000 + m WHEN 7 THEN 86400000 + l_linenumber * 3600000 END AS BIGINT) AS ms
  FROM (SELECT l_orderkey, l_linenumber, l_partkey % 90 AS m, CAST(l_partkey % 90 AS VARCHAR) AS n,
          CAST(l_linenumber AS VARCHAR) AS ln FROM lineitem)))""")
