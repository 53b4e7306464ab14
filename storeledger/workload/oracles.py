"""The registered queries in SQL, over the same tables, whole."""

from __future__ import annotations

from storeledger.config import STANDARD_COLUMNS
from storeledger.functions.months import months_back
from storeledger.workload.star import CONFIG, FEE_MONTH

MONTHS = months_back("2001-08", 80)  # every month with orders, 1995-01 to 2001-08
SKU_MONTHS = [m for m in MONTHS if m != FEE_MONTH]
R = CONFIG.report_month
W3, W6 = (", ".join(f"'{m}'" for m in months_back(R, n)) for n in (3, 6))


def norm(text: str) -> str:
    upper = f"upper(replace(coalesce({text}, ''), 'ß', 'SS'))"
    return f"trim(regexp_replace({upper}, '[^A-Z0-9]+', ' ', 'g'))"


def numbers(key: str) -> str:
    return (
        f"list_filter(string_split({key}, ' '), lambda w: regexp_full_match(w, '[0-9]{{3,5}}')"
        " AND CAST(CASE WHEN regexp_full_match(w, '[0-9]{3,5}') THEN w ELSE '0' END AS INTEGER)"
        " < 10000 AND CAST(CASE WHEN regexp_full_match(w, '[0-9]{3,5}') THEN w ELSE '0' END"
        " AS INTEGER) NOT BETWEEN 1900 AND 2030)"
    )


def group_of(sku: str) -> tuple[str, str]:
    key = norm(sku)
    groups = (
        f"CASE WHEN {key} IN ('WIDGETS', 'RED WIDGET', 'BLUE WIDGET', 'OLD WIDGET', 'NEW WIDGET')"
        " THEN 'WIDGETS'"
        f" WHEN {key} IN ('HOT GOODS', 'HOT ANVIL', 'HOT BOLT', 'HOT GEAR') THEN 'HOT GOODS'"
        f" ELSE {key} END"
    )
    shown = (
        f"CASE {groups} WHEN 'WIDGETS' THEN 'red widget' WHEN 'HOT GOODS' THEN 'hot anvil'"
        f" WHEN 'COLD ROD' THEN 'Cold rod' ELSE {groups} END"
    )
    return groups, shown


GROUP, SHOWN = group_of("vendor_item")


def rounded(value: str, digits: int) -> str:
    return f"round_even(({value}) * {10.0 ** digits}, 0) / {10.0 ** digits}"


def clean(raw: str) -> str:
    """Digits of a numeric id, else the trimmed text."""
    return (
        f"CASE WHEN regexp_full_match(trim({raw}), '[0-9]+(\\.[0-9]*)?')"
        f" THEN regexp_replace(regexp_replace(trim({raw}), '\\.0*$', ''), '^0+([0-9])', '\\1')"
        f" ELSE nullif(trim({raw}), '') END"
    )


# --- Shared derivations -------------------------------------------------------

BASE = f"""
buyers AS (
  SELECT c.*, n_name, r_name,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'chain_a' WHEN 'BUILDING' THEN 'chain_b' END AS chain,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'LPQ' ELSE 'JTJ' END AS brand,
    CAST(100 + c_custkey % 9900 AS VARCHAR) AS street_no,
    c_custkey || ' ' || n_name || ' Street' AS street
  FROM customer c JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
line AS (
  SELECT *,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2))) AS amount,
    CAST(CASE WHEN CAST(l_tax AS DECIMAL(4,2)) = 0.08 THEN -l_quantity ELSE l_quantity END
      AS DECIMAL(12,2)) AS units,
    CASE l_returnflag WHEN 'R' THEN '2' WHEN 'A' THEN '1.0' ELSE '1' END AS record_type,
    strftime(o_orderdate, '%m/%d/%y') AS invoice_text,
    CASE WHEN strftime(o_orderdate, '%Y-%m') <> '{FEE_MONTH}' THEN p_name END AS sku
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN buyers ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
tagged AS (
  SELECT 'distributor' AS source, * FROM line
  UNION ALL SELECT chain, * FROM line WHERE chain IS NOT NULL),
std AS (
  SELECT source, sku AS vendor_item, sku || ' ' || p_type AS item_description,
    c_name AS location_code,
    CASE WHEN source <> 'distributor' THEN brand || ' ' || street_no || ' ' || n_name
         WHEN r_name = 'MIDDLE EAST' THEN c_name || ' Annex' ELSE c_name END AS customer_name,
    CASE WHEN o_orderpriority = '5-LOW' THEN street ELSE street || ', ' || r_name END AS address,
    n_name AS city, CASE WHEN r_name <> 'ASIA' THEN r_name END AS state,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
    CAST(try_strptime(invoice_text, '%m/%d/%y') AS DATE) AS invoice_date,
    CAST(o_orderkey AS VARCHAR) AS invoice_num,
    strftime(try_strptime(invoice_text, '%m/%d/%y'), '%Y-%m') AS yyyymm,
    units AS qty,
    CASE WHEN l_linenumber IN (6, 7) THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END
      AS unit_price,
    amount AS total
  FROM tagged WHERE TRY_CAST(record_type AS DOUBLE) = 1),
codes AS (SELECT DISTINCT location_code FROM std WHERE source <> 'distributor'),
sales AS (
  SELECT * FROM std
  WHERE source <> 'distributor' OR location_code NOT IN (SELECT location_code FROM codes))"""

CRM = f"""
export AS (
  SELECT c_custkey * 2 + copy AS ref_ord,
    CASE WHEN chain IS NOT NULL AND c_acctbal > 5000 THEN brand || ' Bakery ' || street_no
         WHEN chain IS NOT NULL THEN brand || ' Bakery ' || n_name
         WHEN r_name = 'AFRICA' THEN replace(c_name, '#', ' - ')
         WHEN r_name = 'ASIA' THEN 'The ' || c_name || ' Store'
         WHEN r_name = 'MIDDLE EAST' THEN c_name
         ELSE 'Account ' || c_custkey END AS crm_customer_name,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN c_custkey || '.0'
         WHEN c_mktsegment = 'HOUSEHOLD' AND r_name = 'AFRICA'
           THEN CAST(7000000000 + c_nationkey AS VARCHAR)
         WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 8000 THEN 'pending'
         ELSE CAST(c_custkey AS VARCHAR) END AS raw_id,
    CASE WHEN chain IS NULL AND r_name = 'AMERICA' THEN lower(c_name) END AS crm_location_name,
    CASE WHEN copy = 0 THEN 'PO Box ' || c_custkey
         WHEN chain IS NOT NULL AND c_acctbal > 5000 THEN 'Main Road'
         WHEN chain IS NOT NULL THEN street_no || ' Market Ave'
         ELSE street || '; ' || r_name END AS crm_address,
    n_name AS crm_city
  FROM (SELECT *, 1 AS copy FROM buyers WHERE c_acctbal >= 0
        UNION ALL SELECT *, 0 FROM buyers WHERE c_acctbal > 9000)),
crm AS (
  SELECT ref_ord, crm_customer_name,
    CASE WHEN regexp_full_match(raw_id, '[0-9]+(\\.[0-9]*)?')
         THEN regexp_replace(raw_id, '\\.0*$', '') END AS crm_customer_id,
    crm_location_name, crm_address, crm_city,
    {norm("crm_customer_name")} AS norm_name, {norm("crm_address")} AS norm_addr,
    {norm("crm_location_name")} AS norm_loc
  FROM export)"""


def mode_of(field: str) -> str:
    return f"""
m_{field} AS (
  SELECT location_code, {field} FROM (
    SELECT location_code, {field},
      row_number() OVER (PARTITION BY location_code ORDER BY count(*) DESC, {field}) AS rn
    FROM sales WHERE {field} IS NOT NULL GROUP BY location_code, {field})
  WHERE rn = 1)"""


PLACE = ("customer_name", "address", "city", "state", "zip")

REFS = f"""{",".join(map(mode_of, PLACE))},
locref AS (
  SELECT l.location_code, l.chain, {", ".join(f"coalesce(m_{f}.{f}, '') AS {f}" for f in PLACE)}
  FROM (SELECT location_code,
          CASE min(CASE source WHEN 'distributor' THEN 1 WHEN 'chain_a' THEN 2 ELSE 3 END)
            WHEN 1 THEN 'distributor' WHEN 2 THEN 'chain_a' ELSE 'chain_b' END AS chain
        FROM sales GROUP BY location_code) l
  {" ".join(f"LEFT JOIN m_{f} USING (location_code)" for f in PLACE)}),
keyed AS (
  SELECT *, {norm("customer_name")} AS norm_name, {norm("address")} AS norm_addr FROM locref)"""

# Each rule compares every location with every CRM row it could match.
RULES = f"""
r1 AS (
  SELECT location_code, arg_min(ref_ord, (CASE WHEN c.norm_addr = k.norm_addr THEN 0 ELSE 1 END)
    * 100000000000 + ref_ord) AS hit
  FROM keyed k JOIN crm c ON c.norm_name = k.norm_name WHERE k.norm_name <> ''
  GROUP BY location_code),
r2 AS (
  SELECT location_code, min(ref_ord) AS hit
  FROM keyed k JOIN crm c ON c.norm_loc = k.norm_name WHERE k.norm_name <> ''
  GROUP BY location_code),
r3 AS (
  SELECT location_code, min(ref_ord) AS hit
  FROM keyed k JOIN crm c
    ON contains(c.norm_name, k.norm_name) OR contains(c.norm_loc, k.norm_name)
  WHERE length(k.norm_name) >= 6 GROUP BY location_code HAVING count(*) = 1),
r4 AS (
  SELECT location_code, min(ref_ord) AS hit
  FROM keyed k JOIN crm c ON contains(k.norm_name, c.norm_name)
  WHERE length(k.norm_name) >= 6 AND length(c.norm_name) >= 6
  GROUP BY location_code HAVING count(*) = 1),
r5 AS (
  SELECT location_code, min(ref_ord) AS hit
  FROM keyed k JOIN crm c ON c.norm_addr = k.norm_addr
  WHERE k.norm_name <> '' AND length(k.norm_addr) >= 8
  GROUP BY location_code HAVING count(*) = 1),
wanted AS (
  SELECT location_code, chain, nums[pos] AS num, pos
  FROM (SELECT location_code, chain, {numbers("norm_name")} AS nums FROM keyed
        WHERE chain IN ('chain_a', 'chain_b')),
       LATERAL (SELECT unnest(range(1, len(nums) + 1)) AS pos)),
chain_crm AS (
  SELECT 'chain_a' AS chain, * FROM crm WHERE regexp_matches(norm_name, 'PAIN|QUOTID|LPQ')
  UNION ALL
  SELECT 'chain_b', * FROM crm WHERE regexp_matches(norm_name, 'JOE|JUICE|JTJ')),
tried AS (
  SELECT location_code, pos,
    count(*) FILTER (list_contains(string_split(norm_addr, ' '), num)) AS addr_hits,
    min(ref_ord) FILTER (list_contains(string_split(norm_addr, ' '), num)) AS addr_hit,
    count(*) FILTER (list_contains(string_split(norm_name, ' '), num)) AS name_hits,
    min(ref_ord) FILTER (list_contains(string_split(norm_name, ' '), num)) AS name_hit
  FROM wanted JOIN chain_crm USING (chain) GROUP BY location_code, pos),
r6 AS (
  SELECT location_code, arg_min(hit, pos) AS hit
  FROM (SELECT location_code, pos, CASE WHEN addr_hits = 1 THEN addr_hit
          WHEN addr_hits = 0 AND name_hits = 1 THEN name_hit END AS hit FROM tried)
  WHERE hit IS NOT NULL GROUP BY location_code),
locmap AS (
  SELECT k.location_code, k.chain, k.customer_name, k.address, k.city, k.state, k.zip,
    coalesce(c.crm_customer_id, '') AS crm_customer_id,
    coalesce(c.crm_customer_name, '') AS crm_customer_name
  FROM keyed k
  LEFT JOIN r1 USING (location_code) LEFT JOIN r2 USING (location_code)
  LEFT JOIN r3 USING (location_code) LEFT JOIN r4 USING (location_code)
  LEFT JOIN r5 USING (location_code) LEFT JOIN r6 USING (location_code)
  LEFT JOIN crm c ON c.ref_ord
    = coalesce(r1.hit, r2.hit, r3.hit, r4.hit, r5.hit, r6.hit))"""

METRICS = f"""
descr AS (
  SELECT vendor_item, item_description FROM (
    SELECT vendor_item, item_description, row_number() OVER (
      PARTITION BY vendor_item ORDER BY length(item_description) DESC, item_description) AS rn
    FROM (SELECT DISTINCT vendor_item, item_description FROM sales WHERE vendor_item IS NOT NULL))
  WHERE rn = 1),
active AS (
  SELECT greatest(count(DISTINCT CASE WHEN yyyymm IN ({W3}) THEN yyyymm END), 1) AS n3,
         greatest(count(DISTINCT CASE WHEN yyyymm IN ({W6}) THEN yyyymm END), 1) AS n6
  FROM sales),
rolling AS (
  SELECT location_code,
    CAST(coalesce(sum(total) FILTER (yyyymm = '{R}'), 0) AS DOUBLE) AS last_month_total,
    CAST(coalesce(sum(total) FILTER (yyyymm IN ({W3})), 0) AS DOUBLE) / any_value(n3)
      AS avg_monthly_3m,
    CAST(coalesce(sum(total) FILTER (yyyymm IN ({W6})), 0) AS DOUBLE) / any_value(n6)
      AS avg_monthly_6m
  FROM sales, active GROUP BY location_code),
tiers AS (
  SELECT *, CASE WHEN avg_monthly_3m >= 50000 THEN 'Tier 1' WHEN avg_monthly_3m >= 25000
    THEN 'Tier 2' WHEN avg_monthly_3m >= 10000 THEN 'Tier 3' ELSE 'Tier 4' END AS sla_tier
  FROM rolling),
skuqty AS (
  SELECT location_code, vendor_item,
    CAST(sum(qty) FILTER (yyyymm IN ({W3})) AS DOUBLE) AS qty_3m_total,
    CAST(coalesce(sum(qty) FILTER (yyyymm = '{R}'), 0) AS DOUBLE) AS last_month_qty,
    CAST(sum(qty) FILTER (yyyymm IN ({W3})) AS DOUBLE) / any_value(n3) AS avg_qty_3m,
    CAST(sum(qty) FILTER (yyyymm IN ({W6})) AS DOUBLE) / any_value(n6) AS avg_qty_6m
  FROM sales, active GROUP BY location_code, vendor_item
  HAVING count(*) FILTER (yyyymm IN ({W3})) > 0),
groupqty AS (
  SELECT location_code, {GROUP} AS sku_group, {SHOWN} AS sku_display,
    CAST(sum(qty) AS DOUBLE) AS qty_3m
  FROM sales WHERE yyyymm IN ({W3}) GROUP BY ALL),
popular AS (
  SELECT location_code, sku_display AS most_popular_sku FROM (
    SELECT *, row_number() OVER (PARTITION BY location_code ORDER BY qty_3m DESC, sku_group) AS rn
    FROM groupqty) WHERE rn = 1)"""

VISITS = (
    "CASE sla_tier WHEN 'Tier 1' THEN 'Monthly' WHEN 'Tier 2' THEN 'Bi-Monthly'"
    " WHEN 'Tier 3' THEN 'Quarterly' ELSE 'Annually' END"
)

REPORTS = f"""
snapshot AS (
  SELECT t.location_code, customer_name, chain, crm_customer_id, crm_customer_name,
    {rounded("last_month_total", 2)} AS last_month_total,
    {rounded("avg_monthly_3m", 2)} AS avg_monthly_3m,
    {rounded("avg_monthly_6m", 2)} AS avg_monthly_6m,
    sla_tier, {VISITS} AS visit_frequency, most_popular_sku, '{R}' AS report_month
  FROM tiers t LEFT JOIN popular USING (location_code) LEFT JOIN locmap USING (location_code)),
topskus AS (
  SELECT q.location_code, chain, crm_customer_id, vendor_item, item_description, last_month_qty,
    {rounded("avg_qty_3m", 1)} AS avg_qty_3m, {rounded("avg_qty_6m", 1)} AS avg_qty_6m,
    '{R}' AS report_month, CAST(sku_rank AS INTEGER) AS sku_rank
  FROM (SELECT *, row_number() OVER (PARTITION BY location_code
          ORDER BY qty_3m_total DESC, vendor_item) AS sku_rank FROM skuqty) q
  LEFT JOIN descr USING (vendor_item) LEFT JOIN locmap USING (location_code)
  WHERE sku_rank <= 10),
last3 AS (SELECT DISTINCT yyyymm FROM sales WHERE vendor_item IS NOT NULL ORDER BY yyyymm DESC LIMIT 3),
skusales AS (
  SELECT location_code, vendor_item,
    CAST(coalesce(sum(total) FILTER (yyyymm IN (SELECT yyyymm FROM last3)), 0) AS DOUBLE)
      / (SELECT count(*) FROM last3) AS avg_sales_3m
  FROM sales WHERE vendor_item IS NOT NULL GROUP BY location_code, vendor_item)"""

TARGETS = f"""
targets AS (
  SELECT c_custkey AS target_ord, {clean("raw_id")} AS crm_customer_id, target_id,
    customer_label, chain, nullif(trim(raw_location), '') AS location_code
  FROM (
    SELECT c_custkey, CAST(100000000 + c_custkey AS VARCHAR) AS target_id,
      c_name AS customer_label, coalesce(chain, 'distributor') AS chain,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN c_custkey || '.0'
           WHEN c_mktsegment = 'HOUSEHOLD' AND r_name = 'AFRICA'
             THEN CAST(7000000000 + c_nationkey AS VARCHAR)
           ELSE CAST(c_custkey AS VARCHAR) END AS raw_id,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN ' '
           WHEN c_mktsegment = 'HOUSEHOLD' AND r_name = 'AFRICA' THEN ''
           WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN 'CLOSED ' || c_name
           ELSE c_name END AS raw_location
    FROM buyers))"""

FORMS = """
resolved AS (
  SELECT t.*,
    CASE WHEN l.location_code IS NOT NULL THEN 'location'
         WHEN i.id IS NOT NULL THEN 'customer' END AS key_kind,
    CASE WHEN l.location_code IS NOT NULL THEN t.location_code
         WHEN i.id IS NOT NULL THEN t.crm_customer_id END AS key,
    CASE WHEN l.location_code IS NOT NULL THEN l.report_month ELSE i.report_month END
      AS report_month,
    CASE WHEN l.location_code IS NOT NULL THEN l.last_month_total ELSE i.last_month_total END
      AS last_month_total
  FROM targets t LEFT JOIN snapshot l ON l.location_code = t.location_code
  LEFT JOIN (SELECT crm_customer_id AS id, report_month, last_month_total FROM (
      SELECT *, row_number() OVER (PARTITION BY crm_customer_id ORDER BY location_code DESC) AS rn
      FROM snapshot WHERE crm_customer_id <> '') WHERE rn = 1) i ON i.id = t.crm_customer_id),
skurows AS (
  SELECT r.target_ord, r.target_id, r.location_code, r.key_kind, r.key, s.vendor_item,
    s.last_month_qty, s.avg_qty_3m,
    row_number() OVER (PARTITION BY r.target_ord ORDER BY s.location_code, s.sku_rank) AS position
  FROM resolved r JOIN topskus s
    ON (r.key_kind = 'location' AND s.location_code = r.key)
    OR (r.key_kind = 'customer' AND s.crm_customer_id = r.key)),
listed AS (
  SELECT s.* EXCLUDE (position), CAST(position AS INTEGER) AS position,
    coalesce(p.avg_sales_3m, 0.0) AS avg_sales_3m
  FROM skurows s LEFT JOIN skusales p
    ON p.location_code = s.location_code AND p.vendor_item = s.vendor_item
  WHERE position <= 10),
units AS (
  SELECT r.target_ord, r.target_id, r.key_kind, r.key, r.report_month, r.last_month_total,
    CAST(trunc(coalesce(sum(s.last_month_qty), 0)) AS BIGINT) AS total_units,
    count(s.vendor_item) AS sku_rows
  FROM resolved r LEFT JOIN skurows s USING (target_ord)
  WHERE r.key_kind IS NOT NULL GROUP BY ALL),
skuline AS (
  SELECT target_ord, target_id, position, vendor_item || ' | $' || format('{:,.2f}', avg_sales_3m)
    || ' | ' || CAST(CAST(round_even(avg_qty_3m, 0) AS BIGINT) AS VARCHAR) || ' units/mo' AS line
  FROM listed),
fields AS (
  SELECT target_ord, target_id, CAST(position AS INTEGER) AS position,
    CASE WHEN api_name = 'TotalUnits' THEN 2 ELSE 1 END AS field_type, api_name, 0 AS index,
    CASE api_name WHEN 'ReportMonth' THEN 'Report Month' WHEN 'TotalSales' THEN 'Total Sales'
      WHEN 'TotalUnits' THEN 'Total Units' ELSE 'Top SKU #' || (position - 3) END AS name, value
  FROM (
    SELECT target_ord, target_id, 1 AS position, 'ReportMonth' AS api_name, report_month AS value
    FROM units
    UNION ALL SELECT target_ord, target_id, 2, 'TotalSales',
      '$' || format('{:,.2f}', last_month_total) FROM units
    UNION ALL SELECT target_ord, target_id, 3, 'TotalUnits', CAST(total_units AS VARCHAR) FROM units
    UNION ALL SELECT target_ord, target_id, position + 3, 'TopSKU' || position, line FROM skuline)),
payloads AS (
  SELECT target_ord, any_value(target_id) AS target_id,
    to_json(list({'field_type': field_type, 'api_name': api_name, 'index': index, 'name': name,
      'value': value} ORDER BY position)) AS fields,
    string_agg('        <formField>' || chr(10)
      || '            <fieldType>' || field_type || '</fieldType>' || chr(10)
      || '            <apiName>' || api_name || '</apiName>' || chr(10)
      || '            <index>' || index || '</index>' || chr(10)
      || '            <name>' || name || '</name>' || chr(10)
      || '            <value>' || value || '</value>' || chr(10)
      || '        </formField>', chr(10) ORDER BY position) AS xml_fields
  FROM fields GROUP BY target_ord)"""


def sql(select: str, *parts: str) -> str:
    needed = (BASE, *parts)
    return "WITH " + ",".join(needed) + "\n" + select


LOCATED = (CRM, REFS, RULES)
REPORTED = (*LOCATED, METRICS, REPORTS)
TARGETED = (*REPORTED, TARGETS, FORMS)

DOUBLES = {"qty", "unit_price", "total"}
STD15 = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in DOUBLES else c for c in STANDARD_COLUMNS
)


def wide(value: str, months=MONTHS) -> str:
    return ", ".join(
        f"CAST(coalesce(sum({value}) FILTER (yyyymm = '{m}'), 0) AS DOUBLE) AS \"{m}\""
        for m in months
    )


def wide_skus(value: str) -> str:
    return sql(
        f"SELECT location_code, chain, crm_customer_id, vendor_item, item_description,"
        f" w.* EXCLUDE (location_code, vendor_item)"
        f" FROM (SELECT location_code, vendor_item, {wide(value, SKU_MONTHS)} FROM sales"
        f" WHERE vendor_item IS NOT NULL GROUP BY location_code, vendor_item) w"
        f" LEFT JOIN descr USING (vendor_item) LEFT JOIN locmap USING (location_code)",
        *LOCATED, METRICS,
    )


def matched(rule: str) -> str:
    return sql(
        f"SELECT location_code, crm_customer_id, crm_customer_name FROM {rule}"
        f" JOIN crm ON ref_ord = hit",
        *LOCATED,
    )


OVERRIDES = """
overrides AS (
  SELECT lower(replace(c_name, '#', '-')) AS excel_customer,
    street || ' / ' || r_name AS excel_shipto,
    CAST(80000000 + c_custkey AS VARCHAR) AS crm_customer_id,
    'Manual ' || c_name AS crm_customer_name
  FROM buyers WHERE c_acctbal < 0)"""


def exact(value: str) -> str:
    """A sum at one scale, so that amounts and quantities go into one column unrounded."""
    return f"CAST(sum({value}) AS DECIMAL(28,8))"


# A view's sums beside the chains' own, joined key by key, for each grain and measure.
COMPARED = f"""
chainline AS (
  SELECT c_name AS location_code, sku AS vendor_item,
    strftime(o_orderdate, '%Y-%m') AS yyyymm, amount, units
  FROM line WHERE chain IS NOT NULL),
locsums AS (
  SELECT * FROM (SELECT location_code, yyyymm, {exact('total')} AS vt, {exact('qty')} AS vq FROM sales
                 GROUP BY ALL)
  FULL JOIN (SELECT location_code, yyyymm, {exact('amount')} AS et, {exact('units')} AS eq FROM chainline
             GROUP BY ALL) USING (location_code, yyyymm)),
skusums AS (
  SELECT * FROM (SELECT location_code, vendor_item, yyyymm, {exact('total')} AS vt, {exact('qty')} AS vq
                 FROM sales WHERE vendor_item IS NOT NULL GROUP BY ALL)
  FULL JOIN (SELECT location_code, vendor_item, yyyymm, {exact('amount')} AS et, {exact('units')} AS eq
             FROM chainline WHERE vendor_item IS NOT NULL GROUP BY ALL)
    USING (location_code, vendor_item, yyyymm)),
measured AS (
  SELECT 'location' AS grain, location_code, NULL AS vendor_item, yyyymm, 'sales' AS measure,
    vt AS v, et AS e FROM locsums
  UNION ALL SELECT 'location', location_code, NULL, yyyymm, 'quantity', vq, eq FROM locsums
  UNION ALL SELECT 'sku and location', location_code, vendor_item, yyyymm, 'sales', vt, et
    FROM skusums
  UNION ALL SELECT 'sku and location', location_code, vendor_item, yyyymm, 'quantity', vq, eq
    FROM skusums),
compared AS (
  SELECT *, CASE WHEN e IS NULL THEN 'not expected' WHEN v IS NULL THEN 'missing'
    WHEN abs(v - e) <= 0.005 THEN 'equal' ELSE 'different' END AS status
  FROM measured)"""


def oracle_sql() -> dict[str, str]:
    key_numbers = f"array_to_string({numbers('match_key')}, ',')"
    return {
        "scan_reports": sql(
            """SELECT 'distributor_' || strftime(o_orderdate, '%Y-%m') || '_' || o_orderkey % 2
                   || '.csv' AS sourcefile,
                 sku AS vendor_item, sku || ' ' || p_type AS item_description,
                 CAST(o_orderkey AS VARCHAR) AS invoice, invoice_text AS invoice_date,
                 c_name AS customer, n_name AS city,
                 CASE WHEN r_name <> 'ASIA' THEN r_name END AS state,
                 CASE WHEN r_name = 'MIDDLE EAST' THEN c_name || ' Annex' ELSE c_name END
                   AS customer_name,
                 street AS address1,
                 CASE WHEN o_orderpriority <> '5-LOW' THEN r_name END AS address2,
                 lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zipcode,
                 CAST(units AS DOUBLE) AS ship_qty,
                 CASE l_linenumber WHEN 7 THEN 'n/a' WHEN 6 THEN NULL
                   ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS net_price,
                 CAST(amount AS DOUBLE) AS total, record_type
               FROM line WHERE record_type <> '2'"""
        ),
        "scan_chain_a": sql(f"SELECT {STD15} FROM std WHERE source = 'chain_a'"),
        "scan_chain_b": sql(f"SELECT {STD15} FROM std WHERE source = 'chain_b'"),
        "crm_ref": sql(
            "SELECT * REPLACE (row_number() OVER (ORDER BY ref_ord % 2, ref_ord) - 1 AS ref_ord)"
            " FROM crm",
            CRM,
        ),
        "scan_typed_csv": sql("SELECT * FROM overrides", OVERRIDES),
        "targets": sql("SELECT * FROM targets", TARGETS),
        "normalize_header": """SELECT p_partkey, lower(trim(regexp_replace(
              '# ' || p_brand || chr(10) || p_type || ' (' || p_name || ')',
              '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS header FROM part""",
        "standardize": sql(f"SELECT {STD15} FROM std WHERE source = 'distributor'"),
        "coerce_numeric": """SELECT o_orderkey, CAST(CASE o_orderpriority
              WHEN '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(12,2))
              WHEN '2-HIGH' THEN o_orderkey + 0.5 ELSE 0 END AS DOUBLE) AS amount FROM orders""",
        "coerce_ids": "SELECT o_orderkey, o_custkey || '-' || o_orderkey AS id FROM orders",
        "parse_month": """SELECT o_orderkey,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END
                AS invoice_date,
              CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m') END
                AS yyyymm FROM orders""",
        "concat_address": sql(
            """SELECT c_custkey, concat_ws(', ',
                 CASE WHEN c_acctbal <= 8000 THEN street END,
                 CASE WHEN c_acctbal >= 0 AND c_acctbal < 5000 THEN r_name END) AS address
               FROM buyers"""
        ),
        "norm_key": f"SELECT doc_id, {norm('text')} AS match_key FROM documents",
        "clean_id": sql(
            f"SELECT ref_ord, {clean('raw_id')} AS id, CASE WHEN raw_id <> 'pending'"
            f" THEN {clean('raw_id')} END AS numeric_id FROM export",
            CRM,
        ),
        "street_numbers": f"SELECT doc_id, {key_numbers} AS street_numbers FROM"
        f" (SELECT doc_id, {norm('text')} AS match_key FROM documents)",
        "fmt_money": """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice - 250000) AS shown
              FROM orders""",
        "fmt_qty": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
              THEN CAST(CAST(round_even(o_totalprice / 2, 0) AS BIGINT) AS VARCHAR) ELSE '' END
              AS shown FROM orders""",
        "month_window": """SELECT o_orderkey, array_to_string(list_transform(range(-5, 1),
              lambda i: strftime(date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)),
              '%Y-%m')), ',') AS months FROM orders""",
        "filter_detail": sql(
            """SELECT CAST(o_orderkey AS VARCHAR) AS invoice, record_type,
                 CAST(units AS DOUBLE) AS ship_qty, CAST(amount AS DOUBLE) AS total
               FROM line WHERE l_returnflag <> 'R'"""
        ),
        "filter_trailing": sql(
            f"""SELECT source, location_code, vendor_item, yyyymm, CAST(qty AS DOUBLE) AS qty,
                  CAST(total AS DOUBLE) AS total FROM std WHERE yyyymm IN ({W3})"""
        ),
        "chain_codes": sql("SELECT * FROM codes"),
        "precedence_dedup": sql(
            """SELECT source, location_code, CAST(sum(total) AS DOUBLE) AS total,
                 CAST(sum(qty) AS DOUBLE) AS qty FROM sales GROUP BY source, location_code"""
        ),
        "unified_sales": sql(f"SELECT {STD15} FROM sales"),
        "dedup_audit": sql(
            """SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed
               FROM (SELECT count(*) AS b FROM std WHERE source = 'distributor'),
                    (SELECT count(*) AS a FROM sales WHERE source = 'distributor')"""
        ),
        "file_row_counts": sql(
            """SELECT 'distributor_' || strftime(o_orderdate, '%Y-%m') || '_' || o_orderkey % 2
                 || '.csv' AS sourcefile, count(*) AS rows FROM line WHERE l_returnflag <> 'R' GROUP BY 1"""
        ),
        "distinct_locations": sql("SELECT DISTINCT location_code FROM sales"),
        "run_profile": sql(
            """SELECT count(*) AS transactions,
                 count(*) FILTER (location_code IS NULL) AS rows_without_location,
                 count(DISTINCT location_code) AS locations,
                 min(yyyymm) AS first_month, max(yyyymm) AS last_month,
                 count(*) FILTER (source = 'distributor') AS distributor_rows,
                 count(*) FILTER (source = 'chain_a') AS chain_a_rows,
                 count(*) FILTER (source = 'chain_b') AS chain_b_rows FROM sales"""
        ),
        "reconcile_invoices": sql(
            """SELECT 'before' AS stage, count(*) AS invoices, count(*) FILTER (n > 1)
                 AS in_two_sources FROM (SELECT invoice_num, count(DISTINCT source) AS n
                 FROM std GROUP BY invoice_num)
               UNION ALL SELECT 'after', count(*), count(*) FILTER (n > 1)
                 FROM (SELECT invoice_num, count(DISTINCT source) AS n
                 FROM sales GROUP BY invoice_num)"""
        ),
        "reconcile_totals": sql(
            """SELECT grain, location_code, vendor_item, yyyymm, measure,
                 CAST(v AS DOUBLE) AS view_value, CAST(e AS DOUBLE) AS expected_value, status
               FROM compared""",
            COMPARED,
        ),
        "reconciliation_summary": sql(
            """SELECT grain, measure, status, count(*) AS keys, CAST(sum(v) AS DOUBLE) AS view_value,
                 CAST(sum(e) AS DOUBLE) AS expected_value
               FROM compared GROUP BY grain, measure, status""",
            COMPARED,
        ),
        "canonical_description": sql("SELECT * FROM descr", METRICS),
        "sku_variant_group": f"""SELECT p_partkey, vendor_item, {GROUP} AS sku_group,
              {SHOWN} AS sku_display FROM (SELECT p_partkey, p_name AS vendor_item FROM part)""",
        "sku_alias": """SELECT l_orderkey, l_linenumber, CASE WHEN starts_with(p_name, 'red ')
              THEN 'crimson' || substr(p_name, 4) ELSE p_name END AS vendor_item
              FROM lineitem JOIN part ON l_partkey = p_partkey""",
        "report_month": sql("SELECT max(yyyymm) AS report_month FROM sales"),
        "active_months": sql("SELECT * FROM active", METRICS),
        "active_month_list": sql(f"SELECT DISTINCT yyyymm FROM sales WHERE yyyymm IN ({W6})"),
        "rolling_sales": sql("SELECT * FROM rolling", METRICS),
        "sla_tier": sql(
            f"SELECT location_code, sla_tier, {VISITS} AS visit_frequency FROM tiers", METRICS
        ),
        "rolling_qty": sql("SELECT * FROM skuqty", METRICS),
        "sku_group_qty": sql("SELECT * FROM groupqty", METRICS),
        "most_popular_sku": sql("SELECT * FROM popular", METRICS),
        "sku_sales_3m": sql("SELECT * FROM skusales", *REPORTED),
        "location_ref": sql(
            "SELECT location_code, chain, customer_name, address, city, state, zip FROM locref",
            REFS,
        ),
        "match_exact_name": matched("r1"),
        "match_location_name": matched("r2"),
        "match_contains": matched("r3"),
        "match_contained_by": matched("r4"),
        "match_address": matched("r5"),
        "match_street_number": matched("r6"),
        "location_map": sql("SELECT * FROM locmap", *LOCATED),
        "unmapped_locations": sql("SELECT * FROM locmap WHERE crm_customer_id = ''", *LOCATED),
        "mapping_coverage": sql(
            """SELECT count(*) AS locations, count(*) FILTER (crm_customer_id <> '') AS mapped,
                 count(*) FILTER (crm_customer_id = '') AS unmapped FROM locmap""",
            *LOCATED,
        ),
        "customer_override": sql(
            f"""SELECT m.location_code, m.chain, m.customer_name, m.address, m.city, m.state,
                 m.zip, coalesce(o.crm_customer_id, m.crm_customer_id) AS crm_customer_id,
                 coalesce(o.crm_customer_name, m.crm_customer_name) AS crm_customer_name
               FROM locmap m LEFT JOIN overrides o
                 ON {norm("o.excel_customer")} = {norm("m.customer_name")}
                AND {norm("o.excel_shipto")} = {norm("m.address")}""",
            *LOCATED, OVERRIDES,
        ),
        "unused_overrides": sql(
            f"""SELECT * FROM overrides o WHERE NOT EXISTS (SELECT 1 FROM keyed k
                 WHERE k.norm_name = {norm("o.excel_customer")}
                   AND k.norm_addr = {norm("o.excel_shipto")})""",
            REFS, OVERRIDES,
        ),
        "sales_by_location_month_long": sql(
            """SELECT location_code, yyyymm, CAST(sum(total) AS DOUBLE) AS total FROM sales
               GROUP BY location_code, yyyymm"""
        ),
        "sales_by_sku_location_month_long": sql(
            """SELECT location_code, vendor_item, yyyymm, CAST(sum(total) AS DOUBLE) AS total
               FROM sales WHERE vendor_item IS NOT NULL
               GROUP BY location_code, vendor_item, yyyymm"""
        ),
        "qty_by_sku_location_month_long": sql(
            """SELECT location_code, vendor_item, yyyymm, CAST(sum(qty) AS DOUBLE) AS qty
               FROM sales WHERE vendor_item IS NOT NULL
               GROUP BY location_code, vendor_item, yyyymm"""
        ),
        "enrich_locations": sql(
            """SELECT location_code, yyyymm, CAST(sum(total) AS DOUBLE) AS total,
                 any_value(m.customer_name) AS customer_name, any_value(m.chain) AS chain,
                 any_value(crm_customer_id) AS crm_customer_id,
                 any_value(crm_customer_name) AS crm_customer_name
               FROM sales JOIN locmap m USING (location_code) GROUP BY location_code, yyyymm""",
            *LOCATED,
        ),
        **report_tables(),
        "tier_distribution": sql(
            "SELECT sla_tier, count(*) AS locations FROM tiers GROUP BY sla_tier", METRICS
        ),
        "select_targets": sql(
            """SELECT * FROM targets WHERE lower(customer_label) = 'customer#000000007'
                 OR lower(location_code) = 'customer#000000007' OR target_id = '100000011'
                 OR crm_customer_id = '42'""",
            TARGETS,
        ),
        "resolve_targets": sql("SELECT * FROM resolved", *TARGETED),
        "unresolved_targets": sql(
            """SELECT target_ord, crm_customer_id, target_id, customer_label, chain, location_code
               FROM resolved WHERE key_kind IS NULL""",
            *TARGETED,
        ),
        "delivery_status": sql(
            """SELECT CASE WHEN key_kind IS NULL THEN 'skipped' ELSE 'ready' END AS status,
                 count(*) AS targets FROM resolved GROUP BY 1""",
            *TARGETED,
        ),
        "target_skus": sql("SELECT * EXCLUDE (avg_sales_3m) FROM listed", *TARGETED),
        "target_sku_rank": sql(
            "SELECT target_ord, target_id, vendor_item, position FROM listed", *TARGETED
        ),
        "target_units": sql(
            """SELECT target_ord, target_id, key_kind, key, total_units, sku_rows FROM units""",
            *TARGETED,
        ),
        "target_sku_sales": sql(
            "SELECT target_ord, target_id, position, vendor_item, avg_sales_3m FROM listed",
            *TARGETED,
        ),
        "sku_lines": sql("SELECT * FROM skuline", *TARGETED),
        "form_fields": sql("SELECT * FROM fields", *TARGETED),
        "form_payloads": sql(
            """SELECT p.target_ord, p.target_id, r.crm_customer_id AS holder_id,
                 CASE WHEN r.crm_customer_id IS NOT NULL THEN 2 END AS holder_type,
                 'Sales Report' AS name, 'SalesReport' AS api_name, 'PROCESSED' AS status,
                 CAST(p.fields AS VARCHAR) AS fields
               FROM payloads p JOIN resolved r USING (target_ord)""",
            *TARGETED,
        ),
        "form_xml": sql(
            """SELECT p.target_ord, p.target_id, '<form>' || chr(10)
                 || '    <filledFormId>' || p.target_id || '</filledFormId>' || chr(10)
                 || coalesce('    <holderId>' || r.crm_customer_id || '</holderId>' || chr(10)
                   || '    <holderType>2</holderType>' || chr(10), '')
                 || '    <name>Sales Report</name>' || chr(10)
                 || '    <apiName>SalesReport</apiName>' || chr(10)
                 || '    <status>PROCESSED</status>' || chr(10)
                 || '    <formFields>' || chr(10) || p.xml_fields || chr(10)
                 || '    </formFields>' || chr(10) || '</form>' AS xml
               FROM payloads p JOIN resolved r USING (target_ord)""",
            *TARGETED,
        ),
        "written_report_tables": sql(
            f"""SELECT 'location_snapshot' AS table_name, count(*) AS rows,
                  count(DISTINCT location_code) AS locations,
                  CAST(sum(CAST(last_month_total AS DECIMAL(28,4))) AS DOUBLE) AS month_total
                FROM snapshot
                UNION ALL SELECT 'top_skus', count(*), count(DISTINCT location_code),
                  CAST(sum(CAST(last_month_qty AS DECIMAL(28,4))) AS DOUBLE) FROM topskus
                UNION ALL SELECT 'sales_by_location_month', count(DISTINCT location_code),
                  count(DISTINCT location_code),
                  CAST(coalesce(sum(total) FILTER (yyyymm = '{R}'), 0) AS DOUBLE) FROM sales
                UNION ALL SELECT name, count(DISTINCT (location_code, vendor_item)),
                  count(DISTINCT location_code),
                  CAST(coalesce(sum(CASE name WHEN 'qty_by_sku_location_month' THEN qty
                    ELSE total END) FILTER (yyyymm = '{R}'), 0) AS DOUBLE)
                FROM sales, (VALUES ('sales_by_sku_location_month'),
                                    ('qty_by_sku_location_month')) AS t(name)
                WHERE vendor_item IS NOT NULL GROUP BY name""",
            *REPORTED,
        ),
        "written_location_map": sql(
            """SELECT location_code, chain, coalesce(customer_name, '') AS customer_name,
                 coalesce(address, '') AS address, coalesce(city, '') AS city,
                 coalesce(state, '') AS state, coalesce(zip, '') AS zip,
                 crm_customer_id, crm_customer_name FROM locmap""",
            *LOCATED,
        ),
        "written_unmapped_locations": sql(
            "SELECT location_code, chain FROM locmap WHERE crm_customer_id = ''", *LOCATED
        ),
        "written_payloads": sql(
            """SELECT p.target_id, r.crm_customer_id AS holder_id,
                 CASE WHEN r.crm_customer_id IS NOT NULL THEN 2 END AS holder_type,
                 'Sales Report' AS name, 'SalesReport' AS api_name, 'PROCESSED' AS status,
                 CAST(p.fields AS VARCHAR) AS fields
               FROM payloads p JOIN resolved r USING (target_ord)""",
            *TARGETED,
        ),
        "delivery_results": sql(
            """SELECT run, CASE WHEN key_kind IS NULL THEN 'skipped' WHEN run = 1 THEN 'delivered'
                 ELSE 'already there' END AS status, count(*) AS targets
               FROM resolved, (VALUES (1), (2)) AS t(run) GROUP BY ALL""",
            *TARGETED,
        ),
    } | {f"stored_{name}": table for name, table in report_tables().items()}


def report_tables() -> dict[str, str]:
    """The five report tables, also as they are read back from the store."""
    return {
        "sales_by_location_month": sql(
            f"""SELECT location_code, customer_name, chain, crm_customer_id, crm_customer_name,
                  w.* EXCLUDE (location_code)
                FROM (SELECT location_code, {wide("total")} FROM sales GROUP BY location_code) w
                LEFT JOIN locmap USING (location_code)""",
            *LOCATED,
        ),
        "sales_by_sku_location_month": wide_skus("total"),
        "qty_by_sku_location_month": wide_skus("qty"),
        "location_snapshot": sql("SELECT * FROM snapshot", *REPORTED),
        "top_skus": sql("SELECT * FROM topskus", *REPORTED),
    }
