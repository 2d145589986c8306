"""Views that give the generated tables the shape of the operators' inputs.

Each view is one SELECT that both Spark and DuckDB read, so the two sides of a
comparison start from the same rows. What is compared, the operator itself, is
written twice: as DataFrame code in the package and as SQL in the registry.
``{name}`` refers to a table or to another view.
"""

from __future__ import annotations

import re

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

BARCODE = (
    "CASE WHEN {k} % 7 = 0 THEN 'false' WHEN {k} % 5 = 0 THEN NULL"
    " WHEN {k} % 3 = 0 THEN CAST({k} AS STRING) ELSE 'B' || CAST({k} AS STRING) END"
)


def _m2o(key: str, name: str) -> str:
    return f"'[' || CAST({key} AS STRING) || ',\"' || {name} || '\"]'"


LINE_ID = "l_orderkey * 8 + l_linenumber"
# payments are numbered in time, so those of one order are spread out
PAYMENT_ID = (
    "((year(l_shipdate) * 400 + month(l_shipdate) * 32 + day(l_shipdate)) * CAST(10000 AS BIGINT)"
    " + (l_orderkey * 8 + l_linenumber) % 10000)"
)
REF = "l_returnflag || l_linestatus || '/' || CAST(l_orderkey AS STRING)"
SHIP_TEXT = "CAST(l_shipdate AS STRING)"

VIEWS: dict[str, str] = {
    # ---- source records -----------------------------------------------------
    "product_raw": f"""
        SELECT p_partkey AS id, '[x] ' || p_brand || ' -  ' || p_name AS name,
               {BARCODE.format(k='p_partkey')} AS barcode, p_size > 2 AS active,
               {_m2o('p_partkey', "p_name")} AS product_tmpl_id,
               CAST(TIMESTAMP '2024-01-01 00:00:00' AS STRING) AS create_date,
               '2024-01-' || lpad(CAST(p_size % 28 + 1 AS STRING), 2, '0') || ' 08:00:00' AS write_date
        FROM {{part}}""",
    "template_raw": f"""
        SELECT p_partkey AS id,
               CASE WHEN p_partkey % 17 = 0 THEN 'false' ELSE '[' || CAST(p_size AS STRING) || ',"c"]' END AS categ_id,
               '[' || CAST(p_size % 6 AS STRING) || ',"u"]' AS uom_id
        FROM {{part}}""",
    "category_raw": f"""
        SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'Size ' || CAST(p_size AS STRING) ||
               CASE p_size % 4 WHEN 0 THEN ' Lace' WHEN 1 THEN ' closure' WHEN 2 THEN ' Perruque' ELSE '' END AS name,
               CASE WHEN p_size < 4 THEN 'false'
                    ELSE '[' || CAST(CAST(floor(p_size / 2) AS BIGINT) AS STRING) || ',"p"]' END AS parent_id
        FROM {{part}}""",
    "unit_raw": """
        SELECT DISTINCT CAST(p_size % 6 AS BIGINT) AS id,
               CASE p_size % 6 WHEN 0 THEN 'PCS' WHEN 1 THEN ' unité ' WHEN 2 THEN ' Box ' WHEN 3 THEN ''
                    WHEN 4 THEN 'Units' ELSE NULL END AS name
        FROM {part}""",
    "employee_raw": f"""
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_custkey % 3 = 0 THEN 'false' ELSE lower(c_name) || '@mail' END AS work_email,
               CASE WHEN c_custkey % 5 = 0 THEN 'false' ELSE {_m2o('c_nationkey', 'c_mktsegment')} END AS job_id,
               {_m2o('c_nationkey', "'Dept, ' || CAST(c_nationkey AS STRING)")} AS department_id,
               c_acctbal > 0 AS active
        FROM {{customer}}""",
    "shop_raw": f"""
        SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_name END AS name,
               CASE WHEN s_suppkey % 4 = 0 THEN 'false' ELSE {_m2o('s_nationkey', "'Co'")} END AS company_id,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal > 0 END AS active
        FROM {{supplier}}""",
    "location_raw": f"""
        SELECT s_suppkey AS id, s_name AS name,
               CASE WHEN s_suppkey % 11 = 0 THEN 'false' ELSE
                 CASE s_suppkey % 3 WHEN 0 THEN 'Depot/Central/' WHEN 1 THEN ' Boutique/' ELSE 'Partner/' END || s_name
               END AS complete_name,
               CASE s_suppkey % 5 WHEN 0 THEN 'internal' WHEN 1 THEN 'customer' WHEN 2 THEN ' supplier '
                    WHEN 3 THEN 'inventory' ELSE 'false' END AS usage,
               CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_acctbal > 0 END AS active,
               CASE WHEN s_suppkey % 4 = 0 THEN 'false' ELSE {_m2o('s_nationkey', "'N'")} END AS location_id
        FROM {{supplier}}""",
    "method_raw": f"""
        SELECT c_custkey AS id, ' ' || c_name || ' ' AS name,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal > 0 END AS active,
               'false' AS create_date, '2024-01-02 03:04:05' AS write_date,
               CASE WHEN c_custkey % 4 = 0 THEN 'false' ELSE {_m2o('c_nationkey', "'own'")} END AS cash_journal_id
        FROM {{customer}}""",
    "journal_raw": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS name,
               'cash' AS type
        FROM {nation} WHERE n_regionkey < 4""",
    "line_raw": f"""
        SELECT {LINE_ID} AS id, {_m2o('l_orderkey', "'Move'")} AS move_id,
               CASE WHEN l_linestatus = 'O' THEN 'false' ELSE {_m2o('l_orderkey', REF)} END AS picking_id,
               {_m2o('l_partkey', "'Part'")} AS product_id, {_m2o('l_suppkey', "'From'")} AS location_id,
               {_m2o('l_suppkey + 1', "'To'")} AS location_dest_id, l_quantity AS qty_done, '[1,"Units"]' AS product_uom_id,
               CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'draft' ELSE 'done' END AS state,
               'false' AS date, {SHIP_TEXT} AS write_date,
               CASE WHEN l_returnflag = 'N' THEN 'false' ELSE 'REF/' || CAST(l_orderkey AS STRING) END AS reference
        FROM {{lineitem}}""",
    "priced_product": f"""
        SELECT p_partkey AS id, {BARCODE.format(k='p_partkey')} AS barcode, p_retailprice AS list_price,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice * 0.5 END AS standard_price
        FROM {{part}}""",
    "quant_raw": f"""
        SELECT {LINE_ID} AS id, {SHIP_TEXT} AS write_date, 'false' AS create_date,
               CASE WHEN l_partkey % 19 = 0 THEN 'false' ELSE {_m2o('l_partkey', "'P'")} END AS product_id,
               {_m2o('l_suppkey', "'L'")} AS location_id, '[1,"C"]' AS company_id, 'false' AS lot_id,
               l_quantity AS quantity, l_tax AS reserved_quantity,
               CASE WHEN l_returnflag = 'R' THEN 'false' ELSE {SHIP_TEXT} END AS in_date
        FROM {{lineitem}}""",
    "order_raw": f"""
        SELECT o_orderkey AS id, 'Order ' || CAST(o_orderkey AS STRING) AS name,
               CASE WHEN o_orderstatus = 'P' THEN 'false' ELSE 'POS/' || CAST(o_orderkey AS STRING) END AS pos_reference,
               'false' AS uuid,
               CASE WHEN o_orderstatus = 'O' THEN 'false' ELSE {_m2o('c_nationkey', "'Session'")} END AS session_id,
               {_m2o('c_nationkey', "'NATION_' || CAST(c_nationkey AS STRING)")} AS config_id,
               CASE WHEN o_orderstatus = 'F' THEN 'bad' ELSE CAST(o_orderdate AS STRING) END AS date_order,
               CAST(o_orderdate AS STRING) AS write_date,
               CASE WHEN o_custkey % 5 = 0 THEN 'false' ELSE {_m2o('o_custkey', 'c_name')} END AS employee_id,
               'false' AS partner_id, o_totalprice * 0.25 AS amount_tax, o_totalprice AS amount_total,
               o_totalprice AS amount_paid, 0.0 AS amount_return, o_orderstatus AS state
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey""",
    "order_line_raw": f"""
        SELECT {LINE_ID} AS id, {_m2o('l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000000 ELSE 0 END', "'O'")} AS order_id,
               {_m2o('l_partkey', "'Part, ' || CAST(l_partkey AS STRING)")} AS product_id, l_quantity AS qty,
               l_extendedprice AS price_unit, l_discount AS discount, l_extendedprice AS price_subtotal,
               l_extendedprice * 1.25 AS price_subtotal_incl, {SHIP_TEXT} AS create_date, {SHIP_TEXT} AS write_date
        FROM {{lineitem}}""",
    # lines that share order and number get ids of their own
    "numbered_line": f"""
        SELECT *, {LINE_ID} + (row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1) * 1000000000000 AS line_id
        FROM {{lineitem}}""",
    "numbered_line_raw": f"""
        SELECT line_id AS id, {_m2o('l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000000 ELSE 0 END', "'O'")} AS order_id,
               {_m2o('l_partkey', "'Part, ' || CAST(l_partkey AS STRING)")} AS product_id, l_quantity AS qty,
               l_extendedprice AS price_unit, l_discount AS discount, l_extendedprice AS price_subtotal,
               l_extendedprice * 1.25 AS price_subtotal_incl, {SHIP_TEXT} AS create_date, {SHIP_TEXT} AS write_date
        FROM {{numbered_line}}""",
    "payment_raw": f"""
        SELECT {PAYMENT_ID} AS id, {_m2o('l_orderkey', "'O'")} AS pos_order_id,
               CASE WHEN l_linenumber = 6 THEN '[6]' ELSE
                 {_m2o('l_linenumber', "'Pay ' || CAST(l_linenumber AS STRING)")} END AS payment_method_id,
               l_extendedprice * CASE WHEN l_suppkey = 3 THEN 1000000000.0 ELSE 1.0 END AS amount,
               CASE WHEN l_returnflag = 'R' THEN 'false' ELSE {SHIP_TEXT} END AS payment_date,
               CASE WHEN l_linestatus = 'O' THEN 'false' ELSE {SHIP_TEXT} END AS create_date,
               {SHIP_TEXT} AS write_date, l_returnflag = 'A' AS is_change
        FROM {{lineitem}}""",
    # payments and quants under ids that do not repeat
    "numbered_payment_raw": f"""
        SELECT line_id AS id, {_m2o('l_orderkey', "'O'")} AS pos_order_id, {_m2o('l_linenumber', "'Pay ' || CAST(l_linenumber AS STRING)")} AS payment_method_id,
               l_extendedprice AS amount, CASE WHEN l_returnflag = 'R' THEN 'false' ELSE {SHIP_TEXT} END AS payment_date,
               {SHIP_TEXT} AS write_date, l_returnflag = 'A' AS is_change
        FROM {{numbered_line}}""",
    "numbered_quant_raw": f"""
        SELECT line_id AS id, {SHIP_TEXT} AS write_date, 'false' AS create_date,
               CASE WHEN l_partkey % 19 = 0 THEN 'false' ELSE {_m2o('l_partkey', "'P'")} END AS product_id,
               {_m2o('l_suppkey', "'L'")} AS location_id, '[1,"C"]' AS company_id, 'false' AS lot_id,
               l_quantity AS quantity, l_tax AS reserved_quantity,
               CASE WHEN l_returnflag = 'R' THEN 'false' ELSE {SHIP_TEXT} END AS in_date
        FROM {{numbered_line}}""",
    "session_raw": f"""
        SELECT o_orderkey AS id, {_m2o('o_custkey', "'S'")} AS config_id, CAST(o_orderdate AS STRING) AS start_at,
               'false' AS stop_at, o_orderstatus AS state, CAST(o_orderdate AS STRING) AS write_date
        FROM {{orders}}""",
    "expense_raw": f"""
        SELECT {LINE_ID} AS id, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'false' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date,
               CASE WHEN s_suppkey % 13 = 0 THEN 'false' ELSE {_m2o('s_nationkey', "'EMP ' || CAST(s_nationkey AS STRING)")} END AS employee_id,
               'Spent' AS name, l_tax * 100.0 AS total_amount, l_returnflag AS state,
               {SHIP_TEXT} AS write_date, {SHIP_TEXT} AS create_date
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    # ---- loaded tables --------------------------------------------------------
    "product": f"""
        SELECT p_partkey AS product_id, p_brand || '-' || p_name AS name_raw, upper(p_name) AS name_norm,
               'VENTE / ' || p_type AS category_norm, p_type AS category,
               {BARCODE.format(k='p_partkey')} AS barcode, p_size > 5 AS is_current, p_size > 2 AS sale_ok,
               CAST(CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(16,4)) AS price,
               CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_retailprice * 0.5 END AS DECIMAL(16,4)) AS cost
        FROM {{part}}""",
    "location": """
        SELECT s_suppkey AS location_id,
               CASE s_suppkey % 4 WHEN 0 THEN 'internal' WHEN 1 THEN 'customer' WHEN 2 THEN 'supplier'
                    ELSE 'inventory' END AS usage,
               CASE s_suppkey % 3 WHEN 0 THEN 'DEPOT/CENTRAL/' WHEN 1 THEN 'BOUTIQUE/' ELSE 'PARTNER/' END || s_name AS complete_name,
               CASE s_suppkey % 3 WHEN 0 THEN 'DEPOT | CENTRAL | ' WHEN 1 THEN 'BOUTIQUE | ' ELSE 'PARTNER | ' END || upper(s_name) AS name_norm
        FROM {supplier}""",
    "staged": f"""
        SELECT {LINE_ID} AS move_line_id, l_orderkey AS move_id, l_orderkey AS picking_id,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS write_ts, l_shipdate AS business_ts,
               CAST(l_shipdate AS DATE) AS part_day,
               CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'draft' WHEN l_linenumber = 5 THEN NULL ELSE 'done' END AS state,
               l_partkey AS product_id, l_suppkey AS location_id, l_suppkey + 1 AS location_dest_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(16,4)) AS qty_done,
               'Units' AS uom_name, {BARCODE.format(k='l_partkey')} AS barcode,
               CAST(l_extendedprice AS DECIMAL(16,4)) AS unit_sale_price,
               CAST(CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount * 100 END AS DECIMAL(16,4)) AS unit_cost,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE {REF} END AS movement_ref,
               CASE WHEN l_linenumber = 1 THEN '{{{{"raw":{{{{"picking_id":false}}}}}}}}'
                    ELSE '{{{{"raw":{{{{"picking_id":[1,"PICK/' || CAST(l_orderkey AS STRING) || '"]}}}}}}}}' END AS payload
        FROM {{lineitem}}""",
    "movement": f"""
        SELECT CAST(l_shipdate AS DATE) AS movement_day, {LINE_ID} AS move_line_id, l_partkey AS product_id, side,
               l_suppkey + CASE WHEN side = 'DST' THEN 1 ELSE 0 END AS location_id,
               CAST(l_quantity AS DECIMAL(16,4)) AS qty, {BARCODE.format(k='l_partkey')} AS barcode,
               usage AS location_usage, coalesce(usage = 'internal', false) AS is_internal,
               CAST(l_extendedprice AS DECIMAL(16,4)) AS unit_sale_price,
               CAST(CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS DECIMAL(16,4)) AS unit_cost,
               CASE l_returnflag WHEN 'A' THEN 'SALE' WHEN 'R' THEN 'RETURN' ELSE NULL END AS movement_type,
               CAST(CASE WHEN coalesce(usage = 'internal', false) THEN CASE WHEN side = 'SRC' THEN -l_quantity ELSE l_quantity END
                    ELSE 0 END AS DECIMAL(16,4)) AS signed_qty,
               year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS date_key
        FROM (SELECT *, 'SRC' AS side FROM {{lineitem}} UNION ALL SELECT *, 'DST' AS side FROM {{lineitem}}) x
        LEFT JOIN {{location}} loc ON loc.location_id = x.l_suppkey + CASE WHEN side = 'DST' THEN 1 ELSE 0 END""",
    "opening": """
        SELECT CAST(l_shipdate AS DATE) AS opening_date, l_partkey AS product_id, l_suppkey AS location_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_returnflag = 'N' THEN l_quantity * 0.02 ELSE l_quantity END
                    AS DECIMAL(16,4)) AS opening_qty,
               CAST(CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE l_discount END AS DECIMAL(16,4)) AS unit_cost,
               CAST(CASE WHEN l_partkey % 13 = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(16,4)) AS unit_sale_price,
               CAST(l_quantity * l_discount AS DECIMAL(18,4)) AS value_cost,
               CAST(l_quantity * l_extendedprice AS DECIMAL(18,4)) AS value_sale,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT) * 10 END AS in_date
        FROM {lineitem}""",
    "pay": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(c_nationkey AS BIGINT) AS config_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN 99 ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS method_id,
               CAST(o_totalprice AS DECIMAL(16,4)) AS amount, CAST(o_orderdate AS DATE) AS payment_day
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "shop": "SELECT CAST(n_nationkey AS BIGINT) AS shop_id, ' Nation - ' || CAST(n_nationkey AS STRING) AS name FROM {nation}",
    "method": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS method_id, o_orderpriority AS name FROM {orders}""",
    "expense": """
        SELECT CAST(l_shipdate AS DATE) AS expense_date, CAST(l_tax * 100 AS DECIMAL(16,4)) AS total_amount,
               'EMP ' || CAST(s_nationkey AS STRING) AS employee_name
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'""",
    "staff": """
        SELECT 'EMP ' || CAST(n_nationkey AS STRING) AS employee_name, 'NATION' || CAST(n_nationkey AS STRING) AS shop_key,
               n_nationkey % 10 <> 9 AS is_active,
               CASE WHEN n_nationkey % 2 = 0 THEN DATE '1995-01-01' ELSE DATE '1997-01-01' END AS valid_from,
               DATE '2000-06-30' AS valid_to
        FROM {nation}""",
    "runs": """
        SELECT event_type AS job_name, CASE WHEN user_id % 2 = 0 THEN ' TS ' ELSE NULL END AS watermark_type,
               CASE WHEN value > 200 THEN NULL ELSE ts END AS watermark_ts,
               CASE WHEN value < 1 THEN NULL ELSE event_id END AS watermark_id,
               CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id * 60 END AS lookback_sec,
               ts AS started_at, ts AS ended_at,
               CASE WHEN value > 100 THEN 'FAIL' WHEN value > 50 THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
               event_id % 1000 AS row_count, props AS error, TRUE AS is_enabled
        FROM {events}""",
}


def _names(template: str) -> list[str]:
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", template)


def _needed(names: list[str], seen: dict[str, None]) -> dict[str, None]:
    for name in names:
        if name in VIEWS and name not in seen:
            _needed(_names(VIEWS[name]), seen)
            seen[name] = None
    return seen


def oracle(sql: str) -> str:
    """DuckDB text: the views that ``sql`` names in braces, then ``sql`` itself."""
    ctes = [f"{v} AS ({_plain(VIEWS[v])})" for v in _needed(_names(sql), {})]
    body = _plain(sql).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("WITH RECURSIVE "):]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[len("WITH "):]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _plain(template: str) -> str:
    return re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", template).replace("{{", "{").replace("}}", "}")


class Tables:
    """Generated tables and views as DataFrames, by name."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict = {}

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in VIEWS:
                template = VIEWS[name]
                parts = {n: getattr(self, n) for n in _names(template)}
                self._frames[name] = self.spark.sql(template, **parts)
            elif name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._frames[name]
