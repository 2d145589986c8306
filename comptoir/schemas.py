"""Input contracts. Every source is read with an explicit schema.

Relations arrive as JSON text, ``[id, "name"]`` or ``false``; timestamps as
``yyyy-MM-dd HH:mm:ss`` text. ``functions.records`` turns both into columns.
"""

from __future__ import annotations

# fixed values: the keys of one line of a move-line extract file
MOVE_LINE_FILE = """
    odoo_id BIGINT, move_id BIGINT, picking_id BIGINT, product_id BIGINT,
    location_id BIGINT, location_dest_id BIGINT, qty DOUBLE, uom STRING, state STRING,
    date_value STRING, write_date STRING, barcode STRING,
    unit_sale_price DOUBLE, unit_cost DOUBLE, raw STRING
"""

MOVEMENT_RULE = "code STRING, pattern STRING, priority INT, is_active BOOLEAN"

STAFF_MAP = """
    shop_key STRING, employee_name STRING, is_active BOOLEAN, valid_from DATE, valid_to DATE
"""

RUN_LOG = """
    job_name STRING, watermark_type STRING, watermark_ts TIMESTAMP_NTZ, watermark_id BIGINT,
    lookback_sec BIGINT, started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ, status STRING,
    row_count BIGINT, error STRING, is_enabled BOOLEAN
"""

QTY = "decimal(16,4)"
VALUE = "decimal(18,4)"

# fixed values: source columns that hold a relation as JSON text
MOVE_LINE_RELATIONS = ("move_id", "picking_id", "product_id", "location_id", "location_dest_id", "product_uom_id")
QUANT_RELATIONS = ("product_id", "location_id", "company_id", "lot_id")
ORDER_RELATIONS = ("session_id", "config_id", "employee_id", "partner_id")
ORDER_LINE_RELATIONS = ("order_id", "product_id")
PAYMENT_RELATIONS = ("pos_order_id", "payment_method_id")
SESSION_RELATIONS = ("config_id",)
EXPENSE_RELATIONS = ("employee_id",)
