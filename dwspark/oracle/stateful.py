"""DuckDB SQL of the stateful load's results, from the scenario's definition:
what the earlier sources held, what the delta touches, and what must come out."""

from __future__ import annotations

from ..functions.keys import surrogate_key_sql as K
from .binding import _tk, with_binding

D0, D1 = "DATE '2001-03-01'", "DATE '2001-04-01'"
CUSTOMER = "person_type name sex income_band marital_status birth_year profession address_id area_code phone_type".split()
EMPLOYEE = "name hire_date title address_id".split()
PRODUCT = "name category price currency".split()
ADDRESS = "address_type street postal_code district city_key".split()


def _n(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def _changed(attrs: list[str]) -> str:
    return "(" + " OR ".join(f"n.{a} IS DISTINCT FROM b.{a}" for a in attrs) + ")"


def _type2(entity: str, key: str, attrs: list[str]) -> str:
    """history_<entity>: one row per version after both loads."""
    show = lambda x: ", ".join(f"{x}.{a}" for a in ["source_system", key, *attrs])
    both = f"n.{key} IS NOT NULL AND {_changed(attrs)}"
    on = f"ON n.source_system = b.source_system AND n.{key} = b.{key}"
    return f"""reread_{entity} AS (SELECT * FROM now_{entity} SEMI JOIN touched_{entity} USING (source_system, {key})),
    history_{entity} AS (
      SELECT {show('b')}, {K('b.source_system', f'b.{key}')} AS entity_key, {K('b.source_system', f'b.{key}', D0)} AS version_key,
             {D0} AS valid_from, CASE WHEN {both} THEN {D1} - 1 END AS valid_to, NOT coalesce({both}, FALSE) AS is_current
      FROM before_{entity} b LEFT JOIN reread_{entity} n {on}
      UNION ALL
      SELECT {show('n')}, {K('n.source_system', f'n.{key}')}, {K('n.source_system', f'n.{key}', D1)}, {D1}, NULL, TRUE
      FROM reread_{entity} n LEFT JOIN before_{entity} b {on} WHERE b.{key} IS NULL OR {_changed(attrs)})"""


def _type1(entity: str, key: str, attrs: list[str]) -> str:
    pick = ", ".join(f"CASE WHEN n.{key} IS NULL THEN b.{a} ELSE n.{a} END AS {a}" for a in attrs)
    return f"""reread_{entity} AS (SELECT * FROM now_{entity} SEMI JOIN touched_{entity} USING (source_system, {key})),
    upserted_{entity} AS (
      SELECT coalesce(n.source_system, b.source_system) AS source_system, coalesce(n.{key}, b.{key}) AS {key}, {pick},
             CASE WHEN b.{key} IS NULL THEN 'insert' WHEN n.{key} IS NOT NULL AND {_changed(attrs)} THEN 'update'
                  ELSE 'unchanged' END AS change
      FROM before_{entity} b FULL JOIN reread_{entity} n ON n.source_system = b.source_system AND n.{key} = b.{key})"""


_SCENARIO = f"""
    cut AS (SELECT coalesce(max(o_orderkey), 0) // 2 AS v FROM orders),
    first_items AS (SELECT *, CAST(l_partkey AS VARCHAR) AS product_id FROM sales_lines WHERE o_orderkey <= (SELECT v FROM cut)),
    bound AS (SELECT s.source_system, coalesce(max(f.o_orderkey), 0) AS v FROM (VALUES ('WHOLESALE'), ('RETAIL')) s(source_system)
              LEFT JOIN first_items f USING (source_system) GROUP BY ALL),
    next_items AS (SELECT sl.*, CAST(l_partkey AS VARCHAR) AS product_id FROM sales_lines sl JOIN bound USING (source_system)
                   WHERE o_orderkey > bound.v),
    next_bought AS (SELECT * FROM purchase_lines WHERE l_orderkey > (SELECT v FROM bound WHERE source_system = 'RETAIL')),
    first_shops AS (SELECT DISTINCT l_suppkey FROM purchase_lines WHERE l_orderkey <= (SELECT v FROM cut)),
    now_customer AS (SELECT * FROM customers),
    before_customer AS (
      SELECT * REPLACE (CASE WHEN source_system = 'WHOLESALE' AND {_n('customer_id')} % 5 = 0 THEN name || ' (before)' ELSE name END AS name,
                        CASE WHEN source_system = 'RETAIL' AND {_n('customer_id')} % 5 = 0 THEN profession || ' (before)' ELSE profession END AS profession)
      FROM customers WHERE {_n('customer_id')} % 13 <> 0),
    touched_customer AS (SELECT DISTINCT source_system, customer_id FROM next_items),
    now_employee AS (SELECT 'WHOLESALE' AS source_system, employee_id, concat_ws(' ', first_name, last_name) AS name, hire_date, title,
                            'EMP-' || employee_id AS address_id FROM ws_employees),
    before_employee AS (SELECT * REPLACE (CASE WHEN {_n('employee_id')} % 3 = 0 THEN title || ' (before)' ELSE title END AS title)
                        FROM now_employee WHERE {_n('employee_id')} % 13 <> 0),
    touched_employee AS (SELECT DISTINCT source_system, employee_id FROM next_items WHERE employee_id IS NOT NULL),
    now_product AS (SELECT source_system, product_id, product_name AS name, category, price, currency FROM dim_product),
    before_product AS (SELECT * REPLACE (CASE WHEN {_n('product_id')} % 7 = 0 THEN CAST(price + 1 AS DECIMAL(15,2)) ELSE price END AS price)
                       FROM now_product WHERE {_n('product_id')} % 13 <> 0),
    touched_product AS (SELECT source_system, product_id FROM next_items UNION SELECT 'RETAIL', CAST(l_partkey AS VARCHAR) FROM next_bought),
    now_carrier AS (SELECT 'WHOLESALE' AS source_system, carrier_id, company_name AS name, phone FROM ws_carriers),
    before_carrier AS (SELECT * REPLACE (phone || ' (before)' AS phone) FROM now_carrier WHERE carrier_id IN
                       (SELECT split_part(o_orderpriority, '-', 1) FROM orders WHERE o_orderkey <= (SELECT v FROM cut))),
    touched_carrier AS (SELECT DISTINCT source_system, carrier_id FROM next_items WHERE carrier_id IS NOT NULL),
    now_supplier AS (SELECT 'RETAIL' AS source_system, CAST(supplier_id AS VARCHAR) AS supplier_id, name,
                            '(' || CAST(area_code AS VARCHAR) || ') ' || number AS phone, 'SUP-' || CAST(supplier_id AS VARCHAR) AS address_id
                     FROM rt_suppliers_used),
    before_supplier AS (SELECT * REPLACE (CASE WHEN {_n('supplier_id')} % 4 = 0 THEN split_part(phone, ' ', 1) || ' 0' ELSE phone END AS phone)
                        FROM now_supplier WHERE {_n('supplier_id')} % 13 <> 0 AND {_n('supplier_id')} IN (SELECT l_suppkey FROM first_shops)),
    touched_supplier AS (SELECT DISTINCT 'RETAIL' AS source_system, CAST(l_suppkey AS VARCHAR) AS supplier_id FROM next_bought),
    now_address AS (SELECT source_system, address_id, address_type, street, postal_code, district, {K('country', 'state_code', 'city')} AS city_key
                    FROM address_inputs),
    before_address AS (
      SELECT * REPLACE (CASE WHEN source_system = 'RETAIL' AND address_id NOT LIKE '%-%' AND {_n("split_part(address_id, '-', -1)")} % 6 = 0
                             THEN '0' ELSE postal_code END AS postal_code)
      FROM now_address WHERE {_n("split_part(address_id, '-', -1)")} % 13 <> 0
        AND (address_id NOT LIKE 'SUP-%' OR {_n("split_part(address_id, '-', -1)")} IN (SELECT l_suppkey FROM first_shops))),
    touched_address AS (
      SELECT source_system, address_id FROM customers SEMI JOIN touched_customer USING (source_system, customer_id)
      UNION SELECT source_system, 'EMP-' || employee_id FROM touched_employee
      UNION SELECT source_system, 'SUP-' || supplier_id FROM touched_supplier),
    {_type2('customer', 'customer_id', CUSTOMER)},
    {_type2('employee', 'employee_id', EMPLOYEE)},
    {_type2('product', 'product_id', PRODUCT)},
    {_type1('carrier', 'carrier_id', ['name', 'phone'])},
    {_type1('supplier', 'supplier_id', ['name', 'phone', 'address_id'])},
    {_type1('address', 'address_id', ADDRESS)},
    loaded AS (
      SELECT i.*, 'initial' AS load, {', '.join(f"coalesce({e}.version_key, -1) AS {e}_version_key" for e in ('customer', 'employee', 'product'))}
      FROM first_items i
      {' '.join(f"LEFT JOIN history_{e} {e} ON {e}.source_system = i.source_system AND {e}.{e}_id = i.{e}_id AND {e}.valid_from = {D0}" for e in ('customer', 'employee', 'product'))}
      UNION ALL
      SELECT i.*, 'delta', {', '.join(f"coalesce({e}.version_key, -1)" for e in ('customer', 'employee', 'product'))}
      FROM next_items i
      {' '.join(f"LEFT JOIN history_{e} {e} ON {e}.source_system = i.source_system AND {e}.{e}_id = i.{e}_id AND {e}.is_current" for e in ('customer', 'employee', 'product'))})"""


def _sql(body: str) -> str:
    full = with_binding("SELECT 1")
    return f"{full[:full.rfind(chr(10) + 'SELECT 1')]},{_SCENARIO}\n{body}"


def oracle_sql() -> dict[str, str]:
    out = {f"{e}_history": _sql(f"SELECT * FROM history_{e}") for e in ("customer", "employee", "product")}
    for e, attrs in (("customer", CUSTOMER), ("employee", EMPLOYEE), ("product", PRODUCT)):
        out[f"dim_{e}_incremental"] = _sql(f"""
            SELECT h.source_system, h.{e}_id, {', '.join('h.' + a for a in attrs)}, h.valid_from,
                   CASE WHEN h.valid_from = {D0} THEN 'unchanged' WHEN b.{e}_id IS NULL THEN 'insert' ELSE 'update' END AS change
            FROM history_{e} h LEFT JOIN before_{e} b ON b.source_system = h.source_system AND b.{e}_id = h.{e}_id WHERE h.is_current""")
    for e in ("carrier", "supplier", "address"):
        out[f"dim_{e}_incremental"] = _sql(f"SELECT * FROM upserted_{e}")
    out["corporate_append"] = _sql("""SELECT source_system, sale_id, customer_id, customer_version_key, load, count(*) AS items,
        CAST(sum(item_total) AS DECIMAL(38,2)) AS value FROM loaded GROUP BY ALL""")
    out["fact_sales_versioned"] = _sql(f"""SELECT source_system, sale_id, l_linenumber AS line, {_tk('order_date')} AS time_key,
        {K('source_system', 'customer_id')} AS customer_key, customer_version_key, product_version_key, employee_version_key,
        quantity, item_total FROM loaded""")
    return out
