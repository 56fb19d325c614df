"""DuckDB SQL of what three loads leave in the warehouse, from the scenario's
definition: the sources at three times, what each load reads of them, and which of that is a change."""

from __future__ import annotations

from ..functions.keys import surrogate_key_sql as K
from .binding import _tk, with_binding

DAY = {1: "DATE '2001-03-01'", 2: "DATE '2001-04-01'", 3: "DATE '2001-05-01'"}
AGE = {1: 1, 2: 2, 3: 0}
ATTRS = {
    "customer": "person_type name sex income_band marital_status birth_year profession address_id area_code phone_type".split(),
    "employee": "name hire_date title address_id".split(),
    "product": "name category price currency".split(),
    "address": "address_type street postal_code district city_key".split(),
    "carrier": "name phone".split(),
    "supplier": "name phone address_id".split(),
}
TYPE2 = ["customer", "employee", "product"]
SALE_TYPE = "CASE sale_type_code WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} END"


def _n(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def _at(entity: str, load: int) -> str:
    """An entity's rows in the sources at a load."""
    age, key = AGE[load], f"{entity}_id"
    if entity == "carrier":
        phone = "phone || ' (before)'" if age == 1 else "phone"
        return f"""SELECT 'WHOLESALE' AS source_system, carrier_id, company_name AS name, {phone} AS phone FROM ws_carriers
            WHERE carrier_id IN (SELECT split_part(o_orderpriority, '-', 1) FROM orders, cuts WHERE o_orderkey <= cuts.c{load})"""
    now = {
        "customer": "SELECT * FROM customers",
        "employee": """SELECT 'WHOLESALE' AS source_system, employee_id, concat_ws(' ', first_name, last_name) AS name, hire_date, title,
                              'EMP-' || employee_id AS address_id FROM ws_employees""",
        "product": "SELECT source_system, product_id, product_name AS name, category, price, currency FROM dim_product",
        "address": f"""SELECT source_system, address_id, address_type, street, postal_code, district, {K('country', 'state_code', 'city')} AS city_key
                       FROM address_inputs""",
        "supplier": """SELECT 'RETAIL' AS source_system, CAST(supplier_id AS VARCHAR) AS supplier_id, name,
                              '(' || CAST(area_code AS VARCHAR) || ') ' || number AS phone, 'SUP-' || CAST(supplier_id AS VARCHAR) AS address_id
                       FROM rt_suppliers_used""",
    }[entity]
    if not age:
        return now
    number = _n("split_part(address_id, '-', -1)") if entity == "address" else _n(key)

    def older(every: int, c: str, was: str, where: str = "TRUE") -> str:
        return f"CASE WHEN {where} AND {number} % {every * age} = 0 THEN {was} ELSE {c} END AS {c}"
    changes = {
        "customer": older(5, "name", "name || ' (before)'", "source_system = 'WHOLESALE'") + ", "
                    + older(5, "profession", "profession || ' (before)'", "source_system = 'RETAIL'"),
        "employee": older(3, "title", "title || ' (before)'"),
        "product": older(7, "price", "CAST(price + 1 AS DECIMAL(15,2))"),
        "supplier": older(4, "phone", "split_part(phone, ' ', 1) || ' 0'"),
        "address": older(6, "postal_code", "'0'", "source_system = 'RETAIL' AND address_id NOT LIKE '%-%'"),
    }[entity]
    person = f""", CASE WHEN source_system = 'RETAIL' AND {number} % {13 * age} = 0 THEN NULL ELSE address_id END AS address_id"""
    extra = person if entity == "customer" else ""
    return f"SELECT * REPLACE ({changes}{extra}) FROM ({now}) WHERE {number} % {13 * age} <> 0"


def _read(entity: str, load: int) -> str:
    """What a load reads of an entity: all the first time (suppliers: of its purchases), then what its transactions mention."""
    key = f"{entity}_id"
    if entity == "supplier":
        return f"SELECT * FROM supplier_{load} WHERE {_n(key)} IN (SELECT l_suppkey FROM bought_{load})"
    if load == 1:
        only = (f"WHERE address_id NOT LIKE 'SUP-%' OR {_n('split_part(address_id, chr(45), -1)')} IN (SELECT l_suppkey FROM bought_1)"
                if entity == "address" else "")
        return f"SELECT * FROM {entity}_1 {only}"
    touched = {
        "customer": f"SELECT source_system, customer_id FROM sold_{load}",
        "employee": f"SELECT source_system, employee_id FROM sold_{load}",
        "carrier": f"SELECT source_system, carrier_id FROM sold_{load}",
        "product": f"SELECT source_system, product_id FROM sold_{load} UNION SELECT 'RETAIL', CAST(l_partkey AS VARCHAR) FROM bought_{load}",
        "address": f"""SELECT c.source_system, c.address_id FROM customer_{load} c SEMI JOIN sold_{load} USING (source_system, customer_id)
                       UNION SELECT source_system, 'EMP-' || employee_id FROM sold_{load}
                       UNION SELECT 'RETAIL', 'SUP-' || CAST(l_suppkey AS VARCHAR) FROM bought_{load}""",
    }[entity]
    return f"SELECT * FROM {entity}_{load} SEMI JOIN ({touched}) USING (source_system, {key})"


def _state(entity: str) -> str:
    """type 2: a version starts where a load reads other values than the one before; type 1: the last ones read."""
    key, attrs = f"{entity}_id", ATTRS[entity]
    reads = " UNION ALL BY NAME ".join(f"SELECT *, {DAY[i]} AS day FROM ({_read(entity, i)})" for i in DAY)
    if entity not in TYPE2:
        return f"""state_{entity} AS (SELECT * EXCLUDE (day) FROM ({reads})
            QUALIFY row_number() OVER (PARTITION BY source_system, {key} ORDER BY day DESC) = 1)"""
    same = " AND ".join(f"{a} IS NOT DISTINCT FROM lag({a}) OVER w" for a in attrs)
    return f"""starts_{entity} AS (SELECT *, row_number() OVER w > 1 AND {same} AS same FROM ({reads})
        WINDOW w AS (PARTITION BY source_system, {key} ORDER BY day)),
    state_{entity} AS (SELECT * EXCLUDE (same, day), {K('source_system', key)} AS entity_key, {K('source_system', key, 'day')} AS version_key,
        day AS valid_from, CAST(lead(day) OVER w - 1 AS DATE) AS valid_to, lead(day) OVER w IS NULL AS is_current
        FROM starts_{entity} WHERE NOT same WINDOW w AS (PARTITION BY source_system, {key} ORDER BY day))"""


def _version(entity: str) -> str:
    return (f"LEFT JOIN state_{entity} v_{entity} ON v_{entity}.source_system = i.source_system AND v_{entity}.{entity}_id = i.{entity}_id "
            f"AND i.day >= v_{entity}.valid_from AND i.day <= coalesce(v_{entity}.valid_to, i.day)")


def _scenario() -> str:
    lacking = " ".join(f"WHEN load = {i} AND source_system = 'RETAIL' AND {_n('customer_id')} % {13 * AGE[i]} = 0 THEN NULL" for i in (1, 2))
    out = ["""cuts AS (SELECT coalesce(max(o_orderkey), 0) // 2 AS c1, coalesce(max(o_orderkey), 0) * 3 // 4 AS c2,
                             coalesce(max(o_orderkey), 0) AS c3 FROM orders)""",
           "items AS (SELECT *, CAST(l_partkey AS VARCHAR) AS product_id FROM sales_lines)"]
    for i in DAY:
        after = "TRUE" if i == 1 else f"o_orderkey > (SELECT coalesce(max(p.o_orderkey), 0) FROM upto_{i - 1} p WHERE p.source_system = items.source_system)"
        out.append(f"sold_{i} AS (SELECT items.* FROM items, cuts WHERE o_orderkey <= cuts.c{i} AND {after})")
        out.append(f"upto_{i} AS (SELECT * FROM sold_{i}" + (f" UNION ALL SELECT * FROM upto_{i - 1})" if i > 1 else ")"))
        after = "TRUE" if i == 1 else f"l_orderkey > (SELECT coalesce(max(l_orderkey), 0) FROM paid_{i - 1})"
        out.append(f"bought_{i} AS (SELECT purchase_lines.* FROM purchase_lines, cuts WHERE l_orderkey <= cuts.c{i} AND {after})")
        out.append(f"paid_{i} AS (SELECT * FROM bought_{i}" + (f" UNION ALL SELECT * FROM paid_{i - 1})" if i > 1 else ")"))
    out += [f"{e}_{i} AS ({_at(e, i)})" for e in ATTRS for i in DAY]
    out += [_state(e) for e in ATTRS]
    out.append("loaded AS (" + " UNION ALL ".join(f"SELECT *, {i} AS load, {DAY[i]} AS day FROM sold_{i}" for i in DAY) + ")")
    out.append("paid AS (" + " UNION ALL ".join(
        f"SELECT *, 'RETAIL' AS source_system, CAST(l_partkey AS VARCHAR) AS product_id, {i} AS load, {DAY[i]} AS day FROM bought_{i}" for i in DAY) + ")")
    out.append(f"""versioned AS (SELECT i.* REPLACE (CASE {lacking} ELSE i.address_id END AS address_id),
        {', '.join(f"coalesce(v_{e}.version_key, -1) AS {e}_version_key" for e in TYPE2)}
        FROM (SELECT * FROM loaded) i {' '.join(_version(e) for e in TYPE2)})""".replace("WHEN load", "WHEN i.load")
               .replace("AND source_system = 'RETAIL' AND CAST(customer_id", "AND i.source_system = 'RETAIL' AND CAST(i.customer_id"))
    return ",\n".join(out)


def _sql(body: str) -> str:
    full = with_binding("SELECT 1")
    return f"{full[:full.rfind(chr(10) + 'SELECT 1')]},{_scenario()}\n{body}"


_EMPLOYEE = f"CASE WHEN employee_version_key = -1 THEN -1 ELSE {K('source_system', 'employee_id')} END AS employee_key"
_CARRIER = f"CASE WHEN carrier_id IS NULL THEN -1 ELSE {K('source_system', 'carrier_id')} END AS carrier_key"
FACT_SALES = f"""SELECT source_system, sale_id, o_orderkey AS sale_no, l_linenumber AS line,
    CASE WHEN source_system = 'RETAIL' THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS item_id,
    {_tk('order_date')} AS time_key, order_date AS sale_date, {K('source_system', 'customer_id')} AS customer_key,
    {K('source_system', 'product_id')} AS product_key, {K('source_system', 'address_id')} AS address_key, {_EMPLOYEE}, {_CARRIER},
    customer_version_key, product_version_key, employee_version_key,
    (SELECT f.sale_type FROM fact_sales f WHERE f.source_system = versioned.source_system AND f.sale_id = versioned.sale_id LIMIT 1) AS sale_type,
    quantity, unit_price, discount_amount, item_total FROM versioned"""
FACT_PURCHASES = f"""SELECT i.source_system, purchase_id, l_orderkey AS purchase_no, {_tk('order_date')} AS time_key, order_date AS purchase_date,
    {K("'RETAIL'", 'l_suppkey')} AS supplier_key, {K("'RETAIL'", 'i.product_id')} AS product_key,
    {K("'RETAIL'", "'SUP-' || CAST(l_suppkey AS VARCHAR)")} AS address_key, coalesce(v_product.version_key, -1) AS product_version_key,
    quantity, unit_price, item_total,
    CAST(CASE WHEN o_orderstatus <> 'O' THEN max(ship_date) OVER (PARTITION BY purchase_id) END - order_date AS INTEGER) AS lead_time_days
    FROM paid i {_version('product')}"""
FACT_DELIVERIES = f"""WITH_ROWS SELECT source_system, sale_id, o_orderkey AS sale_no, {_tk('order_date')} AS order_time_key,
    CASE WHEN o_orderstatus <> 'O' THEN {_tk('max(ship_date)')} END AS ship_time_key, order_date,
    CASE WHEN o_orderstatus <> 'O' THEN max(ship_date) END AS shipped_date, {K('source_system', 'customer_id')} AS customer_key,
    {_EMPLOYEE}, {_CARRIER}, customer_version_key, employee_version_key, CAST(sum(item_total) AS DECIMAL(25,2)) AS order_value, freight,
    CAST(due_date - order_date AS INTEGER) AS promised_days,
    CAST(CASE WHEN o_orderstatus <> 'O' THEN max(ship_date) END - order_date AS INTEGER) AS days_to_ship,
    CAST(CASE WHEN o_orderstatus <> 'O' THEN max(ship_date) END - due_date AS INTEGER) AS delay_days
    FROM versioned WHERE source_system = 'WHOLESALE'
    GROUP BY source_system, sale_id, o_orderkey, order_date, o_orderstatus, customer_id, employee_id, carrier_id, due_date, freight,
             customer_version_key, employee_version_key""".replace("WITH_ROWS ", "")


def oracle_sql() -> dict[str, str]:
    out = {f"{e}_after_three_loads": _sql(f"SELECT * FROM state_{e}") for e in ATTRS}
    out["fact_sales_after_three_loads"] = out["fact_sales_after_catch_up"] = _sql(FACT_SALES)
    out["fact_purchases_appended"] = _sql(FACT_PURCHASES)
    out["fact_deliveries_appended"] = _sql(FACT_DELIVERIES)
    out["purchases_append"] = _sql("""SELECT source_system, purchase_id, CAST(l_suppkey AS VARCHAR) AS supplier_id, order_date, load,
        count(*) AS items, CAST(sum(item_total) AS DECIMAL(38,2)) AS value FROM paid GROUP BY ALL""")
    out["load_watermarks"] = _sql("""SELECT 'sales' AS stream, source_system, max(o_orderkey) AS watermark, max(o_orderkey) AS stored FROM loaded
        GROUP BY source_system UNION ALL SELECT 'purchases', 'RETAIL', max(l_orderkey), max(l_orderkey) FROM paid""")
    by_day = "CASE valid_from " + " ".join(f"WHEN {d} THEN {i}" for i, d in DAY.items()) + " END"
    counts = [f"SELECT '{n}' AS table_name, load, count(*) AS rows FROM loaded GROUP BY load" for n in ("sales", "fact_sales")]
    counts += [f"SELECT '{n}', load, count(*) FROM paid GROUP BY load" for n in ("purchases", "fact_purchases")]
    counts.append("SELECT 'fact_deliveries', load, count(DISTINCT sale_id) FROM loaded WHERE source_system = 'WHOLESALE' GROUP BY load")
    counts += [f"SELECT '{e}', {by_day} AS load, count(*) FROM state_{e} GROUP BY 2" for e in TYPE2]
    out["warehouse_after_three_loads"] = _sql(" UNION ALL ".join(counts))
    return out
