"""DuckDB SQL twin of the test-data binding, corporate layer and marts.

Used only as the correctness oracle: every Spark query has an SQL body
here that runs on the same parquet tables. The CTEs below restate the
rules of ``sources.binding``, ``plans.corporate`` and ``plans.marts`` in
plain SQL (joins on natural keys, window/arg_min picks), so agreement is
evidence for both.
"""

from __future__ import annotations

from ..functions.keys import surrogate_key_sql as K


def _case(col: str, mapping: list[tuple[str, str]], null_first: bool = True) -> str:
    parts = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in mapping)
    head = f"WHEN {col} IS NULL THEN NULL " if null_first else ""
    return f"CASE {head}{parts} END"


def _income_band(col: str) -> str:
    from ..functions.rules import INCOME_BANDS
    m = [((f"{col} < {lim}" if lim is not None else "TRUE"), lab) for lim, lab in INCOME_BANDS]
    return _case(col, m)


def _age_band(age: str) -> str:
    from ..functions.rules import AGE_BANDS
    m = [((f"{age} <= {lim}" if lim is not None else "TRUE"), lab) for lim, lab in AGE_BANDS]
    return _case(age, m)


def month_label_sql(col: str) -> str:
    from ..functions.rules import MONTH_LABELS
    return "CASE " + " ".join(f"WHEN {col} = {i + 1} THEN '{m}'" for i, m in enumerate(MONTH_LABELS)) + " END"


def _decode(col: str, labels: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in labels.items()) + " END"


def _tk(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _ctes() -> list[tuple[str, str]]:
    from ..functions import rules as R
    from ..plans.marts import DEFAULT_AS_OF
    from ..sources.binding import SRC_RETAIL as RT
    from ..sources.binding import SRC_WHOLESALE as WS
    as_of_year = int(DEFAULT_AS_OF[:4])
    city = "'CITY_' || CAST({k} % 7 AS VARCHAR)"
    return [
        ("nr", """SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""),
        ("ws_customers", f"""
            SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS company_name,
                   'ADDR-' || CAST(c_custkey AS VARCHAR) AS address, {city.format(k='c_custkey')} AS city,
                   CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE nr.n_name END AS region,
                   lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code, nr.r_name AS country
            FROM customer c LEFT JOIN nr ON c.c_nationkey = nr.n_nationkey WHERE c_custkey % 2 = 0"""),
        ("ws_employees", f"""
            SELECT CAST(s_suppkey AS VARCHAR) AS employee_id, s_name AS first_name,
                   'No' || CAST(s_suppkey AS VARCHAR) AS last_name,
                   'TITLE_' || CAST(s_suppkey % 3 AS VARCHAR) AS title,
                   DATE '1990-01-01' + CAST(s_suppkey * 97 AS INTEGER) AS hire_date,
                   'ADDR-S' || CAST(s_suppkey AS VARCHAR) AS address, {city.format(k='s_suppkey')} AS city,
                   nr.n_name AS region, lpad(CAST(s_suppkey * 7919 % 100000 AS VARCHAR), 5, '0') AS postal_code,
                   nr.r_name AS country
            FROM supplier s LEFT JOIN nr ON s.s_nationkey = nr.n_nationkey"""),
        ("ws_carriers", """
            SELECT DISTINCT split_part(o_orderpriority, '-', 1) AS carrier_id,
                   CASE WHEN contains(o_orderpriority, '-') THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) ELSE '' END AS company_name,
                   '(555) 000-000' || split_part(o_orderpriority, '-', 1) AS phone
            FROM orders"""),
        ("rt_persons", """
            SELECT c_custkey AS person_id, c_name AS name, CASE WHEN c_custkey % 4 = 1 THEN 'F' ELSE 'M' END AS sex,
                   CAST(CAST(c_acctbal AS DECIMAL(15,2)) * CAST(2.5 AS DECIMAL(3,1)) AS DECIMAL(15,2)) AS income,
                   c_mktsegment AS marital_status, CAST(1920 + c_custkey % 66 AS INTEGER) AS birth_year,
                   c_mktsegment AS profession
            FROM customer WHERE c_custkey % 2 = 1"""),
        ("rt_phones", """
            SELECT c_custkey AS person_id, c_custkey * 10 + seq AS phone_id,
                   CAST(11 + (c_custkey + seq) % 89 AS INTEGER) AS area_code,
                   lpad(CAST(c_custkey * 10 + seq AS VARCHAR), 8, '0') AS number,
                   CAST((c_custkey + seq - 1) % 4 AS INTEGER) AS type_code, seq % 2 = 1 AS preferred
            FROM (SELECT c_custkey, unnest(generate_series(1, 1 + c_custkey % 3)) AS seq
                  FROM customer WHERE c_custkey % 2 = 1)"""),
        ("rt_addresses", f"""
            SELECT c_custkey AS address_id, c_custkey AS person_id, CAST(1 + c_custkey % 2 AS INTEGER) AS address_type_code,
                   'ADDR-' || CAST(c_custkey AS VARCHAR) AS street,
                   lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
                   'DISTRICT_' || CAST(c_custkey % 11 AS VARCHAR) AS district, nr.r_name AS city_region,
                   {city.format(k='c_custkey')} AS city, nr.n_name AS state_name,
                   upper(substring(nr.n_name, 1, 2)) AS state_code
            FROM customer c LEFT JOIN nr ON c.c_nationkey = nr.n_nationkey WHERE c_custkey % 2 = 1"""),
        ("orders_b", f"""
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN o_custkey % 2 = 0 THEN '{WS}' ELSE '{RT}' END AS source_system,
                   CAST(o_orderdate AS DATE) AS order_date, o_totalprice, o_orderpriority
            FROM orders"""),
        ("lines_b", """
            SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
                   CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS unit_price,
                   CAST(l_discount AS DECIMAL(6,4)) AS discount_rate, CAST(l_shipdate AS DATE) AS ship_date
            FROM lineitem"""),
        ("headers", f"""
            SELECT o_orderkey, source_system, order_date, o_orderstatus,
                   CAST(o_orderkey AS VARCHAR) AS sale_id, CAST(o_custkey AS VARCHAR) AS customer_id,
                   CASE WHEN source_system <> '{WS}' THEN CAST(o_orderkey % 4 AS INTEGER) END AS sale_type_code,
                   CASE WHEN source_system = '{WS}' THEN CAST(nullif(o_orderkey % ((SELECT max(s_suppkey) FROM supplier) + 1), 0) AS VARCHAR) END AS employee_id,
                   CASE WHEN source_system = '{WS}' AND o_orderstatus <> 'P' THEN split_part(o_orderpriority, '-', 1) END AS carrier_id,
                   CASE WHEN source_system = '{WS}' THEN order_date + 28 END AS due_date,
                   CASE WHEN source_system = '{WS}' THEN CAST(round(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(15,2)) END AS freight
            FROM orders_b"""),
        ("headers_addr", f"""
            SELECT h.*, CASE WHEN h.source_system = '{WS}' THEN h.customer_id
                             ELSE CAST(pa.address_id AS VARCHAR) END AS address_id
            FROM headers h LEFT JOIN (SELECT person_id, max(address_id) AS address_id FROM rt_addresses
                                      GROUP BY person_id) pa
                 ON h.source_system = '{RT}' AND h.customer_id = CAST(pa.person_id AS VARCHAR)"""),
        ("sales_lines0", f"""
            SELECT li.*, h.*,
                   CASE WHEN h.source_system = '{WS}'
                        THEN CAST(round(li.quantity * li.unit_price * li.discount_rate, 2) AS DECIMAL(15,2))
                        ELSE CAST(0 AS DECIMAL(15,2)) END AS discount_amount
            FROM lines_b li JOIN headers_addr h ON li.l_orderkey = h.o_orderkey"""),
        ("sales_lines", """
            SELECT *, CAST(round(quantity * unit_price - discount_amount, 2) AS DECIMAL(15,2)) AS item_total
            FROM sales_lines0"""),
        ("purchase_lines", f"""
            SELECT li.*, o.order_date, o.o_orderstatus,
                   CAST(li.l_orderkey AS VARCHAR) || '-' || CAST(li.l_suppkey AS VARCHAR) AS purchase_id,
                   CAST(round(li.quantity * li.unit_price, 2) AS DECIMAL(15,2)) AS item_total
            FROM lines_b li JOIN orders_b o ON li.l_orderkey = o.o_orderkey
            WHERE o.source_system = '{RT}' AND li.l_returnflag = 'R'"""),
        ("purchase_headers", """
            SELECT l_orderkey, l_suppkey,
                   CASE WHEN o_orderstatus <> 'O' THEN max(ship_date) END AS entry_date, min(order_date) AS order_date
            FROM purchase_lines GROUP BY l_orderkey, l_suppkey, o_orderstatus"""),
        ("rt_suppliers_used", f"""
            SELECT s_suppkey AS supplier_id, s_name AS name, CAST(11 + s_suppkey % 89 AS INTEGER) AS area_code,
                   lpad(CAST(s_suppkey * 7 AS VARCHAR), 8, '0') AS number,
                   'ADDR-S' || CAST(s_suppkey AS VARCHAR) AS street,
                   lpad(CAST(s_suppkey * 7919 % 100000 AS VARCHAR), 5, '0') AS postal_code,
                   'DISTRICT_' || CAST(s_suppkey % 11 AS VARCHAR) AS district, nr.r_name AS city_region,
                   {city.format(k='s_suppkey')} AS city, nr.n_name AS state_name,
                   upper(substring(nr.n_name, 1, 2)) AS state_code
            FROM supplier s LEFT JOIN nr ON s.s_nationkey = nr.n_nationkey
            WHERE s_suppkey IN (SELECT l_suppkey FROM purchase_lines)"""),
        ("address_inputs", f"""
            SELECT '{RT}' AS source_system, CAST(address_id AS VARCHAR) AS address_id,
                   CASE WHEN address_type_code = 1 THEN '{R.ADDRESS_TYPE_HOME}' ELSE '{R.ADDRESS_TYPE_BUSINESS}' END AS address_type,
                   street, postal_code, district, '{R.RETAIL_COUNTRY}' AS country, state_name, state_code, city, city_region,
                   0 AS geo_rank, TRY_CAST(address_id AS BIGINT) AS geo_number, CAST(address_id AS VARCHAR) AS geo_text
            FROM rt_addresses
            UNION ALL
            SELECT '{WS}', customer_id, NULL, address, postal_code, NULL,
                   coalesce(nullif(country, ''), '{R.NOT_INFORMED}'), coalesce(nullif(region, ''), '{R.NOT_INFORMED}'),
                   substring(coalesce(nullif(region, ''), '{R.STATE_CODE_DEFAULT}'), 1, 10),
                   coalesce(nullif(city, ''), '{R.NOT_INFORMED}'), region,
                   1, TRY_CAST(customer_id AS BIGINT), customer_id
            FROM ws_customers
            UNION ALL
            SELECT '{WS}', 'EMP-' || employee_id, '{R.ADDRESS_TYPE_BUSINESS}', address, postal_code, NULL,
                   coalesce(nullif(country, ''), '{R.NOT_INFORMED}'), coalesce(nullif(region, ''), '{R.NOT_INFORMED}'),
                   substring(coalesce(nullif(region, ''), '{R.STATE_CODE_DEFAULT}'), 1, 10),
                   coalesce(nullif(city, ''), '{R.NOT_INFORMED}'), region,
                   2, TRY_CAST(employee_id AS BIGINT), employee_id
            FROM ws_employees
            UNION ALL
            SELECT '{RT}', 'SUP-' || CAST(supplier_id AS VARCHAR), '{R.ADDRESS_TYPE_BUSINESS}', street, postal_code,
                   district, '{R.RETAIL_COUNTRY}', state_name, state_code, city, city_region,
                   3, CAST(supplier_id AS BIGINT), CAST(supplier_id AS VARCHAR)
            FROM rt_suppliers_used"""),
        ("geo_states", """
            SELECT country, state_code, state_name FROM address_inputs
            QUALIFY row_number() OVER (PARTITION BY country, state_code ORDER BY geo_rank, geo_number NULLS FIRST, geo_text) = 1"""),
        ("geo_cities", """
            SELECT country, state_code, city, city_region FROM address_inputs
            QUALIFY row_number() OVER (PARTITION BY country, state_code, city ORDER BY geo_rank, geo_number NULLS FIRST, geo_text) = 1"""),
        ("dim_address", f"""
            SELECT {K('a.source_system', 'a.address_id')} AS address_key, a.source_system, a.address_id,
                   a.address_type, a.street, a.postal_code, a.district, c.city_region, a.city, s.state_name AS state,
                   a.state_code, a.country
            FROM address_inputs a
            JOIN geo_cities c ON c.country IS NOT DISTINCT FROM a.country
                             AND c.state_code IS NOT DISTINCT FROM a.state_code AND c.city IS NOT DISTINCT FROM a.city
            JOIN geo_states s ON s.country IS NOT DISTINCT FROM a.country
                             AND s.state_code IS NOT DISTINCT FROM a.state_code"""),
        ("pref_phone", """
            SELECT person_id, area_code, type_code FROM rt_phones WHERE preferred
            QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY phone_id) = 1"""),
        ("customers", f"""
            SELECT '{RT}' AS source_system, CAST(p.person_id AS VARCHAR) AS customer_id,
                   '{R.PERSON_TYPE_PERSON}' AS person_type, p.name, p.sex, {_income_band('p.income')} AS income_band,
                   p.marital_status, p.birth_year, p.profession,
                   CAST(a.address_id AS VARCHAR) AS address_id, CAST(ph.area_code AS VARCHAR) AS area_code,
                   {_decode('ph.type_code', R.PHONE_TYPE_LABELS)} AS phone_type
            FROM rt_persons p
            LEFT JOIN pref_phone ph ON ph.person_id = p.person_id
            LEFT JOIN (SELECT person_id, max(address_id) AS address_id FROM rt_addresses GROUP BY person_id) a
                   ON a.person_id = p.person_id
            UNION ALL
            SELECT '{WS}', customer_id, '{R.PERSON_TYPE_COMPANY}', company_name, NULL, NULL, NULL, NULL, NULL,
                   customer_id, NULL, NULL
            FROM ws_customers"""),
        ("dim_customer", f"""
            SELECT {K('source_system', 'customer_id')} AS customer_key, source_system, customer_id, person_type,
                   name AS customer_name, sex, income_band, marital_status,
                   {_age_band(f'({as_of_year} - birth_year)')} AS age_band, birth_year, profession, area_code, phone_type
            FROM customers"""),
        ("dim_product", f"""
            SELECT {K('src', 'CAST(p_partkey AS VARCHAR)')} AS product_key, src AS source_system,
                   CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
                   CAST(p_retailprice AS DECIMAL(15,2)) AS price, cur AS currency
            FROM part, (VALUES ('{RT}', '{R.CURRENCY_RETAIL}'), ('{WS}', '{R.CURRENCY_WHOLESALE}')) v(src, cur)"""),
        ("dim_employee", f"""
            SELECT {K("'" + WS + "'", 'e.employee_id')} AS employee_key, '{WS}' AS source_system, e.employee_id,
                   concat_ws(' ', e.first_name, e.last_name) AS employee_name, e.title, e.hire_date,
                   a.city, a.country
            FROM ws_employees e LEFT JOIN dim_address a
                 ON a.source_system = '{WS}' AND a.address_id = 'EMP-' || e.employee_id
            UNION ALL
            SELECT {R.UNKNOWN_KEY}, '{R.UNKNOWN_SOURCE}', NULL, '{R.UNKNOWN_NAME}', '{R.UNKNOWN_NAME}', NULL, NULL, NULL"""),
        ("dim_carrier", f"""
            SELECT {K("'" + WS + "'", 'carrier_id')} AS carrier_key, '{WS}' AS source_system, carrier_id,
                   company_name AS carrier_name, phone
            FROM ws_carriers
            UNION ALL
            SELECT {R.UNKNOWN_KEY}, '{R.UNKNOWN_SOURCE}', NULL, '{R.UNKNOWN_NAME}', NULL"""),
        ("dim_supplier", f"""
            SELECT {K("'" + RT + "'", 'CAST(supplier_id AS VARCHAR)')} AS supplier_key, '{RT}' AS source_system,
                   CAST(supplier_id AS VARCHAR) AS supplier_id, name AS supplier_name,
                   '(' || CAST(area_code AS VARCHAR) || ') ' || number AS phone
            FROM rt_suppliers_used"""),
        ("dim_time", f"""
            SELECT {_tk('d')} AS time_key, CAST(d AS DATE) AS date, CAST(day(d) AS INTEGER) AS day,
                   CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
                   CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
                   dayname(d) AS weekday, isodow(d) IN (6, 7) AS is_weekend
            FROM generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '2035-12-31', INTERVAL 1 DAY) t(d)"""),
        ("fact_sales", f"""
            SELECT sl.source_system, sl.sale_id,
                   CASE WHEN sl.source_system <> '{WS}' THEN CAST(sl.l_orderkey AS VARCHAR) || '-' || CAST(sl.l_linenumber AS VARCHAR) END AS item_id,
                   {_tk('sl.order_date')} AS time_key, sl.order_date AS sale_date,
                   {K('sl.source_system', 'sl.customer_id')} AS customer_key,
                   {K('sl.source_system', 'CAST(sl.l_partkey AS VARCHAR)')} AS product_key,
                   {K('sl.source_system', 'sl.address_id')} AS address_key,
                   coalesce(e.employee_key, -1) AS employee_key, coalesce(c.carrier_key, -1) AS carrier_key,
                   {_decode('sl.sale_type_code', R.SALE_TYPE_LABELS)} AS sale_type,
                   sl.quantity, sl.unit_price, sl.discount_amount, sl.item_total
            FROM sales_lines sl
            LEFT JOIN dim_employee e ON e.employee_key <> -1 AND e.source_system = sl.source_system AND e.employee_id = sl.employee_id
            LEFT JOIN dim_carrier c ON c.carrier_key <> -1 AND c.source_system = sl.source_system AND c.carrier_id = sl.carrier_id"""),
        ("fact_purchases", f"""
            SELECT '{RT}' AS source_system, pl.purchase_id, CAST(NULL AS VARCHAR) AS item_id,
                   {_tk('pl.order_date')} AS time_key, pl.order_date AS purchase_date,
                   {K("'" + RT + "'", 'CAST(pl.l_suppkey AS VARCHAR)')} AS supplier_key,
                   {K("'" + RT + "'", 'CAST(pl.l_partkey AS VARCHAR)')} AS product_key,
                   {K("'" + RT + "'", "'SUP-' || CAST(pl.l_suppkey AS VARCHAR)")} AS address_key,
                   pl.quantity, pl.unit_price, pl.item_total,
                   CAST(ph.entry_date - pl.order_date AS INTEGER) AS lead_time_days
            FROM purchase_lines pl JOIN purchase_headers ph ON ph.l_orderkey = pl.l_orderkey AND ph.l_suppkey = pl.l_suppkey"""),
        ("order_values", f"""
            SELECT o_orderkey, sum(item_total) AS order_value, max(ship_date) AS last_ship_date
            FROM sales_lines WHERE source_system = '{WS}' GROUP BY o_orderkey"""),
        ("fact_deliveries", f"""
            SELECT h.source_system, h.sale_id, {_tk('h.order_date')} AS order_time_key,
                   CASE WHEN h.o_orderstatus <> 'O' THEN {_tk('ov.last_ship_date')} END AS ship_time_key,
                   h.order_date, CASE WHEN h.o_orderstatus <> 'O' THEN ov.last_ship_date END AS shipped_date,
                   {K('h.source_system', 'h.customer_id')} AS customer_key,
                   coalesce(e.employee_key, -1) AS employee_key, coalesce(c.carrier_key, -1) AS carrier_key,
                   {K('h.source_system', 'h.customer_id')} AS address_key,
                   CAST(coalesce(ov.order_value, 0) AS DECIMAL(25,2)) AS order_value, h.freight,
                   CAST(h.due_date - h.order_date AS INTEGER) AS promised_days,
                   CAST(CASE WHEN h.o_orderstatus <> 'O' THEN ov.last_ship_date END - h.order_date AS INTEGER) AS days_to_ship,
                   CAST(CASE WHEN h.o_orderstatus <> 'O' THEN ov.last_ship_date END - h.due_date AS INTEGER) AS delay_days
            FROM headers h JOIN order_values ov ON ov.o_orderkey = h.o_orderkey
            LEFT JOIN dim_employee e ON e.employee_key <> -1 AND e.source_system = h.source_system AND e.employee_id = h.employee_id
            LEFT JOIN dim_carrier c ON c.carrier_key <> -1 AND c.source_system = h.source_system AND c.carrier_id = h.carrier_id
            WHERE h.source_system = '{WS}'"""),
    ]


def with_binding(body: str) -> str:
    """Prefix a query body with the binding CTEs (DuckDB only evaluates
    the ones the body references)."""
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in _ctes())
    return f"WITH {ctes}\n{body.strip()}"
