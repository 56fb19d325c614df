"""DuckDB SQL of the dashboard questions.

Each mart has one wide relation (its fact with every column of its
dimensions beside it); a card is a line in ``CARDS``: which relation, by what
it groups, what it measures, which rows count, and how many rows it keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

from .binding import month_label_sql, with_binding

WIDE = {
    "sales": """
        SELECT sale.*, sale.sale_date AS day, day.month, day.quarter, item.product_name, item.category,
               item.currency, buyer.customer_name, buyer.income_band
        FROM fact_sales AS sale
        LEFT JOIN dim_time AS day USING (time_key)
        LEFT JOIN dim_product AS item USING (product_key)
        LEFT JOIN dim_customer AS buyer USING (customer_key)""",
    "purchases": """
        SELECT bought.*, bought.purchase_date AS day, day.month, day.quarter, item.product_name, item.category,
               vendor.supplier_name
        FROM fact_purchases AS bought
        LEFT JOIN dim_time AS day USING (time_key)
        LEFT JOIN dim_product AS item USING (product_key)
        LEFT JOIN dim_supplier AS vendor USING (supplier_key)""",
    "deliveries": """
        SELECT sent.*, sent.order_date AS day, day.month, day.quarter, truck.carrier_name, clerk.employee_name
        FROM fact_deliveries AS sent
        LEFT JOIN dim_time AS day ON day.time_key = sent.order_time_key
        LEFT JOIN dim_carrier AS truck USING (carrier_key)
        LEFT JOIN dim_employee AS clerk USING (employee_key)""",
}
UNKNOWN_MEMBER = "Não aplicável"


def total(of: str) -> str:
    return f"CAST(sum({of}) AS DECIMAL(38,2))"


def whole(of: str) -> str:
    return f"CAST(sum({of}) AS BIGINT)"


def share(of: str, by: str, digits: int) -> str:
    """A quotient in whole numbers: the dividend, scaled to twice the digits kept, is divided
    as an integer and rounded half away from zero; null for nothing to divide by."""
    up = f"CAST(round(CAST({of} AS DECIMAL(38,2)) * {10 ** digits * 100}, 0) AS HUGEINT)"
    by = f"CAST({by} AS HUGEINT) * 100"
    return (f"CASE WHEN {by} = 0 THEN NULL ELSE CAST(sign({up}) * ((2 * abs({up}) + {by}) // (2 * {by})) AS DECIMAL(38,0)) "
            f"/ {10 ** digits} END")


def mean(of: str, digits: int) -> str:
    return share(f"sum({of})", f"count({of})", digits)


SOLD, SALES = "item_total", "count(DISTINCT source_system || '-' || sale_id)"
QUARTERS = {f"T{n}": n for n in range(1, 5)}


@dataclass(frozen=True)
class Card:
    mart: str
    measures: dict[str, str]
    by: dict[str, str] | None = None        # output name -> expression
    rows: str = "TRUE"
    best: str = ""                          # of a top 10: the measure, ties by the group


def crosstab(mart: str, by: str, of: str, rows: str = "TRUE") -> Card:
    cells = {name: f"CAST(sum(CASE quarter WHEN {n} THEN {of} END) AS DECIMAL(38,2))" for name, n in QUARTERS.items()}
    return Card(mart, cells | {"total": total(of)}, {by: by}, rows)


def by_month(mart: str, measures: dict[str, str]) -> Card:
    return Card(mart, measures, {"month": "month", "month_name": month_label_sql("month")})


VALUE = {"total_value": total(SOLD)}
SHIPPED, LATE, WAITED = "days_to_ship IS NOT NULL", "delay_days IS NOT NULL", "lead_time_days IS NOT NULL"
CARDS = {
    "sales_total": Card("sales", VALUE),
    "sales_items_sold": Card("sales", {"items": whole("quantity")}),
    "sales_count": Card("sales", {"sales": SALES}),
    "sales_avg_ticket": Card("sales", {"avg_ticket": share(f"sum({SOLD})", SALES, 2)}),
    "sales_by_source": Card("sales", VALUE, {"source_system": "source_system"}),
    "sales_by_currency": Card("sales", VALUE, {"currency": "currency"}),
    "sales_by_month": by_month("sales", VALUE),
    "sales_by_category": Card("sales", VALUE, {"category": "category"}, "category IS NOT NULL"),
    "sales_top10_products": Card("sales", VALUE, {"product_name": "product_name"}, best="total_value"),
    "sales_top10_customers": Card("sales", VALUE, {"customer_name": "customer_name"}, best="total_value"),
    "sales_ticket_by_income_band": Card("sales", {"avg_ticket": share(f"sum({SOLD})", SALES, 2)},
                                        {"income_band": "income_band"}, "income_band IS NOT NULL"),
    "sales_category_by_quarter": crosstab("sales", "category", SOLD, "category IS NOT NULL"),
    "purchases_total": Card("purchases", VALUE),
    "purchases_items": Card("purchases", {"items": whole("quantity")}),
    "purchases_count": Card("purchases", {"purchases": "count(DISTINCT purchase_id)"}),
    "purchases_avg_lead_time": Card("purchases", {"avg_lead_time": mean("lead_time_days", 1)}),
    "purchases_by_month": by_month("purchases", VALUE),
    "purchases_top10_suppliers": Card("purchases", VALUE, {"supplier_name": "supplier_name"}, best="total_value"),
    "purchases_top10_products": Card("purchases", {"quantity": whole("quantity")}, {"product_name": "product_name"}, best="quantity"),
    "purchases_lead_time_by_supplier": Card("purchases", {"avg_lead_time": mean("lead_time_days", 1)},
                                            {"supplier_name": "supplier_name"}, WAITED),
    "purchases_supplier_summary": Card("purchases", {"purchases": "count(DISTINCT purchase_id)", **VALUE,
                                                     "avg_lead_time": mean("lead_time_days", 1)}, {"supplier_name": "supplier_name"}),
    "purchases_category_by_quarter": crosstab("purchases", "category", SOLD, "category IS NOT NULL"),
    "deliveries_count": Card("deliveries", {"orders": "count(*)"}),
    "deliveries_freight_total": Card("deliveries", {"freight_total": total("freight")}),
    "deliveries_avg_days_to_ship": Card("deliveries", {"avg_days": mean("days_to_ship", 1)}),
    "deliveries_avg_delay": Card("deliveries", {"avg_delay": mean("delay_days", 1)}),
    "deliveries_on_time_pct": Card("deliveries", {"on_time_pct": share("100 * count(*) FILTER (delay_days <= 0)", "count(delay_days)", 2)}),
    "deliveries_by_month": by_month("deliveries", {"orders": "count(*)"}),
    "deliveries_delay_by_carrier": Card("deliveries", {"avg_delay": mean("delay_days", 1)}, {"carrier_name": "carrier_name"}, LATE),
    "deliveries_freight_by_carrier": Card("deliveries", {"avg_freight": mean("freight", 2)}, {"carrier_name": "carrier_name"}),
    "deliveries_top10_employees": Card("deliveries", {"total_value": total("order_value")}, {"employee_name": "employee_name"},
                                       f"employee_name <> '{UNKNOWN_MEMBER}'", best="total_value"),
    "deliveries_carrier_summary": Card("deliveries", {
        "orders": "count(*)", "total_value": total("order_value"), "avg_freight": mean("freight", 2),
        "avg_days_to_ship": mean("days_to_ship", 1), "avg_delay": mean("delay_days", 1)}, {"carrier_name": "carrier_name"}),
    "deliveries_carrier_by_quarter": crosstab("deliveries", "carrier_name", "freight"),
}


def card_sql(card: Card, where: str) -> str:
    by = card.by or {}
    shown = ", ".join(f"{e} AS {n}" for n, e in [*by.items(), *card.measures.items()])
    text = f"SELECT {shown} FROM ({WIDE[card.mart]}) AS wide WHERE ({card.rows}) AND ({where})"
    if by:
        text += f" GROUP BY {', '.join(by.values())}"
    if card.best:
        text += f" ORDER BY {card.best} DESC, {next(iter(by))} LIMIT 10"
    return text


def dashboard_sql(where: str = "TRUE") -> dict[str, str]:
    """``where``: a condition on the wide relation's columns (the optional filters)."""
    found = {name: card_sql(card, where) for name, card in CARDS.items()}
    found["sales_cube_category_quarter"] = f"""SELECT * FROM (
        WITH cell AS (SELECT category, quarter, item_total FROM ({WIDE["sales"]}) AS wide WHERE category IS NOT NULL AND ({where}))
        SELECT category, quarter, {total("item_total")} AS total_value, CAST(0 AS BIGINT) AS grouping_level FROM cell GROUP BY category, quarter
        UNION ALL SELECT category, NULL, {total("item_total")}, 1 FROM cell GROUP BY category
        UNION ALL SELECT NULL, quarter, {total("item_total")}, 2 FROM cell GROUP BY quarter
        UNION ALL SELECT NULL, NULL, {total("item_total")}, 3 FROM cell)"""
    return {k: with_binding(v) for k, v in found.items()}
