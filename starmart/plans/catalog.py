"""Every question by name, as a function of a mart; defaults are the warehouse's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from starmart.plans import history, sales, segments, supply

QUESTIONS: dict[str, Callable[..., DataFrame]] = {
    "q01_revenue_by_year": sales.revenue_by_year,
    "q02_top_items_by_units": sales.top_items_by_units,
    "q03_below_reorder_level_by_shortfall": supply.below_reorder_level_by_shortfall,
    "q04_group_at_each_sale": history.group_at_each_sale,
    "q05_item_price_during": history.item_price_during,
    "q06_revenue_by_historical_group": history.revenue_by_historical_group,
    "q07_customers_with_changes": history.customers_with_changes,
    "q08_segment_revenue": segments.segment_revenue,
    "q09_multi_segment_customers": segments.multi_segment_customers,
    "q10_segment_revenue_by_year": segments.segment_revenue_by_year,
    "q11_suppliers_of_item": supply.suppliers_of_item,
    "q12_emergency_suppliers": supply.emergency_suppliers,
    "q13_segment_and_historical_group": segments.segment_and_historical_group,
    "q14_average_price_comparison": history.average_price_comparison,
    "q15_margin_at_historical_price": history.margin_at_historical_price,
    "q16_total_revenue": sales.total_revenue,
    "q17_top_customers_by_revenue": sales.top_customers_by_revenue,
    "q18_monthly_revenue": sales.monthly_revenue,
    "q19_below_reorder_level": supply.below_reorder_level,
    "r01_total_revenue_of_year": sales.total_revenue_of_year,
    "r02_group_members": history.group_members,
    "r03_cost_exposure": supply.cost_exposure,
    "r04_segment_revenue_of_year": segments.segment_revenue_of_year,
    "r05_group_changes": history.group_changes,
    "r06_emergency_only_items": supply.emergency_only_items,
    "r07_price_increase": history.price_increase,
    "r08_orders_and_sales_by_year": sales.orders_and_sales_by_year,
    "r09_net_stock_movement": supply.net_stock_movement,
    "r09_movement_by_type": supply.movement_by_type,
    "r10_balances_by_year": supply.balances_by_year,
    "r10_outstanding_by_payment_method": supply.outstanding_by_payment_method,
    "r11_purchases_by_supplier": supply.purchases_by_supplier,
    "r12_double_count": segments.double_count,
    "r13_segment_profit_and_units": segments.segment_profit_and_units,
    "j03_sales_after_orders": history.sales_after_orders,
    "j01_revenue_by_city": sales.revenue_by_city,
    "j11_top_bill_to_customers": sales.top_bill_to_customers,
    "j11_revenue_by_salesperson": sales.revenue_by_salesperson,
    "j11_orders_by_picker": sales.orders_by_picker,
    "j11_invoiced_and_delivered_by_month": sales.invoiced_and_delivered_by_month,
}
