from .calendar import calendar_gap, load_calendar, missing_days
from .dimensions import (
    customer_dimension,
    employee_dimension,
    geography_dimension,
    product_dimension,
    promotion_dimension,
    territory_dimension,
)
from .sales import fact_rows, new_fact_rows, order_month, stage_sales, within_months
from .warehouse import Files, Warehouse

__all__ = [
    "Files",
    "Warehouse",
    "calendar_gap",
    "customer_dimension",
    "employee_dimension",
    "fact_rows",
    "geography_dimension",
    "load_calendar",
    "missing_days",
    "new_fact_rows",
    "order_month",
    "product_dimension",
    "promotion_dimension",
    "stage_sales",
    "territory_dimension",
    "within_months",
]
