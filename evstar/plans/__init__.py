"""Models (staging views, mart tables), the build gate and the pipeline."""

from .marts import dim_customers, dim_date, dim_products, fact_orders
from .staging import stg_customers, stg_orders, stg_products
from .starter import my_first_model, my_second_model

__all__ = [
    "dim_customers",
    "dim_date",
    "dim_products",
    "fact_orders",
    "my_first_model",
    "my_second_model",
    "stg_customers",
    "stg_orders",
    "stg_products",
]
