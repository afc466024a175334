"""stratalake: a Spark-native batch medallion lakehouse for retail extracts.

Layers
------
raw      daily extracts (customers, products, orders, order_items)
bronze   append-only history of every extract, stamped with lineage columns
silver   latest clean row per natural key, referentially trimmed
gold     star schema: SCD2 ``dim_customer``, ``dim_product``, ``dim_date`` and a
         point-in-time ``fact_sales``

Every layer is a lazy DataFrame; Catalyst plans the whole chain.  Storage
boundaries (``plans.pipeline``) write each layer and read it back so lineage is
cut between stages.
"""

__version__ = "0.1.0"

TABLES = ("customers", "products", "orders", "order_items")
