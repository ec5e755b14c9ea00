"""Order analytics on Spark: typed order lines in, a fact table and sales KPIs out."""
