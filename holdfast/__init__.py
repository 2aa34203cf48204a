"""Financial-product evidence analytics on Spark."""
