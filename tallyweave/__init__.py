"""Reconciliation of published count tables, expressed as Spark DataFrame plans."""
