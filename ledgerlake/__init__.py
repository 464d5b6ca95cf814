"""Billing-report loading and versioned facts on Spark DataFrames."""
