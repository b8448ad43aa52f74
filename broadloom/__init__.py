"""broadloom: wide feature tables, their audit, splits, models and event streams on Spark."""
