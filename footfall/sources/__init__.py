"""Reading and writing logs, feature tables, splits and metrics."""
