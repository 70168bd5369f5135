"""Writers: partitioned tables, messages, metric rows, reports."""
