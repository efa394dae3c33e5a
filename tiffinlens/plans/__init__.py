"""Plan shapes shared by operators: bounded scans, null-spread joins, lineage cuts."""
