"""Sources (feeds, tables, series) and sinks (spec JSON, report, stage tables)."""
