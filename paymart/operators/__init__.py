"""DataFrame operators: dedupe, quality, keys, calendar, joins, SCD1, SCD2."""
