"""DataFrame -> DataFrame operators: windows, joins, sampling, latest tables, metrics."""
