"""DuckDB SQL twins of the registered queries, used only to verify results.

Money is held in whole cents (integers) and rounded by integer arithmetic, so a twin shares
neither code nor number formats with the Spark side. Output columns use portable types:
DOUBLE for amounts and ratios, BIGINT for counts, ISO text for dates, times and flags.
"""
