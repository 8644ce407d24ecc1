"""Rating fusion on Spark: clean, match, merge, score, validate, compare, analyse."""
