"""fareloom: layered trip-record analytics on Spark DataFrames.

Raw monthly files become an audited bronze table, a cleaned silver fact with a
zone dimension, and gold KPI tables, with validation, quality checks and run
metadata around them. Operators are DataFrame-to-DataFrame functions made of
built-in Spark expressions; only ``sources.tables`` and ``plans`` write.
"""
