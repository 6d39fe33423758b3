"""Yard analytics on Spark: pixel tables, zonal and focal operators, volumes, heat, change."""
