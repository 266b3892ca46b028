"""Actuarial analytics on Spark: triangles, mortality, reserving, IFRS 17, catastrophe."""
