"""Market-tick analytics on Spark: ticks to bins, bars, rollups, facts and marts.

Every operator is a plain function from DataFrame to DataFrame.
"""
