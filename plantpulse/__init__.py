"""plantpulse: risk and telemetry analytics for fleets of edge sites, on Spark.

Every operator is a function from DataFrame to DataFrame.  See README.md for
the map of modules and the scaling rules they follow.
"""
