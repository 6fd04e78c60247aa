"""Star-schema staging, loading, checking and analysis as Spark jobs.

Every public function takes DataFrames (or a session and a path) plus
parameters and returns a DataFrame; nothing loops over rows on the driver.
"""
