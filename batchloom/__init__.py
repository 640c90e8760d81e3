"""Batch enrichment of tables and files with model output, and channel analytics, on Spark.

Every public function takes and returns DataFrames (or writes a table); nothing here holds
a session, and no row data passes through the driver.
"""
