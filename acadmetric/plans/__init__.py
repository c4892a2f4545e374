"""The reports. Each takes a mapping of table name -> DataFrame and returns a DataFrame.

Ties that a report leaves open are settled by name and id, so a cut list is
the same on every run. Lookups that add no column are semi-joins: they keep
rows whose parent exists and carry nothing along.
"""
