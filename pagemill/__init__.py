"""Spark jobs for the data work around a web crawl.

Every operator takes and returns DataFrames (or Columns); nothing is fetched,
no browser is driven and no model is called.
"""
