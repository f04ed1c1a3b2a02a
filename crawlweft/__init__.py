"""Crawl-document indexing as Spark DataFrame transformations.

Every public function takes and returns DataFrames (or Columns); nothing here
collects data.  See README.md for the data flow.
"""
