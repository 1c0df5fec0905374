"""Integrate several transactional sources into one star schema, on Spark.

The package is a set of DataFrame-to-DataFrame operators (``functions``,
``operators``), readers and stores (``sources``) and a declarative
configuration of one integration (``plans``).  Nothing here starts a session
or collects data to the driver; actions happen in the stores only.
"""
