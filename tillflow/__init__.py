"""tillflow: retail transaction analytics on Spark.

Bronze ingest (Structured Streaming), Silver cleaning, Gold per-customer
features, profiles and reports, and Spark ML regression, all as DataFrame /
SQL / MLlib plans.
"""

__version__ = "0.1.0"
