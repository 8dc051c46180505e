"""fraudlake: a Spark-native card-payments warehouse and fraud mart.

Type-2 dimension history, as-of enrichment of transactions and the four
fraud rules, all as DataFrame jobs (see README.md).
"""

__version__ = "0.1.0"
