"""dwspark: a dimensional data warehouse built on PySpark DataFrames.

Two transactional sources are conformed into one history-preserving
corporate layer, from which three star-schema marts (sales, purchases,
deliveries) and their dashboard questions are derived. Every step is a
lazy DataFrame plan left to Catalyst; nothing iterates rows on the driver.
"""

__all__ = ["session"]
