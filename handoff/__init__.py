"""handoff: table hand-over checks on Spark.

Profile and clean a table, measure a data contract from it, validate later batches against the
contract in one scan, inject known faults, build leakage-checked features and evaluate scores.
Every operator is DataFrame in, DataFrame out; only per-column metadata ever reaches the driver.
"""

from handoff.config import Config

__all__ = ["Config"]
