"""ledgerline: a Spark-native data-quality pipeline for company financial feeds.

Raw company, revenue, expense and FX feeds go through Bronze -> Silver /
Quarantine -> Golden, and four per-company monthly metrics are derived from
the Golden fact table. Every step is a DataFrame plan; nothing is collected
to the driver except counts and tiny control values.
"""

from ledgerline.session import get_spark, workspace_root

__all__ = ["get_spark", "workspace_root"]
