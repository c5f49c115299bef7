"""ledgerlens: wallet behaviour scoring on Spark.

Raw lending-protocol event logs are read, cleaned, aggregated per wallet,
turned into behavioural features, checked for anomalies and scored 0-100 with
explainable contribution and adjustment maps.  Every step is a lazy DataFrame
transformation; the only driver-side values are one-row statistics and model
parameters of bounded size.
"""

from ledgerlens.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
