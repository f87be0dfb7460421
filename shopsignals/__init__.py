"""shopsignals: behavioural analytics for e-commerce event logs on PySpark.

Raw view / cart / purchase events become session summaries, one feature row
per user, a churn label, rule-based scoring, evaluation tables and a
two-sample distribution-shift report.  Every operator is a DataFrame / Spark
SQL plan; Spark ML is used for the models.
"""

from shopsignals.session import build_session, ensure_utc, checkpoint_dir

__all__ = ["build_session", "ensure_utc", "checkpoint_dir"]
