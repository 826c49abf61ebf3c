"""Churn, sales/RFM and funnel analytics as PySpark DataFrame jobs."""
