"""The readmission model: staging, cleaning, star schema, KPIs, quality, reports."""
