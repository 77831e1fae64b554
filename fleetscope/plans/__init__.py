"""Composite plans: the reports, their variants, the BI mart and the report manifest."""
