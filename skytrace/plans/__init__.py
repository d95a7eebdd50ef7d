"""Registered queries: survey-shaped inputs derived from the driver tables, plans, SQL oracles."""
