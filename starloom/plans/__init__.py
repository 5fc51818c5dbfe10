"""Load plans and KPI reports built from the operators."""
