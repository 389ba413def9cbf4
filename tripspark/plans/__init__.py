"""Query plans: the three trip programs, plan inspection, and the registry of
named queries with their SQL oracles."""
