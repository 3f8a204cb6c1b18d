"""A PySpark engine for following debts owed by insolvent companies."""
