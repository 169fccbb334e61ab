"""Parcel-carrier invoice analytics as PySpark DataFrame jobs."""
