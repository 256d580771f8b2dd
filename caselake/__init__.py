"""caselake: customer-case analytics as plain PySpark DataFrame functions."""
