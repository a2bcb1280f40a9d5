"""Functions over document values (VARIANT) as Catalyst expressions; no Python runs for a row."""
