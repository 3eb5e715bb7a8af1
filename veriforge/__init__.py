"""Document-fidelity analytics on PySpark."""
