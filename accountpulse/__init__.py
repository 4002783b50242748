"""Weekly account-health analytics expressed as PySpark DataFrame operators."""
