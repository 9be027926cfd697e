"""Contribution, donor-identity and donor-mart jobs written as Spark DataFrame plans."""
