"""Spark jobs for customer and payment-transaction data."""
