"""Column expressions shared by the plans. No UDFs."""
