"""Column expressions shared by the layers."""
