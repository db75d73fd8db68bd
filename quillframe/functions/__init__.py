"""Column functions: normalisers, similarities and calendar arithmetic."""
