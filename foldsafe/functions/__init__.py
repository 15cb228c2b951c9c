"""Column-level building blocks (pure expressions, codegen-friendly)."""
