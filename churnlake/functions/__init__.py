"""Column expressions: no UDFs, all inside whole-stage code generation."""
