"""Column expressions (strings, dates, numbers, JSON/VARIANT) and the fixed values they rely on."""
