"""Column functions: native expressions only, usable in any select or filter."""
