"""Column helpers: exact money arithmetic, zone-free time, order lifecycle."""
