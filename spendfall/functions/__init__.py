"""Column-level helpers: money arithmetic, text cleaning, exact splits."""
