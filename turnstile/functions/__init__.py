"""Column helpers: text, calendar, keys, money and order statistics."""
