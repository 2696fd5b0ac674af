"""Column expressions: text, HTML, dates, display."""
