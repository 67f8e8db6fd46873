"""Column helpers: text, dates, numbers, scores and reproducible sampling."""
