"""Named analyses: each is a function from Tables to a DataFrame."""
