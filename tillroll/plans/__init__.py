"""Named analyses and the query sets built on them."""
