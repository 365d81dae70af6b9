"""pagesieve: captured web responses in, clean and auditable records out, on Spark."""
