"""The long-running job: crawl rounds over stored pages, its state kept in tables."""
