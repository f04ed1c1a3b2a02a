"""operators of the crawl-document index."""
