"""streaming of the crawl-document index."""
