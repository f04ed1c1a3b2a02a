"""sources of the crawl-document index."""
