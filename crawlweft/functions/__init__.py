"""functions of the crawl-document index."""
