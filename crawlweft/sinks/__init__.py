"""sinks of the crawl-document index."""
