"""plans of the crawl-document index."""
