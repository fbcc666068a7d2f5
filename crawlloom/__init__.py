"""Web-crawl archives to clean, language-tagged, deduplicated text on Spark."""
