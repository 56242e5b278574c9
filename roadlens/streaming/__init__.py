"""The daily feed as a stream: landing, daily counts, scoring."""
