"""heddle: content curation and corpus preparation as Spark jobs."""
