"""wordlake: Spark jobs that build, check and maintain a large word list, and text jobs around it."""
