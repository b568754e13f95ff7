"""Complete queries, views, batch jobs and models built from the operators."""
