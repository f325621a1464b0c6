"""The warehouse: facts, views, analytic queries, measures and load jobs."""
