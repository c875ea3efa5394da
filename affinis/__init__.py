"""Interaction analytics and recommendation features as Spark jobs."""
