"""Trafficlake: usage and traffic analytics as Spark DataFrame jobs."""
