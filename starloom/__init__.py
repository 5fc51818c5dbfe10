"""starloom: dimensional loads, data-quality rules and star KPIs as Spark jobs."""

__version__ = "0.1.0"
