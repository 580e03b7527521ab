"""ordermill: sales order cleaning, loading and reporting as Spark jobs."""
