"""Move business tables and prove that their values survived, as Spark jobs."""
