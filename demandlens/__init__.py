"""demandlens: skill demand, skill gaps and placement outlook as Spark jobs."""
