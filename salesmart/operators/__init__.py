"""DataFrame -> DataFrame operators of the mart: cleaning, KPIs, summaries, report."""
