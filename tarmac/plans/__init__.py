"""Plans: raw to Bronze, Bronze to Silver, Silver to Gold, KPIs and views."""
