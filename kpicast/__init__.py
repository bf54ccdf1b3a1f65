"""KPI forecasting and analytics for advertising data, written as Spark jobs."""
