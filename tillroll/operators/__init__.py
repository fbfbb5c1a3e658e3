"""DataFrame operators: cleaning, facts, features, reports, segments, forecasts."""
