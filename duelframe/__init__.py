"""DataFrame operators for paired events: contests of two sides, forecasts before, outcomes after."""
