"""Row shapes, as DDL: contests, the two sides of each, forecasts, quarantined rows."""

MATCH = "match_id long, match_date date, home_id long, away_id long, home_goals long, away_goals long, competition string"
SIDE = "match_id long, match_date date, competition string, side string, team long, opponent long, scored long, conceded long"
FORECAST = "forecast_id long, fixture_id long, created_at timestamp, lead_hours double, p_home double, p_draw double, p_away double, outcome string, fold string"
QUARANTINE = "source_file string, stage string, reason string, payload map<string,string>"
OUTCOMES = ("home_win", "draw", "away_win")
