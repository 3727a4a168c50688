"""Jobs of the pipeline: each a DataFrame -> DataFrame function (cleaning, sessions, cohorts, adoption, retention, revenue, reports, checks, models)."""
