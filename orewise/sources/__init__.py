"""Tables in and out: site tables, features, jobs, reports."""
