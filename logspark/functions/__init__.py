"""Column functions: time buckets and ranges, text helpers, repeatable picks, SQL registrations."""
