"""Row-level operators: raw capture, parsing, rules, de-duplication, merging."""
