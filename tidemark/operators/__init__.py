"""DataFrame operators: change data capture, views, quality rules, reports."""
