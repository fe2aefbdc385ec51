"""DataFrame operators: filters, enrichment, events, reduction, rules, reports."""
