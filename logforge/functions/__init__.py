"""Column functions: text helpers, syslog, audit records, command rebuild."""
