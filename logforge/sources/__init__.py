"""Readers: audit and syslog lines, received logs, lookup tables, rule files."""
