"""Readers and writers: notifications, objects, word tables, rules, rendered pages, results."""
