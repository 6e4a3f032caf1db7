"""Scans: message exports, image folders, stored tables, driver tables."""
