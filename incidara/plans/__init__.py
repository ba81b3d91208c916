"""Whole analyses, from incident table to result tables."""
