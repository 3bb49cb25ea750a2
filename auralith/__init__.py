"""Labelled-audio corpus analytics on Spark."""
