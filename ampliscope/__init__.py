"""Ampliscope: genome-editing outcome analytics on Spark DataFrames."""
