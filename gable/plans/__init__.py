"""Listing jobs: silver, gold, views, analyst questions, model."""
