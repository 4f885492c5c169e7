"""Spark jobs for cohorts of tiled images, and for the tables derived from them."""
