"""Batch analytics over large tables of geolocated sightings, as Spark DataFrame jobs."""
