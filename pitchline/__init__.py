"""Pitchline: point-in-time match analytics as Spark DataFrame plans."""
