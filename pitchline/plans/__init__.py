"""Feature plug-ins and whole runs."""
