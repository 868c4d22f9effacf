"""pulsegrid: sensor-recording and moving-vehicle analytics as PySpark jobs."""
